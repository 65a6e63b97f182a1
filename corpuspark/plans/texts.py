"""Text functions, metric cards and classification over documents."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from corpuspark.functions import metrics, text as X
from corpuspark.operators import classify
from corpuspark.plans.registry import query
from corpuspark.session import spread, table

WORDS = "list_filter(regexp_extract_all(lower(text), '[Ա-Ֆա-և]+'), lambda x: length(x) >= 2)"


def _docs(spark, d):
    return spread(table(spark, d, "documents").where("text is not null"))


def _n(pattern: str, of: str = "text") -> str:
    return f"length(regexp_replace({of}, '[^{pattern}]', '', 'g'))"


@query(rf"""
SELECT doc_id, CAST({_n('Ա-և')} AS INTEGER) AS armenian_letters, CAST({_n('։֊')} AS INTEGER) AS armenian_punct, CAST({_n('A-Za-zÀ-ɏ')} AS INTEGER) AS latin,
 CAST({_n(r'\p{Nd}')} AS INTEGER) AS digits,
 round(CASE WHEN {_n(r'\p{L}')} > 0 THEN {_n('Ա-և')} / {_n(r'\p{L}')} ELSE 0.0 END, 6) AS script_ratio
FROM documents WHERE text IS NOT NULL
""")
def character_classes(spark, d):
    rows = _docs(spark, d).select("doc_id", X.character_classes(F.col("text")).alias("c"), X.count_of(F.col("text"), r"\p{L}").alias("letters"))
    ratio = F.round(X.share(F.col("c.armenian_letters"), F.col("letters")), 6).alias("script_ratio")
    return rows.select("doc_id", "c.armenian_letters", "c.armenian_punct", "c.latin", "c.digits", ratio)


@query(f"SELECT doc_id, len({WORDS}) AS words, len(list_distinct({WORDS})) AS different FROM documents WHERE text IS NOT NULL")
def token_counts(spark, d):
    w = X.words(F.col("text"))
    return _docs(spark, d).select("doc_id", F.size(w).cast("bigint").alias("words"), F.size(F.array_distinct(w)).cast("bigint").alias("different"))


def _split(pattern: str) -> str:
    return f"len(list_filter(list_transform(regexp_split_to_array(text, '{pattern}'), lambda x: trim(x)), lambda x: x <> ''))"


@query(f"SELECT doc_id, {_split('[։?!:]+')} AS marks, {_split('[։?!:' + chr(10) + ']+')} AS lines FROM documents WHERE text IS NOT NULL")
def sentence_counts(spark, d):
    t = F.col("text")
    return _docs(spark, d).select("doc_id", F.size(X.sentences(t, "marks")).cast("bigint").alias("marks"), F.size(X.sentences(t, "lines")).cast("bigint").alias("lines"))


@query("SELECT doc_id, translate(text, 'բպգկդտձծջճվւ', 'պբկգտդծձճջւվ') AS swapped, replace(replace(replace(text, 'ութիւն', 'ություն'), 'եւ', 'և'), 'ւ', 'վ') AS reformed FROM documents WHERE text IS NOT NULL")
def spelling_variants(spark, d):
    t = F.col("text")
    return _docs(spark, d).select("doc_id", X.other_branch(t).alias("swapped"), X.reformed(t).alias("reformed"))


@query(r"""
SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '\([^()]*[A-Za-zÀ-ɏ؀-ۿ][^()]*\)', '', 'g'), '«[^«»]*[A-Za-zÀ-ɏ؀-ۿ][^«»]*»', '', 'g'), '[A-Za-zÀ-ɏ؀-ۿ]+', '', 'g'), '\(\s*\)', '', 'g'), '«\s*»', '', 'g') AS text
FROM documents WHERE text IS NOT NULL
""")
def foreign_fragments_removed(spark, d):
    return _docs(spark, d).select("doc_id", X.without_foreign(F.col("text")).alias("text"))


@query(r"""
WITH f AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(nfc_normalize(text), '\([^()]*[A-Za-zÀ-ɏ؀-ۿ][^()]*\)', '', 'g'), '«[^«»]*[A-Za-zÀ-ɏ؀-ۿ][^«»]*»', '', 'g'), '[A-Za-zÀ-ɏ؀-ۿ]+', '', 'g'), '\(\s*\)', '', 'g'), '«\s*»', '', 'g') AS t FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, regexp_replace(regexp_replace(t, '[\t\v\f\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g'), '(?m) +$', '', 'g') AS t FROM f)
SELECT doc_id, trim(array_to_string(list_filter(string_split(t, chr(10)), lambda x: trim(x, ' ') = '' OR regexp_matches(x, '[\p{L}\p{N}_]')), chr(10)), ' ') AS text FROM w
""")
def normalized_texts(spark, d):
    return _docs(spark, d).select("doc_id", X.normalized(F.col("text")).alias("text"))


@query("SELECT doc_id, CASE WHEN text = '' THEN 0 WHEN length(text) < 5 THEN 1 ELSE len(list_distinct(list_transform(range(1, length(text) - 3), lambda i: substring(text, i, 5)))) END AS shingles FROM documents WHERE text IS NOT NULL")
def shingle_counts(spark, d):
    return _docs(spark, d).select("doc_id", F.size(X.shingles(F.col("text"))).cast("bigint").alias("shingles"))


@query(f"""
SELECT doc_id, round(CASE WHEN len({WORDS}) > 0 THEN len(list_distinct({WORDS})) / len({WORDS}) ELSE 0.0 END, 4) AS ttr,
 CASE WHEN len({WORDS}) >= 100 THEN round(list_avg(list_transform(range(0, CAST(floor(len({WORDS}) / 100) AS BIGINT)), lambda i: len(list_distinct(({WORDS})[i * 100 + 1 : i * 100 + 100])) / 100)), 4)
  WHEN len({WORDS}) > 0 THEN round(len(list_distinct({WORDS})) / len({WORDS}), 4) ELSE 0.0 END AS sttr
FROM documents WHERE text IS NOT NULL
""")
def lexical_metrics(spark, d):
    rows = _docs(spark, d).select("doc_id", X.words(F.col("text")).alias("w"))
    return rows.select("doc_id", metrics.ttr(F.col("w")).alias("ttr"), metrics.sttr(F.col("w")).alias("sttr"))


@query(f"""
WITH t AS (SELECT doc_id, unnest({WORDS}) AS w FROM documents WHERE text IS NOT NULL), c AS (SELECT doc_id, w, count(*) AS f FROM t GROUP BY ALL),
s AS (SELECT doc_id, sum(f) AS n, count(*) AS v, sum(f * f) AS q FROM c GROUP BY doc_id),
e AS (SELECT doc_id, sum(-(f / n) * log2(f / n)) AS h FROM c JOIN s USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, round(coalesce(greatest(0.0, 10000.0 * (q - v) / (n * n)), 0.0), 2) AS yule, round(coalesce(h, 0.0), 4) AS entropy
FROM documents d LEFT JOIN s USING (doc_id) LEFT JOIN e USING (doc_id) WHERE d.text IS NOT NULL
""")
def richness_metrics(spark, d):
    """Yule's K and entropy by grouped counts, which stay flat for long texts."""
    docs = _docs(spark, d)
    c = docs.select("doc_id", F.explode(X.words(F.col("text"))).alias("w")).groupBy("doc_id", "w").agg(F.count(F.lit(1)).alias("f"))
    s = c.groupBy("doc_id").agg(F.sum("f").alias("n"), F.count(F.lit(1)).alias("v"), F.sum(F.col("f") * F.col("f")).alias("q"), F.sum(F.col("f") * F.log2("f")).alias("l"))
    yule = F.greatest(F.lit(0.0), 10000.0 * (F.col("q") - F.col("v")) / (F.col("n") * F.col("n")))
    entropy = F.log2("n") - F.col("l") / F.col("n")
    return docs.select("doc_id").join(s, "doc_id", "left").select("doc_id", F.round(F.coalesce(yule, F.lit(0.0)), 2).alias("yule"), F.round(F.coalesce(entropy, F.lit(0.0)), 4).alias("entropy"))


def _ends(s: str, more: str = "") -> str:
    return f"CAST(len(list_filter(w, lambda x: suffix(x, '{s}'){more})) AS INTEGER)"


@query(f"""
WITH t AS (SELECT doc_id, {WORDS} AS w FROM documents WHERE text IS NOT NULL)
SELECT doc_id, {', '.join(f"{_ends(s)} AS suffix_{k}" for k, s in metrics.SUFFIXES.items())}, {_ends('ան', " AND NOT suffix(x, 'եան')")} AS suffix_an,
 {', '.join(f"CAST(len(list_filter(w, lambda x: x = '{s}')) AS INTEGER) AS prefix_{k}" for k, s in metrics.PARTICLES.items())},
 CAST(len(list_filter(w, lambda x: prefix(x, 'չ') AND length(x) > 1)) AS INTEGER) AS prefix_ch FROM t
""")
def morphological_metrics(spark, d):
    rows = _docs(spark, d).select("doc_id", X.words(F.col("text")).alias("w"))
    return rows.select("doc_id", *metrics.suffix_counts(F.col("w")))


@query(f"""
WITH c AS (SELECT doc_id, {' + '.join(f"len(regexp_extract_all(text, '{p}'))" for p in metrics.CLASSICAL)} AS classical,
 len(regexp_extract_all(text || ' ', 'ա[^԰-֏]')) + len(regexp_extract_all(text || ' ', 'թյուն[^԰-֏]')) + len(regexp_extract_all(text || ' ', 'յան[^԰-֏]')) + len(regexp_extract_all(text, 'ե')) AS reformed
 FROM documents WHERE text IS NOT NULL)
SELECT doc_id, CAST(classical AS INTEGER) AS classical, CAST(reformed AS INTEGER) AS reformed, round(classical / greatest(reformed, 1), 6) AS ratio FROM c
""")
def orthographic_metrics(spark, d):
    return _docs(spark, d).select("doc_id", *metrics.orthography(F.col("text"), 6))


@query(f"""
WITH t AS (SELECT doc_id, len(list_filter({WORDS}, lambda x: suffix(x, 'եմ'))) AS em, len(list_filter({WORDS}, lambda x: suffix(x, 'ում'))) AS um FROM documents WHERE text IS NOT NULL)
SELECT doc_id, round(CASE WHEN em + um > 0 THEN um / (em + um) ELSE 0.0 END, 4) AS code_switching, round(1 - CASE WHEN em + um > 0 THEN um / (em + um) ELSE 0.0 END, 4) AS purity FROM t
""")
def contamination_metrics(spark, d):
    rows = _docs(spark, d).select("doc_id", X.words(F.col("text")).alias("w")).select("doc_id", metrics.contamination(F.col("w")).alias("code_switching"))
    return rows.select("doc_id", "code_switching", F.round(1 - F.col("code_switching"), 4).alias("purity"))


def _duck(pattern: str, fold: bool = True) -> str:
    """A rule's pattern for an engine without lookaround or boundaries of all scripts: what stands beside is matched, the match is group 1."""
    core, before, after = pattern.lower() if fold else pattern.replace("\\Z", "\\z"), "", ""
    if core.startswith("\\b"):
        core, before = core[2:], "(?:^|[^\\p{L}\\p{N}_])"
    if core.endswith("\\b"):
        core, after = core[:-2], "(?:$|[^\\p{L}\\p{N}_])"
    core = re.sub(r"\((?!\?)", "(?:", core).replace("\\w", "\\p{L}\\p{N}_").replace("[[\\p", "[\\p")
    if found := re.match(r"\(\?<=(\[[^\]]*\])\)", core):
        core, before = core[found.end() :], found[1]
    if found := re.search(r"\(\?=(.*)\)$", core):
        core, after = core[: found.start()], f"(?:{found[1]})".replace("\\z", "$")
    return f"{before}({core}){after}"


def _score(branch: str) -> str:
    return " + ".join(f"CASE WHEN regexp_matches(t, '{_duck(r.pattern)}') THEN {r.weight} ELSE 0.0 END" for r in classify.RULES if r.branch == branch)


FOLDED = "replace(lower(trim(text)), 'և', 'եւ')"
CLASSIFIED = f"""WITH x AS (SELECT doc_id, lang, source, {FOLDED} AS t FROM documents WHERE text IS NOT NULL),
s AS (SELECT doc_id, lang, source, CAST({_score('western')} AS DOUBLE) AS western, CAST({_score('eastern')} AS DOUBLE) AS eastern, CAST({_score('classical')} AS DOUBLE) AS classical FROM x)
SELECT *, CASE WHEN western + eastern + classical = 0 THEN 'inconclusive' WHEN classical >= 3 AND classical >= western AND classical >= eastern THEN 'likely_classical'
 WHEN western = eastern THEN 'inconclusive' WHEN western > eastern THEN 'likely_western' ELSE 'likely_eastern' END AS label,
 CASE WHEN western + eastern + classical = 0 THEN 0.0 WHEN classical >= 3 AND classical >= western AND classical >= eastern THEN least(round(classical / (western + eastern + classical), 3), 0.99)
 WHEN western = eastern THEN 0.5 ELSE round(abs(western - eastern) / (western + eastern), 3) END AS confidence FROM s"""


def _classified(spark, d):
    return classify.classified(_docs(spark, d).select("doc_id", "lang", "source", "text")).drop("text")


@query(CLASSIFIED)
def branch_classification(spark, d):
    return _classified(spark, d)


@query(f"SELECT label, count(*) AS documents FROM ({CLASSIFIED}) GROUP BY label")
def label_counts(spark, d):
    return _classified(spark, d).groupBy("label").agg(F.count(F.lit(1)).alias("documents"))


@query(f"""
SELECT doc_id, label, confidence FROM ({CLASSIFIED})
WHERE western + eastern + classical <> 0 AND (label = 'inconclusive' OR confidence < 0.35 OR abs(western - eastern) < 2.0)
""")
def review_queue(spark, d):
    c = _classified(spark, d)
    unsure = classify.needs_review(F.col("western"), F.col("eastern"), F.col("classical"), F.col("label"), F.col("confidence"))
    return c.where(unsure).select("doc_id", "label", "confidence")


@query(f"""
WITH c AS (SELECT lang, label FROM ({CLASSIFIED}) WHERE lang IN ('hyw', 'hye')),
k AS (SELECT count(*) FILTER (lang = 'hyw' AND label = 'likely_western') AS tp, count(*) FILTER (lang = 'hye' AND label = 'likely_western') AS fp,
 count(*) FILTER (lang = 'hyw' AND label <> 'likely_western') AS fn, count(*) FILTER (lang = 'hye' AND label <> 'likely_western') AS tn FROM c)
SELECT tp, fp, fn, tn, round(tp / nullif(tp + fp, 0), 6) AS "precision", round(tp / nullif(tp + fn, 0), 6) AS recall, round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1 FROM k
""")
def classifier_evaluation(spark, d):
    c = _classified(spark, d).where("lang in ('hyw', 'hye')")
    is_w, said = F.col("lang") == "hyw", F.col("label") == "likely_western"
    k = c.agg(F.count_if(is_w & said).alias("tp"), F.count_if(~is_w & said).alias("fp"), F.count_if(is_w & ~said).alias("fn"), F.count_if(~is_w & ~said).alias("tn"))
    part = lambda a, b: F.round(F.col(a) / F.nullif(F.col(a) + F.col(b), F.lit(0)), 6)
    return k.select("tp", "fp", "fn", "tn", part("tp", "fp").alias("precision"), part("tp", "fn").alias("recall"), F.round(2 * F.col("tp") / F.nullif(2 * F.col("tp") + F.col("fp") + F.col("fn"), F.lit(0)), 6).alias("f1"))


RULE_ROWS = ", ".join(f"('{r.rule_id}', '{r.branch}', CAST({r.weight} AS DOUBLE), '{_duck(r.pattern)}')" for r in classify.RULES)


@query(f"""
WITH r(rule_id, branch, weight, p) AS (VALUES {RULE_ROWS}), x AS (SELECT doc_id, {FOLDED} AS t FROM documents WHERE text IS NOT NULL)
SELECT doc_id, rule_id, branch, weight, regexp_extract(t, p, 1) AS matched_text FROM x, r WHERE regexp_matches(t, p)
""")
def classification_evidence(spark, d):
    folded = _docs(spark, d).select("doc_id", F.explode(F.array(classify.folded(F.col("text")))).alias("t"))
    rows = folded.select("doc_id", F.explode(classify.evidence(F.col("t"))).alias("e"))
    return rows.select("doc_id", "e.rule_id", "e.branch", "e.weight", "e.matched_text")


@query("""
SELECT document_id, CASE replace(replace(lower(trim(internal_language_branch)), '_', '-'), ' ', '-') WHEN 'hye-w' THEN 'hye-w' WHEN 'western-armenian' THEN 'hye-w' WHEN 'western' THEN 'hye-w' WHEN 'hyw' THEN 'hye-w'
 WHEN 'hye-e' THEN 'hye-e' WHEN 'eastern-armenian' THEN 'hye-e' WHEN 'eastern' THEN 'hye-e' WHEN 'hye' THEN 'hye-e' WHEN 'eng' THEN 'eng' WHEN 'english' THEN 'eng' END AS branch
FROM document_records
""")
def branch_aliases(spark, d):
    return table(spark, d, "document_records").select("document_id", classify.branch_alias(F.col("internal_language_branch")).alias("branch"))


@query(f"""
WITH s AS (SELECT doc_id, {_n('Ա-և')} AS a, {_n('Ա-և')} + {_n('A-Za-zÀ-ɏ')} + length(regexp_replace(text, '[[:space:]\\s' || 'Ա-և։֊A-Za-zÀ-ɏ' || '\\p{{Nd}}' || '.,;:!?"''()\\[\\]{{}}/@#$%^&*+=~`|\\\\_<>-]', '', 'g')) AS l, wa_score FROM documents WHERE text IS NOT NULL)
SELECT doc_id, CASE WHEN (CASE WHEN l > 0 THEN a / l ELSE 0.0 END) < 0.35 THEN 'eng' WHEN coalesce(wa_score, 0.0) >= 5 THEN 'hye-w' ELSE 'hye-e' END AS branch FROM s
""")
def branch_of_score(spark, d):
    return _docs(spark, d).select("doc_id", classify.branch_of_score(F.col("wa_score"), F.col("text")).alias("branch"))


@query(r"""
SELECT text_id, trim(regexp_replace(regexp_replace(regexp_replace(full_text, '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g'), '(?m)^[ \t]*[-—–\[(]*[ \t]*[0-9]{1,4}[ \t]*[-—–\])]*[ \t]*$\n?', '', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), ' ') AS text
FROM (SELECT DISTINCT text_id, full_text FROM archive_org_texts) WHERE full_text IS NOT NULL
""")
def scans_cleaned(spark, d):
    rows = table(spark, d, "archive_org_texts").where("full_text is not null").select("text_id", "full_text").distinct()
    return rows.select("text_id", X.scan_cleaned(F.col("full_text")).alias("text"))


@query(r"""
WITH t AS (SELECT DISTINCT article_id, coalesce(trim(title), '') AS t FROM newspaper_articles),
c AS (SELECT article_id, t, length(regexp_replace(t, '[^\p{L}]', '', 'g')) AS l, length(regexp_replace(t, '[^Ա-և]', '', 'g')) AS a, length(regexp_replace(t, '[^0-9]', '', 'g')) AS g FROM t)
SELECT article_id, array_to_string(list_filter([CASE WHEN length(t) < 3 THEN 'too_short' END, CASE WHEN length(t) > 160 THEN 'too_long' END, CASE WHEN (CASE WHEN l > 0 THEN a / l ELSE 0 END) < 0.6 THEN 'low_script_ratio' END,
 CASE WHEN g > length(t) / 2 THEN 'mostly_digits' END, CASE WHEN regexp_matches(t, 'https?://|www\.') THEN 'has_url' END], lambda x: x IS NOT NULL), ',') AS issues FROM c
""")
def title_plausibility(spark, d):
    rows = table(spark, d, "newspaper_articles").select("article_id", F.coalesce(F.trim("title"), F.lit("")).alias("t")).distinct()
    return rows.select("article_id", F.array_join(X.title_issues(F.col("t")), ",").alias("issues"))
