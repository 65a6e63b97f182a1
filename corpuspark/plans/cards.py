"""The whole metric card, signed scores and what hangs on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuspark.functions import metrics, text as X
from corpuspark.operators import classify, clustering, frequency
from corpuspark.plans.frequency import TOKENS
from corpuspark.plans.registry import query
from corpuspark.plans.texts import CLASSIFIED, WORDS, _duck
from corpuspark.session import broadcast_if_small, cut, spread, table


def _docs(spark, d):
    return spread(table(spark, d, "documents").where("text is not null"))


def _with_words(spark, d, *others):
    """Texts with their words from a generator, so that every use reads them and none makes them again."""
    return _docs(spark, d).select("doc_id", "text", *others, F.explode(F.array(X.words(F.col("text")))).alias("w"))


def _all(patterns, of="text") -> str:
    return "(" + " + ".join(f"len(regexp_extract_all({of}, '{p}'))" for p in patterns) + ")"


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


NUCLEI = f"coalesce(list_sum(list_transform(w, lambda x: greatest(1, len(regexp_extract_all(x, 'ու|[{metrics.VOWELS}]'))))), 0)"
SENTENCES = "greatest(1, len(list_filter(regexp_split_to_array(text, '[։?!:]+'), lambda x: regexp_matches(x, '[Ա-Ֆա-և]{2,}'))))"
BASE = f"WITH t AS (SELECT doc_id, text, lang, {WORDS} AS w FROM documents WHERE text IS NOT NULL)"


@query(f"""
{BASE}, k AS (SELECT doc_id, len(w) AS n, {SENTENCES} AS s, len(list_filter(regexp_extract_all(text, '[Ա-և]+'), lambda x: list_contains({_list(metrics.SUBORDINATORS)}, x))) AS o, {NUCLEI} AS v FROM t)
SELECT doc_id, round(n / s, 2) AS sentence_length, round(1 + o / s, 2) AS clauses, round(0.39 * n / s + 11.8 * CASE WHEN n > 0 THEN v / n ELSE 2.0 END - 15.59 + 1e-9, 2) AS grade FROM k
""")
def syntactic_metrics(spark, d):
    return _with_words(spark, d).select("doc_id", *metrics.syntax(F.col("text"), F.col("w")))


@query(f"""
WITH t AS ({TOKENS}), b AS (SELECT word, count(*) / sum(count(*)) OVER () AS q FROM t WHERE lang = 'hyw' GROUP BY word), c AS (SELECT doc_id, word, count(*) AS n FROM t GROUP BY ALL),
s AS (SELECT doc_id, sum(n) AS n, sum(CASE WHEN word IN ({', '.join(f"'{x}'" for x in metrics.PRONOUNS)}) THEN n ELSE 0 END) AS p, sum(n * q) / sum(CASE WHEN q > 0 THEN n END) AS f FROM c LEFT JOIN b USING (word) GROUP BY doc_id)
SELECT d.doc_id, round(coalesce(p / s.n, 0.0), 6) AS pronouns, round(coalesce(f, 0.0), 8) AS mean_frequency FROM documents d LEFT JOIN s USING (doc_id) WHERE d.text IS NOT NULL
""")
def semantic_metrics(spark, d):
    """Pronouns among the words, and the mean frequency of the known words in the western part of the corpus."""
    docs = _docs(spark, d)
    c = cut(frequency.word_counts(docs, ["doc_id", "lang"]))
    base = c.where("lang = 'hyw'").groupBy("word").agg(F.sum("n").alias("m"))
    base = base.crossJoin(F.broadcast(base.agg(F.sum("m").alias("all")))).select("word", (F.col("m") / F.col("all")).alias("q"))
    s = c.join(base, "word", "left").groupBy("doc_id").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("word").isin(*metrics.PRONOUNS), F.col("n")).otherwise(0)).alias("p"), (F.sum(F.col("n") * F.col("q")) / F.sum(F.when(F.col("q") > 0, F.col("n")))).alias("f")
    )
    return docs.select("doc_id").join(s, "doc_id", "left").select("doc_id", F.round(F.coalesce(F.col("p") / F.col("n"), F.lit(0.0)), 6).alias("pronouns"), F.round(F.coalesce("f", F.lit(0.0)), 8).alias("mean_frequency"))


ENDS = "len(list_filter(w, lambda x: suffix(x, '{}')))"


@query(f"""
{BASE}, k AS (SELECT doc_id, {ENDS.format('եմ')} AS em, {ENDS.format('ում')} AS um, len(w) AS n, len(list_distinct(w)) AS v FROM t),
r AS (SELECT doc_id, um, round(CASE WHEN em + um > 0 THEN um / (em + um) ELSE 0.0 END, 4) AS mixed, round(CASE WHEN n > 0 THEN v / n ELSE 0.0 END, 4) AS variety FROM k)
SELECT doc_id, round(greatest(0.0, least(1.0, 1.0 - CASE WHEN um > 2 THEN 0.1 * least(1.0, um / 10) ELSE 0.0 END - CASE WHEN mixed > 0.05 THEN 0.05 ELSE 0.0 END - CASE WHEN variety < 0.5 THEN 0.05 ELSE 0.0 END)), 4) AS purity,
 array_to_string(list_filter([CASE WHEN um > 2 THEN 'um_forms' END, CASE WHEN mixed > 0.05 THEN 'code_switching' END, CASE WHEN variety < 0.5 THEN 'low_diversity' END], lambda x: x IS NOT NULL), ',') AS issues FROM r
""")
def purity_flags(spark, d):
    return _with_words(spark, d).select("doc_id", metrics.purity(F.col("w")).alias("x")).select("doc_id", "x.purity", "x.issues")


@query(f"""
{BASE}, c AS (SELECT doc_id, x, count(*) AS f FROM (SELECT doc_id, unnest(w) AS x FROM t) GROUP BY ALL), q AS (SELECT doc_id, sum(f * f) AS q FROM c GROUP BY doc_id)
SELECT doc_id, round(CASE WHEN len(w) > 0 THEN 10000.0 * (q - len(w)) / (len(w) * len(w)) ELSE 0.0 END, 2) AS yule_staging,
 round(CASE WHEN len(w) > 0 THEN list_sum(list_transform(w, lambda x: greatest(1, len(regexp_extract_all(x, '[{metrics.VOWELS}]'))))) / len(w) ELSE 1.0 END, 6) AS vowels_a_word,
 round(CASE WHEN {_all(metrics.STAGING_REFORMED)} > 0 THEN {_all(metrics.STAGING_CLASSICAL)} / {_all(metrics.STAGING_REFORMED)} ELSE {_all(metrics.STAGING_CLASSICAL)} END, 4) AS ratio_staging
FROM t LEFT JOIN q USING (doc_id)
""")
def staging_metrics(spark, d):
    return _with_words(spark, d).select("doc_id", *metrics.staging(F.col("text"), F.col("w")))


@query(f"SELECT doc_id, round(CASE WHEN {_all(metrics.SPELLING_CLASSICAL)} + {_all(metrics.SPELLING_REFORMED)} > 0 THEN {_all(metrics.SPELLING_CLASSICAL)} / ({_all(metrics.SPELLING_CLASSICAL)} + {_all(metrics.SPELLING_REFORMED)}) ELSE 0.5 END, 6) AS score FROM documents WHERE text IS NOT NULL")
def spelling_scores(spark, d):
    return _docs(spark, d).select("doc_id", metrics.spelling_score(F.col("text")).alias("score"))


def _share(x: str) -> str:
    return f"round(CASE WHEN len(w) > 0 THEN {x} / len(w) ELSE 0.0 END, 6)"


@query(f"""
{BASE} SELECT doc_id, {', '.join(f"{_share(ENDS.format(s))} AS suffix_{k}" for k, s in metrics.SUFFIXES.items())}, {_share("len(list_filter(w, lambda x: suffix(x, 'ան') AND NOT suffix(x, 'եան')))")} AS suffix_an,
 {', '.join(f"{_share(f'len(list_filter(w, lambda x: x = {chr(39)}{s}{chr(39)}))')} AS prefix_{k}" for k, s in metrics.PARTICLES.items())},
 {_share("len(list_filter(w, lambda x: prefix(x, 'չ') AND length(x) > 1))")} AS prefix_ch, {_share("len(list_filter(w, lambda x: prefix(x, 'կ՚')))")} AS prefix_g_elided FROM t
""")
def morphological_shares(spark, d):
    return _with_words(spark, d).select("doc_id", *metrics.suffix_shares(F.col("w")))


@query(f"""
{BASE} SELECT doc_id, {', '.join(f"array_to_string(list_filter(w, lambda x: suffix(x, '{s}')), ' ') AS {k}" for k, s in (('ean', 'եան'), ('aran', 'արան'), ('akan', 'ական'), ('utyun', 'ութիւն')))},
 array_to_string(list_filter(w, lambda x: suffix(x, 'ան') AND NOT suffix(x, 'եան')), ' ') AS an FROM t
""")
def suffix_word_lists(spark, d):
    rows = _with_words(spark, d).select("doc_id", *metrics.suffix_words(F.col("w")))
    return rows.select("doc_id", *[F.array_join(k, " ").alias(k) for k in ("ean", "an", "aran", "akan", "utyun")])


def _hits(pattern: str, of: str) -> str:
    return f"len(regexp_extract_all({of}, '(?i){_duck(pattern, fold=False)}'))"


def _signed(of: str = "text") -> str:
    parts = [f"{w} * least(floor((length({of}) - length(replace({of}, '{x}', ''))) / {len(x)}), 10)" for x, w in classify.SIGNED_LITERALS]
    return " + ".join(parts + [f"{w} * least({_hits(p, of)}, {most})" for p, w, most in classify.SIGNED_PATTERNS])


@query(f"SELECT doc_id, round({_signed()}, 4) AS score, {_signed()} >= 5 AS western FROM documents WHERE text IS NOT NULL")
def signed_scores(spark, d):
    rows = _docs(spark, d).select("doc_id", F.explode(F.array(classify.signed_score(F.col("text")))).alias("s"))
    return rows.select("doc_id", F.round("s", 4).alias("score"), (F.col("s") >= classify.WESTERN_SCORE).alias("western"))


def _ratio(of: str) -> str:
    return f"(CASE WHEN length(regexp_replace({of}, '[^\\p{{L}}]', '', 'g')) > 0 THEN length(regexp_replace({of}, '[^Ա-և]', '', 'g')) / length(regexp_replace({of}, '[^\\p{{L}}]', '', 'g')) ELSE 0.0 END)"


@query(rf"""
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
h AS (SELECT doc_id, text, l, greatest(len(l) // 2, 1) AS h FROM l),
p AS (SELECT doc_id, text, array_to_string(l[1 : h], chr(10)) AS a, array_to_string(l[h + 1 : len(l)], chr(10)) AS b, array_to_string(list_filter(l, lambda x: trim(x, ' ') = '' OR {_ratio('x')} >= 0.5), chr(10)) AS k FROM h),
o AS (SELECT doc_id, text, CASE WHEN {_ratio('a')} >= 0.5 AND {_ratio('b')} < 0.2 THEN a WHEN {_ratio('b')} >= 0.5 AND {_ratio('a')} < 0.2 THEN b ELSE k END AS o FROM p),
c AS (SELECT doc_id, text, CASE WHEN length(o) >= 100 AND {_ratio('o')} >= 0.35 THEN trim(o, ' ') END AS c FROM o),
s AS (SELECT doc_id, text, c, round({_signed('c')}, 2) AS s FROM c)
SELECT doc_id, CASE WHEN length(text) < 100 THEN 'short' WHEN c IS NULL THEN 'non_armenian' WHEN s < 5 THEN 'non_western' ELSE 'kept' END AS outcome,
 CASE WHEN length(text) < 100 OR c IS NULL THEN NULL WHEN length(c) / greatest(length(text), 1) < 0.6 THEN 'bilingual_split' WHEN length(c) / greatest(length(text), 1) < 0.95 THEN 'line_removal' ELSE 'none' END AS extraction,
 CASE WHEN length(text) < 100 OR c IS NULL THEN 0.0 ELSE s END AS score FROM s
""")
def filter_outcomes(spark, d):
    return classify.filter_outcomes(_docs(spark, d).select("doc_id", "text")).drop("text")


EAST = [r for r in classify.RULES if r.branch == "eastern"]
OLD = [r for r in classify.RULES if r.rule_id.startswith(classify.CLASSICAL_IDS)]
OWN = [r for r in classify.RULES if r.branch == "western" and classify.VOCABULARY_IDS in r.rule_id]


def _sum(rules) -> str:
    return "(" + " + ".join(f"len(regexp_extract_all(f, '{_duck(r.pattern)}'))" for r in rules) + ")"


@query(f"""
WITH x AS (SELECT doc_id, text, replace(lower(text), 'և', 'եւ') AS f FROM documents WHERE text IS NOT NULL),
k AS (SELECT doc_id, CASE WHEN length(text) > 0 THEN length(regexp_replace(text, '[^԰-֏]', '', 'g')) / length(text) ELSE 0.0 END AS ratio, {_sum(EAST)} AS e, {_sum(OLD)} AS c, {_sum(OWN)} AS o, greatest(2, length(text) // 50) AS need, {_signed()} AS s FROM x),
i AS (SELECT *, list_filter([CASE WHEN ratio < 0.7 THEN 'low_script' END, CASE WHEN e > 0 THEN 'eastern_markers' END, CASE WHEN c < need THEN 'few_classical_markers' END, CASE WHEN o = 0 THEN 'no_own_vocabulary' END, CASE WHEN s < 5 THEN 'low_score' END], lambda x: x IS NOT NULL) AS i FROM k)
SELECT doc_id, len(i) = 0 AS passed, array_to_string(i, ',') AS issues, CAST(e AS INTEGER) AS eastern_markers, CAST(c AS INTEGER) AS classical_markers, CAST(o AS INTEGER) AS own_words, round(ratio, 4) AS script_ratio FROM i
""")
def generated_text_checks(spark, d):
    """Each text judged as if a model had written it."""
    return classify.generated_checks(_docs(spark, d).select("doc_id", "text")).drop("text")


@query(f"""
WITH t AS ({TOKENS}), l AS (SELECT lower(lemma) AS word, min(internal_language_code) AS language FROM lexicon_entries WHERE lemma IS NOT NULL AND internal_language_code IS NOT NULL GROUP BY 1),
c AS (SELECT doc_id, word, language, count(*) AS n FROM t LEFT JOIN l USING (word) GROUP BY ALL)
SELECT doc_id, CAST(sum(n) AS BIGINT) AS words, CAST(coalesce(sum(n) FILTER (language IS NOT NULL), 0) AS BIGINT) AS known, round(coalesce(sum(n) FILTER (language IS NOT NULL), 0) / sum(n), 6) AS ratio,
 count(*) FILTER (language IS NOT NULL) AS different, count(DISTINCT language) AS languages FROM c GROUP BY doc_id
""")
def loanword_report(spark, d):
    """Words of a lexicon of languages in each text; where several languages claim a word the first by name has it."""
    lexicon = table(spark, d, "lexicon_entries").where("lemma is not null and internal_language_code is not null").groupBy(F.lower("lemma").alias("word")).agg(F.min("internal_language_code").alias("language"))
    c = frequency.word_counts(_docs(spark, d), ["doc_id"]).join(broadcast_if_small(cut(lexicon), 500_000), "word", "left")
    known = F.col("language").isNotNull()
    total = F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0))
    return c.groupBy("doc_id").agg(F.sum("n").alias("words"), total.alias("known"), F.round(total / F.sum("n"), 6).alias("ratio"), F.count_if(known).alias("different"), F.countDistinct("language").alias("languages"))


@query(f"""
WITH t AS ({TOKENS}), l AS (SELECT DISTINCT lower(lemma) AS word FROM lexicon_entries WHERE lemma IS NOT NULL), c AS (SELECT doc_id, word, count(*) AS n FROM t GROUP BY ALL)
SELECT doc_id, CAST(sum(n) AS BIGINT) AS possible, count(*) AS different, min(word) AS first_word FROM c WHERE word NOT IN (SELECT word FROM l) GROUP BY doc_id
""")
def possible_loanwords(spark, d):
    known = broadcast_if_small(cut(table(spark, d, "lexicon_entries").where("lemma is not null").select(F.lower("lemma").alias("word")).distinct()), 500_000)
    c = frequency.word_counts(_docs(spark, d), ["doc_id"]).join(known, "word", "left_anti")
    return c.groupBy("doc_id").agg(F.sum("n").alias("possible"), F.count(F.lit(1)).alias("different"), F.min("word").alias("first_word"))


GRID = [(a, t) for a in (0.5, 0.75, 1.0, 1.25, 1.5) for t in (0.0, 1.0, 2.0, 4.0, 6.0)]


@query(f"""
WITH c AS (SELECT western, eastern, lang = 'hyw' AS is_w FROM ({{classified}}) WHERE lang IN ('hyw', 'hye')), g(eastern_weight, threshold) AS (VALUES {', '.join(str(x) for x in GRID)}),
k AS (SELECT eastern_weight, threshold, count(*) FILTER (is_w AND western - eastern_weight * eastern > threshold) AS tp, count(*) FILTER (NOT is_w AND western - eastern_weight * eastern > threshold) AS fp, count(*) FILTER (is_w AND NOT western - eastern_weight * eastern > threshold) AS fn FROM c, g GROUP BY ALL)
SELECT CAST(eastern_weight AS DOUBLE) AS eastern_weight, CAST(threshold AS DOUBLE) AS threshold, tp, fp, fn, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM k
""".replace("{classified}", CLASSIFIED))
def weight_grid(spark, d):
    """F1 of the western class for each weight of the eastern score and threshold: counts from one pass, the grid inside each row's aggregate."""
    docs = classify.classified(_docs(spark, d).where("lang in ('hyw', 'hye')").select("lang", "text")).select((F.col("lang") == "hyw").alias("is_w"), "western", "eastern")
    cells = docs.groupBy("is_w", "western", "eastern").agg(F.count(F.lit(1)).alias("n"))  # few different scores, whatever the texts
    grid = F.explode(F.array(*[F.struct(F.lit(a).alias("eastern_weight"), F.lit(t).alias("threshold")) for a, t in GRID]))
    rows = cells.select("*", grid.alias("g")).select("*", "g.*")
    said = F.col("western") - F.col("eastern_weight") * F.col("eastern") > F.col("threshold")
    n = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    k = rows.groupBy("eastern_weight", "threshold").agg(n(F.col("is_w") & said).alias("tp"), n(~F.col("is_w") & said).alias("fp"), n(F.col("is_w") & ~said).alias("fn"))
    return k.withColumn("f1", F.round(F.coalesce(2 * F.col("tp") / F.nullif(2 * F.col("tp") + F.col("fp") + F.col("fn"), F.lit(0)), F.lit(0.0)), 6))


SPLIT = r"regexp_split_to_array(text, '\n[\s]*\n')"


@query(rf"""
WITH s AS (SELECT doc_id, unnest({SPLIT}) AS s FROM documents WHERE text IS NOT NULL), g AS (SELECT doc_id, s, {_signed('s')} AS v, {_ratio('s')} AS a FROM s WHERE length(trim(s)) >= 60),
k AS (SELECT doc_id, s, CASE WHEN a < 0.15 THEN 'non_armenian' WHEN v >= 3 THEN 'western' WHEN v <= -1 THEN 'eastern' ELSE 'ambiguous' END AS tag FROM g)
SELECT doc_id, count(*) AS segments, count(*) FILTER (tag = 'western') AS western, count(*) FILTER (tag = 'eastern') AS eastern, count(*) FILTER (tag = 'ambiguous') AS ambiguous,
 CAST(coalesce(sum(length(s)) FILTER (tag = 'western'), 0) AS BIGINT) AS western_chars, CAST(sum(length(s)) AS BIGINT) AS chars,
 round(CASE WHEN count(*) FILTER (tag <> 'non_armenian') > 0 THEN count(*) FILTER (tag = 'eastern') / count(*) FILTER (tag <> 'non_armenian') ELSE 0.0 END, 6) AS eastern_ratio,
 count(*) FILTER (tag = 'western') > 0 AND count(*) FILTER (tag = 'eastern') > 0 AS is_mixed FROM k GROUP BY doc_id
""")
def branch_reports(spark, d):
    """Paragraphs of each text by their signed score, and whether the text mixes the branches."""
    s = _docs(spark, d).select("doc_id", F.explode(F.split("text", r"\n\s*\n")).alias("s")).where(F.length(F.trim("s")) >= 60)
    letters = F.regexp_count("s", F.lit(r"\p{L}"))
    g = s.select("doc_id", F.length("s").alias("n"), F.explode(F.array(classify.signed_score(F.col("s")))).alias("v"), X.share(F.regexp_count("s", F.lit("[Ա-և]")), letters).alias("a"))
    tag = F.when(F.col("a") < 0.15, "non_armenian").when(F.col("v") >= 3, "western").when(F.col("v") <= -1, "eastern").otherwise("ambiguous")
    k = g.select("doc_id", "n", tag.alias("tag"))
    many = lambda t: F.count_if(F.col("tag") == t)
    own = F.count_if(F.col("tag") != "non_armenian")
    return k.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("segments"), many("western").alias("western"), many("eastern").alias("eastern"), many("ambiguous").alias("ambiguous"),
        F.coalesce(F.sum(F.when(F.col("tag") == "western", F.col("n"))), F.lit(0)).alias("western_chars"), F.sum("n").alias("chars"),
        F.round(F.when(own > 0, many("eastern") / own).otherwise(0.0), 6).alias("eastern_ratio"), ((many("western") > 0) & (many("eastern") > 0)).alias("is_mixed"),
    )


@query(f"""
WITH c AS (SELECT label, lang FROM ({{classified}}))
SELECT lang, count(*) AS documents, count(*) FILTER (label = 'likely_eastern') AS eastern, round(count(*) FILTER (label = 'likely_eastern') / greatest(count(*), 1), 6) AS ratio, count(*) FILTER (label = 'likely_eastern') / greatest(count(*), 1) > 0.01 AS warn FROM c WHERE lang IS NOT NULL GROUP BY lang
""".replace("{classified}", CLASSIFIED))
def eastern_audit(spark, d):
    c = classify.classified(_docs(spark, d).where("lang is not null").select("lang", "text"))
    share = F.count_if(F.col("label") == "likely_eastern") / F.greatest(F.count(F.lit(1)), F.lit(1))
    return c.groupBy("lang").agg(F.count(F.lit(1)).alias("documents"), F.count_if(F.col("label") == "likely_eastern").alias("eastern"), F.round(share, 6).alias("ratio"), (share > 0.01).alias("warn"))


@query(f"""
SELECT doc_id, 'hy' AS code, CASE label WHEN 'likely_western' THEN 'hye-w' WHEN 'likely_eastern' THEN 'hye-e' WHEN 'likely_classical' THEN 'xcl' END AS branch, CASE WHEN label = 'likely_eastern' THEN 'eastern' ELSE 'western' END AS corrector FROM ({{classified}})
""".replace("{classified}", CLASSIFIED))
def internal_tags(spark, d):
    c = classify.classified(_docs(spark, d).select("doc_id", "text"))
    return c.select("doc_id", classify.internal_tags(F.col("label")).alias("t"), classify.variant(F.col("label")).alias("corrector")).select("doc_id", "t.code", "t.branch", "corrector")


@query()
def text_clusters(spark, d):
    """Density clusters of the texts by ten features of their cards, every text in one or in none."""
    w, t = F.col("w"), F.col("text")
    n = F.greatest(F.size(w), F.lit(1))
    ends = lambda s: metrics.how_many(w, lambda x: F.endswith(x, F.lit(s))) / n
    features = F.array(
        metrics.ttr(w), metrics.sttr(w), F.log1p(F.size(w)), metrics.spelling_score(t), ends("եմ"), ends("ում"), ends("եան"), ends("ութիւն"),
        metrics.how_many(w, lambda x: x.isin(*metrics.PRONOUNS)) / n, F.aggregate(w, F.lit(0.0), lambda a, x: a + F.length(x)) / n,
    )
    return clustering.clustered(_with_words(spark, d).select("doc_id", features.alias("f")), "doc_id", "f", dimensions=2)
