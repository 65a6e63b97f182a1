"""Further reference operators: views, segments, contexts, variants, vocabulary, authors and scans."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.window import Window

from corpuspark.functions import morphology, text as X
from corpuspark.operators import correction, frequency, order
from corpuspark.plans.registry import query
from corpuspark.plans.frequency import TOKENS
from corpuspark.session import broadcast_if_small, spread, table


def _docs(spark, d):
    return spread(table(spark, d, "documents").where("text is not null"))


def _or(c: str, other: str = "") -> Column:
    return F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(other))


@query("""
SELECT doc_id, coalesce(nullif(source, ''), '') AS source, coalesce(nullif(title, ''), '') AS title, coalesce(nullif(url, ''), '') AS url, coalesce(nullif(lang, ''), 'unknown') AS lang,
 coalesce(nullif(writing_category, ''), '') AS writing_category, length(text) AS char_count, sha256(text) AS content_hash FROM documents WHERE text IS NOT NULL AND text <> ''
""")
def export_rows(spark, d):
    docs = _docs(spark, d).where("text <> ''")
    return docs.select("doc_id", *[_or(c).alias(c) for c in ("source", "title", "url")], _or("lang", "unknown").alias("lang"), _or("writing_category").alias("writing_category"), F.length("text").cast("bigint").alias("char_count"), F.sha2("text", 256).alias("content_hash"))


@query("""
WITH v AS (SELECT DISTINCT document_id, CASE internal_language_branch WHEN 'hye-w' THEN 'wa' WHEN 'hye-e' THEN 'ea' WHEN 'eng' THEN 'eng' ELSE 'unknown' END AS view FROM document_records)
SELECT view, count(*) AS documents, round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS pct FROM v GROUP BY view
""")
def branch_views(spark, d):
    view = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for x in ("hye-w", "wa", "hye-e", "ea", "eng", "eng")]), F.col("internal_language_branch")), F.lit("unknown"))
    g = table(spark, d, "document_records").select("document_id", view.alias("view")).distinct().groupBy("view").agg(F.count(F.lit(1)).alias("documents"))
    return g.withColumn("pct", F.round(100.0 * F.col("documents") / F.sum("documents").over(Window.partitionBy(F.lit(0))), 1))


@query("""
WITH r AS (SELECT source, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM documents WHERE n_chars IS NOT NULL AND source IS NOT NULL)
SELECT source, max(n_chars) FILTER (i = n // 4) AS q1, max(n_chars) FILTER (i = n // 2) AS q2, max(n_chars) FILTER (i = 3 * n // 4) AS q3 FROM r GROUP BY source
""")
def length_quartiles(spark, d):
    """Order statistics from counted values, so no source is gathered."""
    values = table(spark, d, "documents").where("n_chars is not null and source is not null").groupBy("source", "n_chars").agg(F.count(F.lit(1)).alias("n"))
    r = order.running(values, "source", "n_chars")
    at = lambda k: F.min(F.when(F.col("upto") > F.floor(F.col("all") * k / 4), F.col("n_chars")))
    return r.groupBy("source").agg(at(1).alias("q1"), at(2).alias("q2"), at(3).alias("q3"))


@query("SELECT source, count(wa_score) AS n, round(avg(wa_score), 6) AS mean, round(coalesce(stddev_samp(wa_score), 0), 6) AS std FROM documents WHERE source IS NOT NULL GROUP BY source")
def score_summary(spark, d):
    return table(spark, d, "documents").where("source is not null").groupBy("source").agg(F.count("wa_score").alias("n"), F.round(F.avg("wa_score"), 6).alias("mean"), F.round(F.coalesce(F.stddev_samp("wa_score"), F.lit(0.0)), 6).alias("std"))


def _n(chars: str, of: str) -> str:
    return f"length(regexp_replace({of}, '[^{chars}]', '', 'g'))"


SEGMENTS = rf"""WITH s AS (SELECT doc_id, unnest(regexp_split_to_array(text, '\n[\s]*\n')) AS s FROM documents WHERE text IS NOT NULL),
k AS (SELECT doc_id, s, {' + '.join(f"len(regexp_extract_all(s, '{p}'))" for p in ('իւ', 'եա', 'ոյ'))} AS c, {' + '.join(f"len(regexp_extract_all(s, '{p}'))" for p in ('յու', 'յան', 'ույ'))} AS r FROM s WHERE length(s) >= 60)
SELECT doc_id, CASE WHEN r >= 3 AND c = 0 THEN 'eastern' WHEN r > 1.5 * c THEN 'eastern' WHEN c >= 3 THEN 'western' ELSE 'ambiguous' END AS tag, length(s) AS n FROM k"""


@query(f"SELECT tag, count(*) AS segments, CAST(sum(n) AS BIGINT) AS chars, count(DISTINCT doc_id) AS documents FROM ({SEGMENTS}) GROUP BY tag")
def segment_tags(spark, d):
    """Paragraphs tagged by their spelling."""
    rows = _docs(spark, d).select("doc_id", F.explode(F.split("text", r"\n\s*\n")).alias("s")).where(F.length("s") >= 60)
    count = lambda ps: sum((F.regexp_count("s", F.lit(p)) for p in ps), F.lit(0))
    k = rows.select("doc_id", F.length("s").alias("n"), count(("իւ", "եա", "ոյ")).alias("c"), count(("յու", "յան", "ույ")).alias("r"))
    tag = F.when((F.col("r") >= 3) & (F.col("c") == 0), "eastern").when(F.col("r") > 1.5 * F.col("c"), "eastern").when(F.col("c") >= 3, "western").otherwise("ambiguous")
    return k.groupBy(tag.alias("tag")).agg(F.count(F.lit(1)).alias("segments"), F.sum("n").alias("chars"), F.countDistinct("doc_id").alias("documents"))


@query(rf"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents WHERE text IS NOT NULL), k AS (SELECT doc_id, l, {_n('Ա-և', 'l')} AS a, {_n(r'\p{L}', 'l')} AS n FROM l WHERE trim(l) <> '')
SELECT doc_id, count(*) AS lines, count(*) FILTER (n > 0 AND a >= 0.5 * n) AS armenian, CAST(coalesce(sum(length(l)) FILTER (n > 0 AND a >= 0.5 * n), 0) AS BIGINT) AS chars FROM k GROUP BY doc_id
""")
def armenian_lines(spark, d):
    rows = _docs(spark, d).select("doc_id", F.explode(F.split("text", "\n")).alias("l")).where(F.trim("l") != "")
    rows = rows.select("doc_id", F.length("l").alias("chars"), X.count_of(F.col("l"), "[Ա-և]").alias("a"), X.count_of(F.col("l"), r"\p{L}").alias("n"))
    ok = (F.col("n") > 0) & (F.col("a") >= 0.5 * F.col("n"))
    return rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("lines"), F.count_if(ok).alias("armenian"), F.coalesce(F.sum(F.when(ok, F.col("chars"))), F.lit(0)).alias("chars"))


KEYWORDS = ("մեծ", "նոր", "խոր")


@query(f"""
WITH t AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[Ա-Ֆա-և]+'), lambda x: length(x) >= 2) AS w FROM documents WHERE text IS NOT NULL)),
c AS (SELECT w[i] AS keyword, unnest(list_concat(w[greatest(i - 2, 1) : i - 1], w[i + 1 : i + 2])) AS word FROM t WHERE w[i] IN {KEYWORDS})
SELECT keyword, word, count(*) AS n FROM c GROUP BY ALL
""")
def keyword_contexts(spark, d):
    """Words within two places of a keyword, taken inside each text, without a join of positions."""
    rows = _docs(spark, d).where(F.lower("text").rlike("|".join(KEYWORDS))).select(X.words(F.col("text")).alias("w"))
    at = rows.select("w", F.explode(F.filter(F.transform("w", lambda x, i: F.when(x.isin(*KEYWORDS), i + 1)), lambda i: i.isNotNull())).alias("i"))
    first = F.greatest(F.col("i") - 2, F.lit(1))
    around = F.concat(F.slice("w", first, F.col("i") - first), F.slice("w", F.col("i") + 1, F.lit(2)))
    return at.select(F.element_at("w", F.col("i")).alias("keyword"), F.explode(around).alias("word")).groupBy("keyword", "word").agg(F.count(F.lit(1)).alias("n"))


FUNCTION_WORDS = ("եւ", "կը", "մը", "մէջ", "որ", "պիտի", "է", "են", "մեջ", "մի")


@query(f"""
WITH f AS (SELECT lang, list_filter(regexp_extract_all(lower(text), '[Ա-Ֆա-և]+'), lambda x: list_contains({list(FUNCTION_WORDS)}, x)) AS w FROM documents WHERE text IS NOT NULL),
p AS (SELECT lang, w, unnest(range(1, len(w))) AS i FROM f WHERE len(w) > 1)
SELECT lang, w[i] AS a, w[i + 1] AS b, count(*) AS n FROM p GROUP BY ALL
""")
def function_bigrams(spark, d):
    w = F.filter(X.words(F.col("text"), least=1), lambda x: x.isin(*FUNCTION_WORDS))
    rows = _docs(spark, d).select("lang", w.alias("w")).where(F.size("w") > 1)
    pairs = rows.select("lang", F.explode(F.zip_with(F.slice("w", F.lit(1), F.size("w") - 1), F.slice("w", F.lit(2), F.size("w")), lambda a, b: F.struct(a.alias("a"), b.alias("b")))).alias("p"))
    return pairs.groupBy("lang", "p.a", "p.b").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
WITH t AS ({TOKENS}), w AS (SELECT word, count(*) AS n FROM t WHERE lang = 'hyw' GROUP BY word), e AS (SELECT word AS eastern, count(*) AS m FROM t WHERE lang = 'hye' GROUP BY word),
p AS (SELECT word AS western, eastern, n, m FROM w JOIN e ON replace(replace(replace(word, 'ութիւն', 'ություն'), 'եւ', 'և'), 'ւ', 'վ') = eastern WHERE word <> eastern)
SELECT western, eastern, least(n, m) AS support, round(ln(1 + least(n, m)) * greatest(n, m) / (n + m), 6) AS score FROM p WHERE least(n, m) >= 2 ORDER BY score DESC, western, eastern LIMIT 40
""")
def variant_pairs(spark, d):
    """Spelling pairs of the branches by support and dominance, best 40."""
    docs = _docs(spark, d)
    w = frequency.word_counts(docs.where("lang = 'hyw'"), []).select(F.col("word").alias("western"), "n", X.reformed(F.col("word")).alias("eastern"))
    e = frequency.word_counts(docs.where("lang = 'hye'"), []).select(F.col("word").alias("eastern"), F.col("n").alias("m"))
    least = F.least("n", "m")
    p = w.join(e, "eastern").where("western <> eastern").where(least >= 2)
    return p.select("western", "eastern", least.alias("support"), F.round(F.log1p(least) * F.greatest("n", "m") / (F.col("n") + F.col("m")), 6).alias("score")).orderBy(F.desc("score"), "western", "eastern").limit(40)


@query(f"""
WITH t AS ({TOKENS}), b AS (SELECT word, count(*) / sum(count(*)) OVER () AS q FROM t GROUP BY word), c AS (SELECT doc_id, word, count(*) AS n FROM t GROUP BY ALL), s AS (SELECT doc_id, sum(n) AS total FROM c GROUP BY doc_id)
SELECT doc_id, round(sum((n / total) * ln((n / total) / q)), 5) AS kl FROM c JOIN s USING (doc_id) JOIN b USING (word) GROUP BY doc_id
""")
def divergence_from_corpus(spark, d):
    docs = _docs(spark, d)
    c = frequency.word_counts(docs, ["doc_id"])
    b = c.groupBy("word").agg(F.sum("n").alias("m"))
    b = b.crossJoin(F.broadcast(b.agg(F.sum("m").alias("all")))).select("word", (F.col("m") / F.col("all")).alias("q"))
    rows = c.join(b, "word")
    # p ln(p / q) summed over words, with the text's total factored out: one grouped pass
    s = rows.groupBy("doc_id").agg(F.sum("n").alias("t"), F.sum(F.col("n") * F.ln(F.col("n") / F.col("q"))).alias("x"))
    return s.select("doc_id", F.round(F.col("x") / F.col("t") - F.ln("t"), 5).alias("kl"))


@query(f"""
WITH t AS ({TOKENS}), l AS (SELECT DISTINCT lower(lemma) AS word FROM lexicon_entries WHERE lemma IS NOT NULL)
SELECT word, count(*) AS n, count(DISTINCT doc_id) AS documents FROM t WHERE word NOT IN (SELECT word FROM l) GROUP BY word HAVING count(*) >= 5
""")
def unknown_words(spark, d):
    lemmas = broadcast_if_small(table(spark, d, "lexicon_entries").where("lemma is not null").select(F.lower("lemma").alias("word")).distinct(), 500_000)
    c = frequency.word_counts(_docs(spark, d), ["doc_id"]).groupBy("word").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("documents"))
    return c.where("n >= 5").join(lemmas, "word", "left_anti")


SHORTER = "list_distinct(list_concat([word], list_transform(range(1, length(word) + 1), lambda i: substring(word, 1, i - 1) || substring(word, i + 1))))"


@query(f"""
WITH t AS ({TOKENS}), c AS (SELECT word, count(*) AS n FROM t WHERE text IS NOT NULL GROUP BY word), o AS (SELECT word, unnest({SHORTER}) AS form FROM c WHERE n <= 1 AND length(word) >= 3),
g AS (SELECT word AS correction, n, unnest({SHORTER}) AS form FROM c WHERE n >= 3 AND length(word) >= 3),
p AS (SELECT DISTINCT word, correction, n FROM o JOIN g USING (form) WHERE word <> correction AND CASE WHEN length(word) = length(correction) THEN len(list_filter(range(1, length(word) + 1), lambda i: word[i] <> correction[i])) = 1
 WHEN length(word) < length(correction) THEN form = word ELSE form = correction END)
SELECT word, arg_min(correction, {{'a': -n, 'b': correction}}) AS correction, max(n) AS n FROM p GROUP BY word
""")
def spelling_corrections(spark, d):
    return correction.corrections(frequency.word_counts(_docs(spark, d), []))


@query(r"""
WITH n AS (SELECT DISTINCT article_id, author, lower(trim(regexp_replace(regexp_replace(author, '[^\p{L}\s.-]', '', 'g'), '\s+', ' ', 'g'), ' ')) AS k FROM newspaper_articles WHERE author IS NOT NULL)
SELECT k AS name, count(DISTINCT article_id) AS articles, count(DISTINCT author) AS variants FROM n WHERE k <> '' GROUP BY k
""")
def author_groups(spark, d):
    rows = table(spark, d, "newspaper_articles").where("author is not null").select("article_id", "author", X.name_key(F.col("author")).alias("name")).where("name <> ''")
    return rows.groupBy("name").agg(F.countDistinct("article_id").alias("articles"), F.countDistinct("author").alias("variants"))


@query("""
WITH q AS (SELECT doc_id, unnest(regexp_extract_all(text, '«([^«»]{3,120})»', 1)) AS title FROM documents WHERE text IS NOT NULL)
SELECT lower(trim(title)) AS title, min(doc_id) AS doc_id, count(*) AS mentions FROM q WHERE trim(title) <> '' GROUP BY 1
""")
def quoted_titles(spark, d):
    rows = _docs(spark, d).select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("«([^«»]{3,120})»"), F.lit(1))).alias("title")).where(F.trim("title") != "")
    return rows.groupBy(F.lower(F.trim("title")).alias("title")).agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("mentions"))


@query(rf"""
WITH l AS (SELECT text_id, unnest(string_split(full_text, chr(10))) AS l FROM (SELECT DISTINCT text_id, full_text FROM archive_org_texts WHERE full_text IS NOT NULL)),
k AS (SELECT text_id, l, length(trim(l, ' ')) AS n, {_n('Ա-և', 'l')} AS a, {_n('A-Za-zÀ-ɏ', 'l')} AS b FROM l)
SELECT text_id, count(*) AS lines, count(*) FILTER (n >= 5 AND a < 0.3 * n AND b < 0.6 * n) AS garbage FROM k GROUP BY text_id
""")
def scan_garbage_lines(spark, d):
    rows = table(spark, d, "archive_org_texts").where("full_text is not null").select("text_id", "full_text").distinct()
    k = rows.select("text_id", F.explode(F.split("full_text", "\n")).alias("l")).select("text_id", F.length(F.trim("l")).alias("n"), X.count_of(F.col("l"), "[Ա-և]").alias("a"), X.count_of(F.col("l"), "[A-Za-zÀ-ɏ]").alias("b"))
    bad = (F.col("n") >= 5) & (F.col("a") < 0.3 * F.col("n")) & (F.col("b") < 0.6 * F.col("n"))
    return k.groupBy("text_id").agg(F.count(F.lit(1)).alias("lines"), F.count_if(bad).alias("garbage"))


def _values(rows) -> str:
    return ", ".join("(" + ", ".join("NULL" if x is None else f"'{x}'" for x in r) + ")" for r in rows)


ENDINGS = [(c, n, case, e) for c, ends in morphology.NOUN_CLASSES.items() for n, row in (("singular", ends), ("plural", morphology.PLURAL_ENDINGS)) for case, e in zip(morphology.CASES, row)]
VOWEL = f"regexp_matches(f, '[{morphology.VOWELS}]$|ու$')"


@query(f"""
WITH l AS (SELECT DISTINCT entry_id, lower(lemma) AS w FROM lexicon_entries WHERE lemma IS NOT NULL AND pos IN ('noun', 'N.')), e(noun_class, number, case_name, ending) AS (VALUES {_values(ENDINGS)}),
f AS (SELECT entry_id, noun_class, number, case_name, w || ending AS f FROM l, e)
SELECT entry_id, noun_class, number, case_name, 'bare' AS kind, f AS form FROM f UNION ALL SELECT entry_id, noun_class, number, case_name, 'definite', f || CASE WHEN {VOWEL} THEN 'ն' ELSE 'ը' END FROM f
UNION ALL SELECT entry_id, noun_class, number, case_name, 'indefinite', f || ' մը' FROM f WHERE number = 'singular' AND case_name = 'nominative'
""")
def declined_nouns(spark, d):
    """All forms of every noun in each of the four classes."""
    rows = table(spark, d, "lexicon_entries").where("lemma is not null and pos in ('noun', 'N.')").select("entry_id", F.lower("lemma").alias("w")).distinct()
    classes = F.explode(F.array(*[F.struct(F.lit(c).alias("noun_class"), morphology.declined(F.col("w"), c).alias("forms")) for c in morphology.NOUN_CLASSES]))
    forms = rows.select("entry_id", classes.alias("x")).select("entry_id", "x.noun_class", F.explode("x.forms").alias("f"))
    return forms.select("entry_id", "noun_class", "f.number", F.col("f.case").alias("case_name"), "f.kind", "f.form")


TENSES = [
    (c, tense, p, morphology.PARTICLES.get(tense, "") + (" " if tense in morphology.PARTICLES else ""), e)
    for c, t in morphology.VERB_CLASSES.items()
    for tense in ("subjunctive", "present", "future", "conditional", "past_aorist", "imperfect")
    for p, e in zip(morphology.PERSONS, t["subjunctive" if tense in morphology.PARTICLES else tense])
] + [(c, tense, None, "", t[tense]) for c, t in morphology.VERB_CLASSES.items() for tense in ("imperative_sg", "imperative_pl", "past_participle", "present_participle")]


@query(f"""
WITH l AS (SELECT DISTINCT entry_id, lower(lemma) AS w FROM lexicon_entries WHERE lemma IS NOT NULL), e(verb_class, tense, person, particle, ending) AS (VALUES {_values(TENSES)})
SELECT entry_id, tense, person, particle || CASE WHEN suffix(w, CASE verb_class WHEN 'e_class' THEN 'ել' ELSE 'ալ' END) THEN left(w, length(w) - 2) ELSE w END || ending AS form
FROM l JOIN e ON verb_class = CASE WHEN suffix(w, 'ալ') THEN 'a_class' ELSE 'e_class' END
""")
def conjugated_verbs(spark, d):
    """All tenses and persons of every lemma taken as a verb of the class its ending shows."""
    rows = table(spark, d, "lexicon_entries").where("lemma is not null").select("entry_id", F.lower("lemma").alias("w")).distinct()
    w = F.col("w")
    forms = rows.select("entry_id", F.explode(F.when(w.endswith("ալ"), morphology.conjugated(w, "a_class")).otherwise(morphology.conjugated(w, "e_class"))).alias("f"))
    return forms.select("entry_id", "f.tense", "f.person", "f.form")


def _latin(table: dict[str, str]) -> str:
    out = "replace(w, 'ու', 'u')"
    for a, b in table.items():
        out = f"replace({out}, '{a}', '{b}')"
    return out


@query(f"""
WITH l AS (SELECT DISTINCT entry_id, lower(lemma) AS w FROM lexicon_entries WHERE lemma IS NOT NULL)
SELECT entry_id, {_latin(dict(zip(morphology.LETTERS, morphology.WESTERN)))} AS western, {_latin(dict(zip(morphology.LETTERS, morphology.EASTERN)))} AS eastern,
 least(5.0, greatest(1.0, 1.0 + 0.3 * length(regexp_replace(w, '[^{morphology.HARD}]', '', 'g'))))::DOUBLE AS difficulty,
 CASE WHEN regexp_matches(w, '(ել|իլ|ալ)$') THEN 'verb' WHEN regexp_matches(w, '(ութիւն|ություն|ութեան)$') THEN 'noun' WHEN regexp_matches(w, '(ական|ային|եղէն)$') THEN 'adjective' ELSE 'noun' END AS word_class FROM l
""")
def lexicon_sounds(spark, d):
    w = F.lower("lemma")
    rows = table(spark, d, "lexicon_entries").where("lemma is not null").select("entry_id", w.alias("w")).distinct()
    return rows.select("entry_id", morphology.romanized(F.col("w")).alias("western"), morphology.romanized(F.col("w"), "eastern").alias("eastern"), morphology.difficulty(F.col("w")).alias("difficulty"), morphology.word_class(F.col("w")).alias("word_class"))


@query("SELECT DISTINCT entry_id, trim(lemma) AS lemma, nullif(trim(translation), '') AS translation, coalesce(frequency_rank, 0) AS frequency_rank, metadata['deck_name'] AS deck FROM lexicon_entries WHERE entry_id IS NOT NULL AND trim(coalesce(lemma, '')) <> '' AND trim(coalesce(translation, '')) <> ''")
def card_rows(spark, d):
    """Entries that have all required fields, blanks as missing."""
    rows = table(spark, d, "lexicon_entries").where("entry_id is not null and trim(coalesce(lemma, '')) <> '' and trim(coalesce(translation, '')) <> ''")
    return rows.select("entry_id", F.trim("lemma").alias("lemma"), F.trim("translation").alias("translation"), F.coalesce("frequency_rank", F.lit(0)).alias("frequency_rank"), F.try_element_at("metadata", F.lit("deck_name")).alias("deck")).distinct()


@query("""
WITH y AS (SELECT DISTINCT author, try_cast(nullif(regexp_extract(publication_date, '(1[5-9]|20)[0-9]{2}'), '') AS INTEGER) AS y FROM archive_org_texts WHERE author IS NOT NULL), s AS (SELECT author, min(y) AS a, max(y) AS b FROM y WHERE y IS NOT NULL GROUP BY author)
SELECT author, 'first_text' AS event, a AS year FROM s UNION ALL SELECT author, 'last_text', b FROM s WHERE b > a
""")
def timeline_events(spark, d):
    year = F.nullif(F.regexp_extract("publication_date", r"(?:1[5-9]|20)\d{2}", 0), F.lit("")).cast("int")
    s = table(spark, d, "archive_org_texts").where("author is not null").select("author", year.alias("y")).where("y is not null").groupBy("author").agg(F.min("y").alias("a"), F.max("y").alias("b"))
    cells = F.filter(F.array(F.struct(F.lit("first_text").alias("event"), F.col("a").alias("year")), F.when(F.col("b") > F.col("a"), F.struct(F.lit("last_text").alias("event"), F.col("b").alias("year")))), lambda x: x.isNotNull())
    return s.select("author", F.explode(cells).alias("e")).select("author", "e.event", "e.year")


@query("SELECT article_id, regexp_matches(title, '(?i)հայ|armen|армян|armén') AS armenian, regexp_matches(title, '(?i)մշակ|cultur|культур') AS culture FROM (SELECT DISTINCT article_id, title FROM newspaper_articles WHERE title IS NOT NULL)")
def keyword_titles(spark, d):
    rows = table(spark, d, "newspaper_articles").where("title is not null").select("article_id", "title").distinct()
    return rows.select("article_id", F.col("title").rlike("(?iu)հայ|armen|армян|armén").alias("armenian"), F.col("title").rlike("(?iu)մշակ|cultur|культур").alias("culture"))
