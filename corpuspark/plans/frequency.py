"""Frequency lists, weights, facets, deltas, drift and distances."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuspark.operators import distance, frequency
from corpuspark.plans.registry import query
from corpuspark.session import spread, table

TOKENS = "SELECT *, unnest(list_filter(regexp_extract_all(lower(text), '[Ա-Ֆա-ֆ]+'), lambda x: length(x) >= 2)) AS word FROM documents"
WEIGHT = """CASE split_part(source, ':', 1) WHEN 'wikipedia' THEN 1.0 WHEN 'wikipedia_wa' THEN 1.0 WHEN 'wikipedia_ea' THEN 0.5 WHEN 'wikisource' THEN 1.0 WHEN 'newspaper' THEN 1.5
 WHEN 'eastern_armenian_news' THEN 0.5 WHEN 'rss_news' THEN 1.5 WHEN 'archive_org' THEN 1.2 WHEN 'hathitrust' THEN 1.2 WHEN 'loc' THEN 1.2 WHEN 'dpla' THEN 1.0 WHEN 'gallica' THEN 1.2
 WHEN 'gomidas' THEN 1.2 WHEN 'culturax' THEN 0.8 WHEN 'english_sources' THEN 0.3 WHEN 'nayiri' THEN 1.0 WHEN 'mss_nkr' THEN 1.2 ELSE 1.0 END::DOUBLE"""


def _docs(spark, d):
    return spread(table(spark, d, "documents"))


@query(f"""
WITH t AS ({TOKENS}), c AS (SELECT source, word, count(*) AS n FROM t WHERE source IS NOT NULL GROUP BY ALL),
s AS (SELECT word, sum(n * {WEIGHT}) AS raw, count(DISTINCT source) AS sources FROM c GROUP BY word HAVING sum(n * {WEIGHT}) >= 2)
SELECT word, round(raw, 2) AS total, sources, row_number() OVER (ORDER BY round(raw, 2) DESC, word) AS rank FROM s
""")
def word_frequencies(spark, d):
    return frequency.weighted_list(frequency.word_counts(_docs(spark, d).where("source is not null"), ["source"]))


@query(f"SELECT source, word, count(*) AS n FROM ({TOKENS}) GROUP BY ALL")
def source_word_counts(spark, d):
    return frequency.word_counts(_docs(spark, d), ["source"])


FACETS = f"""WITH t AS ({TOKENS}), f AS (
 SELECT 'source' AS facet, source AS facet_value, word FROM t UNION ALL SELECT 'branch', lang, word FROM t
 UNION ALL SELECT 'category', writing_category, word FROM t UNION ALL SELECT 'year', CAST(year(enrichment_date) AS VARCHAR), word FROM t)
SELECT facet, facet_value, word, count(*) AS n FROM f WHERE facet_value IS NOT NULL AND facet_value <> '' GROUP BY ALL"""


def _facets(spark, d):
    values = {"source": F.col("source"), "branch": F.col("lang"), "category": F.col("writing_category"), "year": F.year("enrichment_date")}
    return frequency.facets(_docs(spark, d), values)


@query(FACETS)
def word_facets(spark, d):
    return _facets(spark, d)


@query(f"SELECT facet, facet_value, n FROM ({FACETS}) WHERE word = 'մեծ'")
def word_facet_lookup(spark, d):
    docs = _docs(spark, d).where(F.lower("text").contains("մեծ"))  # the filter reaches the scan before words are made
    values = {"source": F.col("source"), "branch": F.col("lang"), "category": F.col("writing_category"), "year": F.year("enrichment_date")}
    return frequency.facets(docs, values).where("word = 'մեծ'").select("facet", "facet_value", "n")


@query("""
WITH c AS (SELECT source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY source), s AS (SELECT source, n / sum(n) OVER () AS cur FROM c),
t AS (SELECT source AS k, max(target_share) AS share FROM mix_targets WHERE source IS NOT NULL GROUP BY source),
j AS (SELECT s.source, cur, coalesce(nullif(o.share, 0), p.share) AS share FROM s LEFT JOIN t o ON o.k = s.source LEFT JOIN t p ON p.k = split_part(s.source, ':', 1))
SELECT source, round(CASE WHEN share > 0 THEN greatest(0.1, least(10.0, share / greatest(cur, 1e-6))) ELSE 1.0 END, 6) AS weight FROM j
""")
def source_target_weights(spark, d):
    return frequency.target_weights(_docs(spark, d), table(spark, d, "mix_targets"))


@query(f"""
SELECT source, round({WEIGHT} * coalesce(greatest(0.5, least(2.0, 1 + 0.2 * (avg(wa_score) - 5) / 5)), 1.0), 6) AS weight
FROM documents WHERE source IS NOT NULL GROUP BY source
""")
def source_hybrid_weights(spark, d):
    return frequency.hybrid_weights(_docs(spark, d))




@query(f"""
WITH t AS ({TOKENS}), o AS (SELECT source, word, count(*) AS was FROM t WHERE enrichment_date < TIMESTAMP '2024-01-01' GROUP BY ALL),
n AS (SELECT source, word, count(*) AS now FROM t GROUP BY ALL)
SELECT source, word, coalesce(now, 0) - coalesce(was, 0) AS change FROM o FULL JOIN n USING (source, word) WHERE coalesce(now, 0) <> coalesce(was, 0)
""")
def frequency_delta(spark, d):
    """What the documents enriched since a date, or never, add to the counts before it."""
    docs = _docs(spark, d)
    old = frequency.word_counts(docs.where("enrichment_date < timestamp'2024-01-01'"), ["source"])
    return frequency.delta(old, frequency.word_counts(docs, ["source"]), ["source", "word"])


@query(f"SELECT source, word, count(*) AS n FROM ({TOKENS}) GROUP BY ALL")
def frequency_incremental(spark, d):
    """Counts kept by applying a delta to an older state: equal to counting anew."""
    docs = _docs(spark, d)
    old, new = frequency.word_counts(docs.where("enrichment_date < timestamp'2024-01-01'"), ["source"]), frequency.word_counts(docs, ["source"])
    return frequency.merged(old, frequency.delta(old, new, ["source", "word"]), ["source", "word"])


@query("SELECT max(strftime(enrichment_date, '%Y-%m-%dT%H:%M:%S')) AS marker, count(*) AS documents FROM documents WHERE enrichment_date IS NOT NULL")
def high_water_mark(spark, d):
    docs = _docs(spark, d).where("enrichment_date is not null")
    return docs.agg(F.max(F.date_format("enrichment_date", "yyyy-MM-dd'T'HH:mm:ss")).alias("marker"), F.count(F.lit(1)).alias("documents"))


def _sides(spark, d):
    docs = _docs(spark, d)
    return [frequency.word_counts(docs.where(F.col("lang") == x), []) for x in ("hyw", "hye")]


SIDES = f"""t AS ({TOKENS}), a AS (SELECT word, count(*) AS n FROM t WHERE lang = 'hyw' GROUP BY word), b AS (SELECT word, count(*) AS n FROM t WHERE lang = 'hye' GROUP BY word)"""


@query(f"""
WITH {SIDES}, p AS (SELECT word, n / sum(n) OVER () AS p FROM a ORDER BY p DESC, word LIMIT 100), q AS (SELECT word, n / sum(n) OVER () AS q FROM b ORDER BY q DESC, word LIMIT 100),
g AS (SELECT abs(coalesce(p, 1e-9) - coalesce(q, 1e-9)) AS gap FROM p FULL JOIN q USING (word))
SELECT round(max(gap), 8) AS max_gap, round(avg(gap), 8) AS mean_gap, coalesce(max(gap) > 0.05, false) AS alert, count(*) AS compared FROM g
""")
def frequency_drift(spark, d):
    return frequency.drift(*_sides(spark, d))


@query(f"""
WITH {SIDES}, j AS (SELECT word, coalesce(a.n, 0) AS na, coalesce(b.n, 0) AS nb FROM a FULL JOIN b USING (word)),
r AS (SELECT na, nb, na / (SELECT sum(n) FROM a) AS p, nb / (SELECT sum(n) FROM b) AS q FROM j),
k AS (SELECT sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2 AS js,
 sqrt(sum((sqrt(p) - sqrt(q)) ** 2)) / sqrt(2.0) AS h, 1 - sum(p * q) / sqrt(sum(p * p) * sum(q * q)) AS c, 1 - sum(least(na, nb)) / sum(greatest(na, nb)) AS w,
 sum(CASE WHEN p > 0 THEN p * ln(p / greatest(q, 1e-10)) ELSE 0 END) AS kl FROM r)
SELECT round(greatest(0.0, least(1.0, js / ln(2.0))), 6) AS js_bits, round(js, 6) AS js_nats, round(h, 6) AS hellinger, round(c, 6) AS cosine, round(w, 6) AS jaccard, round(kl, 6) AS kl FROM k
""")
def branch_divergences(spark, d):
    return distance.divergences(*_sides(spark, d))


@query("""
WITH v AS (SELECT n_chars AS value, sum((lang = 'hyw')::INT) AS na, sum((lang = 'hye')::INT) AS nb FROM documents WHERE lang IN ('hyw', 'hye') AND n_chars IS NOT NULL GROUP BY 1),
g AS (SELECT value, abs(sum(na) OVER (ORDER BY value) / sum(na) OVER () - sum(nb) OVER (ORDER BY value) / sum(nb) OVER ()) * (lead(value) OVER (ORDER BY value) - value) AS area FROM v)
SELECT round(coalesce(sum(area), 0.0) / nullif(max(value) - min(value), 0), 6) AS distance FROM g
""")
def length_wasserstein(spark, d):
    docs = _docs(spark, d).where("n_chars is not null").select("lang", F.col("n_chars").alias("value"))
    return distance.wasserstein(docs.where("lang = 'hyw'"), docs.where("lang = 'hye'"))


@query("""
WITH l AS (SELECT DISTINCT entry_id, lemma, coalesce(pos, '') AS other, coalesce(translation, '') AS gloss FROM lexicon_entries WHERE lemma IS NOT NULL)
SELECT entry_id, CAST(levenshtein(gloss, other) AS INTEGER) AS edits,
 1.0 * abs(length(regexp_replace(lemma, '[^\\p{L}]', '', 'g')) - length(regexp_replace(other, '[^\\p{L}]', '', 'g'))) + 2.0 * abs(length(regexp_replace(lemma, '[^ ]', '', 'g')) - length(regexp_replace(other, '[^ ]', '', 'g'))) AS load
FROM l
""".replace("\\\\", "\\"))
def lemma_pair_metrics(spark, d):
    rows = table(spark, d, "lexicon_entries").where("lemma is not null").select("entry_id", "lemma", F.coalesce("pos", F.lit("")).alias("other"), F.coalesce("translation", F.lit("")).alias("gloss")).distinct()
    return rows.select("entry_id", F.levenshtein("gloss", "other").alias("edits"), distance.orthographic_load(F.col("lemma"), F.col("other")).alias("load"))
