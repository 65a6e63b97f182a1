"""Corpus audits: counts, gaps, duplicates, validation and summaries."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.window import Window

from corpuspark.operators import dedup, order, release, retrieval
from corpuspark.functions import text as X
from corpuspark.plans.registry import query
from corpuspark.session import cut, spread, table


def _docs(spark, d):
    return table(spark, d, "documents")


def missing(c: Column) -> Column:
    return c.isNull() | (c.cast("string") == "")


@query("""
SELECT source, count(*) AS documents, CAST(sum(n_chars) AS BIGINT) AS chars, round(avg(n_chars), 4) AS mean, min(n_chars) AS least, max(n_chars) AS most
FROM documents GROUP BY GROUPING SETS ((source), ())
""")
def source_summary(spark, d):
    """Per source with a grand total row whose source is null."""
    g = _docs(spark, d).groupingSets([["source"], []], "source")
    return g.agg(F.count(F.lit(1)).alias("documents"), F.sum("n_chars").alias("chars"), F.round(F.avg("n_chars"), 4).alias("mean"), F.min("n_chars").alias("least"), F.max("n_chars").alias("most"))


@query("SELECT coalesce(lang, 'unknown') AS lang, count(*) AS documents, CAST(sum(n_chars) AS BIGINT) AS chars, round(avg(n_chars), 4) AS mean FROM documents GROUP BY 1")
def language_summary(spark, d):
    return _docs(spark, d).groupBy(F.coalesce("lang", F.lit("unknown")).alias("lang")).agg(F.count(F.lit(1)).alias("documents"), F.sum("n_chars").alias("chars"), F.round(F.avg("n_chars"), 4).alias("mean"))


@query("SELECT source, coalesce(lang, 'unknown') AS lang, grouping(source) + 0 AS all_sources, grouping(coalesce(lang, 'unknown')) + 0 AS all_langs, count(*) AS documents FROM documents GROUP BY CUBE (source, coalesce(lang, 'unknown'))")
def source_language_cube(spark, d):
    rows = _docs(spark, d).select("source", F.coalesce("lang", F.lit("unknown")).alias("lang"))
    return rows.cube("source", "lang").agg(F.grouping("source").cast("bigint").alias("all_sources"), F.grouping("lang").cast("bigint").alias("all_langs"), F.count(F.lit(1)).alias("documents"))


BUCKETS = (0, 50, 100, 250, 500, 1000, 2500, 5000, 10000, 50000)


@query("SELECT CASE " + " ".join(f"WHEN n_chars >= {a} AND n_chars < {b} THEN '{a}'" for a, b in zip(BUCKETS, BUCKETS[1:])) + " ELSE '50K+' END AS bucket, count(*) AS documents FROM documents WHERE n_chars IS NOT NULL GROUP BY 1")
def length_buckets(spark, d):
    bucket = F.lit("50K+")
    for a, b in reversed(list(zip(BUCKETS, BUCKETS[1:]))):
        bucket = F.when((F.col("n_chars") >= a) & (F.col("n_chars") < b), str(a)).otherwise(bucket)
    return _docs(spark, d).where("n_chars is not null").groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("documents"))


@query("""
WITH r AS (SELECT source, wa_score, row_number() OVER (PARTITION BY source ORDER BY wa_score) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM documents WHERE wa_score IS NOT NULL AND source IS NOT NULL)
SELECT source, round(min(wa_score), 6) AS least, round(avg(wa_score), 6) AS mean, round(max(wa_score), 6) AS most, round(max(wa_score) FILTER (i = n // 2), 6) AS median FROM r GROUP BY source
""")
def score_distribution(spark, d):
    """The median is the upper one, found from counted values, so no source is gathered in one task."""
    rows = _docs(spark, d).where("wa_score is not null and source is not null")
    values = rows.groupBy("source", "wa_score").agg(F.count(F.lit(1)).alias("n"))
    ranked = order.running(values, "source", "wa_score")
    return ranked.groupBy("source").agg(
        F.round(F.min("wa_score"), 6).alias("least"), F.round(F.sum(F.col("wa_score") * F.col("n")) / F.sum("n"), 6).alias("mean"),
        F.round(F.max("wa_score"), 6).alias("most"), F.round(F.min(F.when(F.col("upto") > F.floor(F.col("all") / 2), F.col("wa_score"))), 6).alias("median"),
    )


@query("""
WITH d AS (SELECT CAST(enrichment_date AS DATE) AS day, source FROM documents WHERE enrichment_date IS NOT NULL), t AS (SELECT DISTINCT day FROM d ORDER BY day DESC LIMIT 10)
SELECT CAST(day AS VARCHAR) AS day, source, count(*) AS documents FROM d WHERE day IN (SELECT day FROM t) GROUP BY ALL
""")
def last_active_days(spark, d):
    rows = _docs(spark, d).where("enrichment_date is not null").groupBy(F.to_date("enrichment_date").alias("day"), "source").agg(F.count(F.lit(1)).alias("documents"))
    days = rows.select("day").distinct().orderBy(F.desc("day")).limit(10)
    return rows.join(F.broadcast(days), "day").select(F.col("day").cast("string").alias("day"), "source", "documents")


HASHED = r"SELECT doc_id, source, text, sha256(text) AS h FROM documents WHERE text IS NOT NULL"


def _hashed(spark, d):
    return _docs(spark, d).where("text is not null").withColumn("h", F.sha2("text", 256))


@query(f"SELECT h, count(*) AS documents, count(DISTINCT source) AS sources FROM ({HASHED}) GROUP BY h HAVING count(*) > 1 ORDER BY 2 DESC, h LIMIT 20")
def duplicate_groups(spark, d):
    g = _hashed(spark, d).groupBy("h").agg(F.count(F.lit(1)).alias("documents"), F.countDistinct("source").alias("sources"))
    return g.where("documents > 1").orderBy(F.desc("documents"), "h").limit(20)


@query(f"SELECT h, count(*) AS documents, array_to_string(list_sort(list_distinct(list(source))), ',') AS sources FROM ({HASHED}) GROUP BY h HAVING count(DISTINCT source) > 1")
def cross_source_duplicates(spark, d):
    g = _hashed(spark, d).groupBy("h").agg(F.count(F.lit(1)).alias("documents"), F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"), F.countDistinct("source").alias("n"))
    return g.where("n > 1").drop("n")


@query(f"SELECT doc_id, doc_id = min(doc_id) OVER (PARTITION BY h) AS kept FROM ({HASHED})")
def exact_duplicates(spark, d):
    rows = _docs(spark, d).where("text is not null")
    return dedup.first_by(rows.select("doc_id", F.sha2("text", 256).alias("h")), F.col("h"), F.col("doc_id")).select("doc_id", "kept")


@query(r"""
WITH n AS (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g'), ' ') AS t FROM documents WHERE text IS NOT NULL)
SELECT doc_id, doc_id = min(doc_id) OVER (PARTITION BY t) AS filtered, doc_id <> min(doc_id) OVER (PARTITION BY t) AS deduplicated FROM n
""")
def dedup_flags(spark, d):
    rows = _docs(spark, d).where("text is not null").select("doc_id", F.sha2(X.collapsed(F.col("text")), 256).alias("h"))
    return dedup.first_by(rows, F.col("h"), F.col("doc_id")).select("doc_id", F.col("kept").alias("filtered"), (~F.col("kept")).alias("deduplicated"))


SHINGLES = r"""WITH w AS (SELECT DISTINCT document_id AS doc_id, regexp_extract_all(lower(text), '[\p{L}]+') AS w FROM document_records WHERE text IS NOT NULL),
s AS (SELECT doc_id, CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) END AS s FROM w WHERE len(w) > 0),
f AS (SELECT min(doc_id) AS doc_id, list_sort(s) AS s FROM s GROUP BY list_sort(s)), e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM f),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, round(count(*) / (a.n + b.n - count(*)), 6) AS similarity FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n)"""


DOCUMENT_SHINGLES = SHINGLES.replace("SELECT DISTINCT document_id AS doc_id", "SELECT doc_id").replace("document_records", "documents").replace("WITH ", "WITH RECURSIVE ", 1)


@query(f"""{DOCUMENT_SHINGLES},
m AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY list_sort(s)) AS first FROM s), h AS (SELECT doc_id, sha256(text) AS h FROM documents WHERE text IS NOT NULL), z AS (SELECT first, count(DISTINCT h) AS texts FROM m JOIN h USING (doc_id) GROUP BY first),
q AS (SELECT a, b FROM p WHERE similarity >= 0.8), k AS (SELECT b AS key, row_number() OVER (ORDER BY b) AS i, list(a) AS before FROM q GROUP BY b),
r(i, dropped) AS (SELECT 0, []::BIGINT[] UNION ALL SELECT k.i, CASE WHEN len(list_filter(k.before, lambda x: NOT list_contains(r.dropped, x))) > 0 THEN list_append(r.dropped, k.key) ELSE r.dropped END FROM r JOIN k ON k.i = r.i + 1),
g AS (SELECT arg_max(dropped, i) AS dropped FROM r), o AS (SELECT x AS first, sum(texts) AS near FROM (SELECT a AS x, b AS y FROM q UNION ALL SELECT b, a FROM q) JOIN z ON z.first = y GROUP BY x)
SELECT h.doc_id, CASE WHEN m.first IS NULL THEN h.doc_id = min(h.doc_id) OVER (PARTITION BY h.h) ELSE h.doc_id = m.first AND NOT list_contains((SELECT dropped FROM g), m.first) END AS kept, CAST(coalesce(z.texts - 1 + coalesce(o.near, 0), 0) AS BIGINT) AS links
FROM h LEFT JOIN m USING (doc_id) LEFT JOIN z ON z.first = m.first LEFT JOIN o ON o.first = m.first
""")
def near_duplicates(spark, d):
    """Every document with text: whether it is kept, and the number of earlier or later near twins among different texts."""
    return near_twins(_docs(spark, d))


@query(f"{SHINGLES} SELECT a, b, similarity FROM p WHERE similarity >= 0.8")
def near_duplicate_pairs(spark, d):
    """Pairs of different texts with five-word shingles in common, by representative."""
    return dedup.near_pairs(table(spark, d, "document_records").select("document_id", "text").distinct(), "document_id")


@query()
def character_duplicates(spark, d):
    """Near duplicates by runs of five characters and 128 permutations: what is kept of the texts in order."""
    docs = _docs(spark, d)
    prints, again = dedup.character_prints(spread(docs), "doc_id", "text"), lambda keys: dedup.character_prints(dedup.chosen(docs, "doc_id", keys), "doc_id", "text")
    members, pairs = dedup.near_classes(prints, dedup.CHARACTER_SIMILARITY, dedup.CHARACTER_BANDS, dedup.CHARACTER_ROWS, again)
    members = cut(members)
    settled = dedup.keep_first(members.select(F.col("first").alias("key")), pairs.select("a", "b"))
    out = members.join(settled.withColumnRenamed("key", "first"), "first")
    return out.select(F.col("key").alias("doc_id"), (F.col("kept") & (F.col("key") == F.col("first"))).alias("kept"))


def near_twins(documents):
    """(doc_id, kept, links). Texts of equal shingles are near twins of each other and of each other's twins; the first of them stands for all."""
    docs = documents.where("text is not null")
    members, pairs = dedup.near_classes(dedup.word_prints(spread(docs), "doc_id", "text"), again=lambda keys: dedup.word_prints(dedup.chosen(docs, "doc_id", keys), "doc_id", "text"))
    members, pairs = cut(members), cut(pairs.select("a", "b"))
    copies = cut(dedup.first_by(docs.select("doc_id", F.sha2("text", 256).alias("h")), F.col("h"), F.col("doc_id")))
    sizes = cut(copies.join(members, copies.doc_id == members.key).groupBy("first").agg(F.countDistinct("h").alias("texts")))
    settled = dedup.keep_first(sizes.select(F.col("first").alias("key")), pairs).withColumnsRenamed({"key": "first", "kept": "first_kept"})
    both = pairs.union(pairs.select("b", "a")).toDF("first", "other")
    others = both.join(sizes.toDF("other", "near"), "other").groupBy("first").agg(F.sum("near").alias("near"))
    classes = sizes.join(settled, "first").join(others, "first", "left")
    classes = classes.select("first", "first_kept", (F.col("texts") - 1 + F.coalesce("near", F.lit(0))).alias("links"))
    out = copies.join(members.withColumnRenamed("key", "doc_id"), "doc_id", "left").join(classes, "first", "left")
    kept = F.when(F.col("first").isNull(), F.col("kept")).otherwise(F.col("first_kept") & (F.col("doc_id") == F.col("first")))
    return out.select("doc_id", kept.alias("kept"), F.coalesce("links", F.lit(0)).alias("links"))


@query("""
WITH n AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE) / sqrt(list_sum(list_transform(embedding, lambda y: CAST(y AS DOUBLE) * y)))) AS v FROM embeddings)
SELECT q.vec_id AS query_id, c.vec_id AS vec_id, round(sqrt(greatest(2 - 2 * list_dot_product(q.v, c.v), 0.0)), 5) AS distance
FROM n q, n c WHERE q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND list_dot_product(q.v, c.v) >= 1 - 1.15 * 1.15 / 2
""")
def vector_neighbours(spark, d):
    """Every vector within a distance of those whose id is divisible by 20."""
    vectors = table(spark, d, "embeddings")
    return retrieval.within(vectors.where("vec_id % 20 = 0"), vectors, "vec_id", "embedding", 1.15)


@query()
def vector_duplicates(spark, d):
    """Vectors kept when earlier ones within a distance drop the later."""
    return retrieval.kept_vectors(table(spark, d, "embeddings"), "vec_id", "embedding", 0.9).withColumnRenamed("key", "vec_id")


@query("SELECT source, count(*) AS documents, array_to_string(list_sort(list(doc_id))[1:3], ',') AS examples FROM documents WHERE n_chars IS NULL OR n_chars < 100 GROUP BY source")
def short_documents(spark, d):
    short = _docs(spark, d).where("n_chars is null or n_chars < 100")
    ranked = short.select("source", "doc_id").withColumn("i", F.row_number().over(Window.partitionBy("source", F.pmod(F.xxhash64("doc_id"), F.lit(64))).orderBy("doc_id")))
    few = ranked.where("i <= 3").groupBy("source").agg(F.slice(F.array_sort(F.collect_list("doc_id")), 1, 3).alias("few"))
    counts = short.groupBy("source").agg(F.count(F.lit(1)).alias("documents"))
    return counts.join(few, counts.source.eqNullSafe(few.source)).select(counts.source, "documents", F.array_join(F.col("few").cast("array<string>"), ",").alias("examples"))


@query("SELECT source, count(*) AS documents, round(100.0 * count(*) / sum(count(*)) OVER (), 4) AS pct FROM documents WHERE url IS NULL OR url = '' GROUP BY source")
def missing_urls(spark, d):
    g = _docs(spark, d).where(missing(F.col("url"))).groupBy("source").agg(F.count(F.lit(1)).alias("documents"))
    return g.withColumn("pct", F.round(100.0 * F.col("documents") / F.sum("documents").over(Window.partitionBy(F.lit(0))), 4))


FIELDS = ("lang", "source", "title", "url", "writing_category", "wa_score", "enrichment_date")


@query(" UNION ALL ".join(f"SELECT '{f}' AS field, count(*) FILTER ({f} IS NULL OR CAST({f} AS VARCHAR) = '') AS missing, count(*) AS documents FROM documents" for f in FIELDS))
def missing_fields(spark, d):
    one = _docs(spark, d).agg(F.count(F.lit(1)).alias("documents"), *[F.count_if(missing(F.col(f))).alias(f) for f in FIELDS])
    return one.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("missing"), F.col("documents").alias("documents")) for f in FIELDS])).alias("x")).select("x.*")


FLAGS = {"no_text": "text IS NULL OR text = ''", "short": "n_chars < 100", "no_title": "title IS NULL OR title = ''", "no_url": "url IS NULL OR url = ''", "no_language": "lang IS NULL", "low_score": "wa_score < 5"}


@query(" UNION ALL ".join(f"SELECT '{k}' AS flag, count(*) FILTER ({v}) AS documents, round(100.0 * count(*) FILTER ({v}) / count(*), 4) AS pct FROM documents" for k, v in FLAGS.items()))
def quality_flags(spark, d):
    one = _docs(spark, d).agg(F.count(F.lit(1)).alias("all"), *[F.count_if(F.expr(v)).alias(k) for k, v in FLAGS.items()])
    cells = [F.struct(F.lit(k).alias("flag"), F.col(k).alias("documents"), F.round(100.0 * F.col(k) / F.col("all"), 4).alias("pct")) for k in FLAGS]
    return one.select(F.explode(F.array(*cells)).alias("x")).select("x.*")


@query("SELECT count(*) AS documents, count(*) FILTER (text <> '') AS with_text, count(DISTINCT sha256(text)) AS different, CAST(sum(length(text)) AS BIGINT) AS chars, count(DISTINCT source) AS sources FROM documents")
def corpus_summary(spark, d):
    return _docs(spark, d).agg(
        F.count(F.lit(1)).alias("documents"), F.count_if(F.col("text") != "").alias("with_text"), F.countDistinct(F.sha2("text", 256)).alias("different"),
        F.sum(F.length("text")).alias("chars"), F.countDistinct("source").alias("sources"),
    )


TABLES = ("documents", "document_records", "text_metadata", "lexicon_entries", "newspaper_articles", "crawl_results", "archive_org_texts", "ocr_page_metrics", "ingestion_operations")


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in TABLES))
def table_overview(spark, d):
    parts = [table(spark, d, t).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("table_name"), "rows") for t in TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("""
WITH k AS (SELECT count(*) AS n, count(*) FILTER (content_hash IS NULL) AS no_hash, count(*) FILTER (internal_language_branch IS NOT NULL AND internal_language_branch NOT IN ('hye-w', 'hye-e', 'eng')) AS odd,
 count(*) FILTER (document_id IS NULL OR document_id = '') AS no_id, count(*) FILTER (char_count IS NOT NULL AND char_count < length(text)) AS short FROM document_records)
SELECT 'has_hash' AS rule, no_hash = 0 AS passed, no_hash AS failures FROM k UNION ALL SELECT 'known_branch', odd = 0, odd FROM k
UNION ALL SELECT 'has_id', no_id = 0, no_id FROM k UNION ALL SELECT 'char_count', short = 0, short FROM k UNION ALL SELECT 'not_empty', n > 0, (n = 0)::BIGINT FROM k
""")
def contract_validation(spark, d):
    branch = F.col("internal_language_branch")
    k = table(spark, d, "document_records").agg(
        F.count_if(F.col("content_hash").isNull()).alias("has_hash"), F.count_if(branch.isNotNull() & ~branch.isin("hye-w", "hye-e", "eng")).alias("known_branch"),
        F.count_if(missing(F.col("document_id"))).alias("has_id"), F.count_if(F.col("char_count") < F.length("text")).alias("char_count"), (F.count(F.lit(1)) == 0).cast("bigint").alias("not_empty"),
    )
    cells = [F.struct(F.lit(x).alias("rule"), (F.col(x) == 0).alias("passed"), F.col(x).alias("failures")) for x in k.columns]
    return k.select(F.explode(F.array(*cells)).alias("x")).select("x.*")


@query("SELECT doc_id, title, n_chars FROM documents WHERE title IS NOT NULL ORDER BY n_chars DESC, doc_id LIMIT 25")
def longest_titled(spark, d):
    return _docs(spark, d).where("title is not null").select("doc_id", "title", "n_chars").orderBy(F.desc("n_chars"), "doc_id").limit(25)


@query("SELECT h, count(*) AS documents, count(DISTINCT source) > 1 AS cross_source FROM (SELECT source, sha256(trim(regexp_replace(text, '\\s+', ' ', 'g'), ' ')) AS h FROM documents WHERE text IS NOT NULL) GROUP BY h HAVING count(*) > 1")
def overlap_fingerprints(spark, d):
    g = _docs(spark, d).where("text is not null").groupBy(F.sha2(X.collapsed(F.col("text")), 256).alias("h")).agg(F.count(F.lit(1)).alias("documents"), (F.countDistinct("source") > 1).alias("cross_source"))
    return g.where("documents > 1")


def _split_sql(key: str) -> str:
    bits = f"CAST(('0x' || substr(sha256('corpus:' || {key}), 1, 16)) AS UBIGINT)::DOUBLE / 18446744073709551616.0"
    return f"CASE WHEN {bits} < 0.9 THEN 'train' WHEN {bits} < 0.9 + 0.05 THEN 'validation' ELSE 'test' END"


@query(f"SELECT doc_id, {_split_sql('CAST(doc_id AS VARCHAR)')} AS split FROM documents")
def release_split(spark, d):
    return _docs(spark, d).select("doc_id", release.split_of(F.col("doc_id").cast("string")).alias("split"))


@query(f"SELECT {_split_sql('CAST(doc_id AS VARCHAR)')} AS split, count(*) AS documents FROM documents GROUP BY 1")
def release_counts(spark, d):
    return _docs(spark, d).groupBy(release.split_of(F.col("doc_id").cast("string")).alias("split")).agg(F.count(F.lit(1)).alias("documents"))


@query("""
WITH h AS (SELECT doc_id, source, sha256(text) AS content_hash FROM documents WHERE text IS NOT NULL), old AS (SELECT DISTINCT content_hash FROM h WHERE source = 'wikipedia_wa')
SELECT min(doc_id) AS doc_id, content_hash FROM h WHERE content_hash NOT IN (SELECT content_hash FROM old) AND source <> 'wikipedia_wa' GROUP BY content_hash
""")
def insert_new_documents(spark, d):
    rows = _hashed(spark, d).select("doc_id", "source", F.col("h").alias("content_hash"))
    return release.insert_new(rows.where("source <> 'wikipedia_wa'"), rows.where("source = 'wikipedia_wa'")).select("doc_id", "content_hash")
