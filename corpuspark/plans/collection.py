"""Crawls, articles, scans, lexicon, operations, retrieval, reviews and events."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpuspark.functions import text as X
from corpuspark.functions.metrics import mean
from corpuspark.plans.registry import query
from corpuspark.operators.retrieval import nearest
from corpuspark.session import broadcast_if_small, table
from corpuspark.sources.readers import any_date
from corpuspark.streaming.incremental import sessions, windowed_events

PAGES = "SELECT DISTINCT url, domain, status_code, length(text) AS n, armenian_char_ratio, wa_score, dialect_label, robots_allowed FROM crawl_results"


def _pages(spark, d):
    c = table(spark, d, "crawl_results")
    return c.select("url", "domain", "status_code", F.length("text").alias("n"), "armenian_char_ratio", "wa_score", "dialect_label", "robots_allowed").distinct()


@query(f"""
WITH p AS ({PAGES}), l AS (SELECT domain, dialect_label, count(*) AS n, row_number() OVER (PARTITION BY domain ORDER BY count(*) DESC, dialect_label) AS i FROM p WHERE dialect_label IS NOT NULL GROUP BY domain, dialect_label),
a AS (SELECT domain, count(*) AS pages, count(*) FILTER (status_code = 200) AS fetched, round(avg(armenian_char_ratio), 4) AS mean_ratio, round(avg(wa_score), 4) AS mean_score, min(url) AS first_url FROM p GROUP BY domain)
SELECT a.*, l.dialect_label AS dominant FROM a LEFT JOIN l ON a.domain = l.domain AND l.i = 1
""")
def crawl_audit(spark, d):
    p = _pages(spark, d)
    a = p.groupBy("domain").agg(
        F.count(F.lit(1)).alias("pages"), F.count_if(F.col("status_code") == 200).alias("fetched"), mean(F.col("armenian_char_ratio"), 4).alias("mean_ratio"),
        mean(F.col("wa_score"), 4).alias("mean_score"), F.min("url").alias("first_url"),
    )
    labels = p.where("dialect_label is not null").groupBy("domain", "dialect_label").agg(F.count(F.lit(1)).alias("n"))
    best = labels.groupBy("domain").agg(F.min_by("dialect_label", F.struct(-F.col("n"), F.col("dialect_label"))).alias("dominant"))
    return a.join(best, "domain", "left")


@query(f"SELECT url, coalesce(n >= 100 AND armenian_char_ratio >= 0.3, false) AS accepted FROM ({PAGES})")
def page_acceptance(spark, d):
    ok = (F.col("n") >= 100) & (F.col("armenian_char_ratio") >= 0.3)
    return _pages(spark, d).select("url", F.coalesce(ok, F.lit(False)).alias("accepted"))


@query(r"""
SELECT DISTINCT url, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '/+$', '') AS plain, regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://([^/?#:]*)', 1), '^www\.', '') AS host,
 length(url) - length(replace(url, '/', '')) >= 4 AND NOT regexp_matches(url, '/(?:tag|tags|category|author|page|search|login|feed|wp-admin|about|contact)(?:/|$)') AS article_like
FROM crawl_results WHERE url IS NOT NULL
""")
def url_forms(spark, d):
    u = F.col("url")
    return table(spark, d, "crawl_results").where("url is not null").select(u, X.plain_url(u).alias("plain"), X.host(u).alias("host"), X.article_like(u).alias("article_like")).distinct()


@query("SELECT domain, count(*) AS links, count(DISTINCT link) AS targets FROM (SELECT domain, unnest(links_found) AS link FROM (SELECT DISTINCT url, domain, links_found FROM crawl_results)) GROUP BY domain")
def link_counts(spark, d):
    rows = table(spark, d, "crawl_results").select("url", "domain", "links_found").distinct().select("domain", F.explode("links_found").alias("link"))
    return rows.groupBy("domain").agg(F.count(F.lit(1)).alias("links"), F.countDistinct("link").alias("targets"))


@query("SELECT domain, max(fetched_at) AS last FROM crawl_results GROUP BY domain HAVING max(fetched_at) < (SELECT max(fetched_at) FROM crawl_results) - INTERVAL 168 HOUR")
def domains_due(spark, d):
    """Domains last crawled more than a week before the newest page."""
    c = table(spark, d, "crawl_results").groupBy("domain").agg(F.max("fetched_at").alias("last"))
    return c.join(F.broadcast(c.agg(F.max("last").alias("newest"))), F.col("last") < F.col("newest") - F.expr("interval 168 hours")).select("domain", "last")


@query("""
SELECT url, min_by(title, struct_pack(t := scraped_timestamp, a := article_id)) AS title, count(DISTINCT article_id) AS articles, array_to_string(list_sort(list_distinct(list(source_name))), ',') AS sources
FROM newspaper_articles WHERE url IS NOT NULL GROUP BY url
""")
def article_upsert(spark, d):
    """One row per URL: the first title seen, and the union of its sources."""
    rows = table(spark, d, "newspaper_articles").where("url is not null")
    return rows.groupBy("url").agg(
        F.min_by("title", F.struct("scraped_timestamp", "article_id")).alias("title"), F.countDistinct("article_id").alias("articles"), F.array_join(F.array_sort(F.collect_set("source_name")), ",").alias("sources")
    )


@query("SELECT DISTINCT article_id, coalesce(nullif(trim(url), ''), article_id) AS document_id, 'newspaper:' || source_name AS source_family, coalesce(content, '') AS text, title, length(coalesce(content, '')) AS char_count FROM newspaper_articles")
def articles_as_records(spark, d):
    text = F.coalesce("content", F.lit(""))
    key = F.coalesce(F.nullif(F.trim("url"), F.lit("")), F.col("article_id")).alias("document_id")
    rows = table(spark, d, "newspaper_articles")
    return rows.select("article_id", key, F.concat(F.lit("newspaper:"), "source_name").alias("source_family"), text.alias("text"), "title", F.length(text).cast("bigint").alias("char_count")).distinct()


@query("SELECT document_id, CAST(coalesce(try_cast(regexp_extract(trim(publication_date), '^[0-9]{4}-[0-9]{2}-[0-9]{2}') AS DATE), try_strptime(trim(publication_date), '%d.%m.%Y')::DATE, try_strptime(trim(publication_date), '%d/%m/%Y')::DATE, try_strptime(trim(publication_date), '%Y/%m/%d')::DATE, try_cast(regexp_extract(trim(publication_date), '^[0-9]{4}$') || '-01-01' AS DATE)) AS VARCHAR) AS day FROM text_metadata WHERE publication_date IS NOT NULL AND NOT regexp_matches(publication_date, '\\p{L}')")
def publication_days(spark, d):
    rows = table(spark, d, "text_metadata").where(F.col("publication_date").isNotNull() & ~F.col("publication_date").rlike(r"\p{L}"))
    return rows.select("document_id", any_date(F.col("publication_date")).cast("string").alias("day"))


@query("SELECT region, source_type, count(*) AS documents, round(avg(confidence_region), 6) AS confidence FROM text_metadata GROUP BY ALL")
def region_summary(spark, d):
    return table(spark, d, "text_metadata").groupBy("region", "source_type").agg(F.count(F.lit(1)).alias("documents"), F.round(F.avg("confidence_region"), 6).alias("confidence"))


@query("""
WITH o AS (SELECT DISTINCT pdf_name, page_num, engine, mean_confidence, char_count, word_count FROM ocr_page_metrics)
SELECT engine, count(*) AS pages, round(avg(mean_confidence) FILTER (mean_confidence >= 0), 4) AS confidence, CAST(sum(char_count) AS BIGINT) AS chars, count(*) FILTER (char_count < 200 OR word_count < 30) AS low_yield FROM o GROUP BY engine
""")
def engine_metrics(spark, d):
    rows = table(spark, d, "ocr_page_metrics").select("pdf_name", "page_num", "engine", "mean_confidence", "char_count", "word_count").distinct()
    return rows.groupBy("engine").agg(
        F.count(F.lit(1)).alias("pages"), F.round(F.avg(F.when(F.col("mean_confidence") >= 0, F.col("mean_confidence"))), 4).alias("confidence"), F.sum("char_count").alias("chars"),
        F.count_if((F.col("char_count") < 200) | (F.col("word_count") < 30)).alias("low_yield"),
    )


@query("""
WITH o AS (SELECT DISTINCT run_id, pdf_name, page_num, status FROM ocr_page_metrics)
SELECT run_id, count(*) AS pages, count(*) FILTER (status NOT IN ('success', 'text_layer')) AS failures, round(count(*) FILTER (status NOT IN ('success', 'text_layer')) / count(*), 6) AS rate,
 count(*) >= 3 AND count(*) FILTER (status NOT IN ('success', 'text_layer')) / count(*) > 0.1 AS alert FROM o GROUP BY run_id
""")
def run_alerts(spark, d):
    rows = table(spark, d, "ocr_page_metrics").select("run_id", "pdf_name", "page_num", "status").distinct()
    g = rows.groupBy("run_id").agg(F.count(F.lit(1)).alias("pages"), F.count_if(~F.col("status").isin("success", "text_layer")).alias("failures"))
    rate = F.col("failures") / F.col("pages")
    return g.select("run_id", "pages", "failures", F.round(rate, 6).alias("rate"), ((F.col("pages") >= 3) & (rate > 0.1)).alias("alert"))


@query("SELECT entry_id, max_by(lemma, updated_at) AS lemma, max(updated_at) AS updated_at, count(*) AS deliveries FROM lexicon_entries GROUP BY entry_id")
def lexicon_latest(spark, d):
    return table(spark, d, "lexicon_entries").groupBy("entry_id").agg(F.max_by("lemma", "updated_at").alias("lemma"), F.max("updated_at").alias("updated_at"), F.count(F.lit(1)).alias("deliveries"))


@query("""
WITH t AS (SELECT doc_id, unnest(list_filter(regexp_extract_all(lower(text), '[Ա-Ֆա-և]+'), lambda x: length(x) >= 2)) AS w FROM documents), l AS (SELECT DISTINCT lower(lemma) AS w, true AS known FROM lexicon_entries WHERE lemma IS NOT NULL)
SELECT doc_id, count(*) AS words, count(known) AS known, count(DISTINCT CASE WHEN known IS NULL THEN t.w END) AS unknown FROM t LEFT JOIN l ON t.w = l.w GROUP BY doc_id
""")
def lexicon_coverage(spark, d):
    lemmas = broadcast_if_small(table(spark, d, "lexicon_entries").where("lemma is not null").select(F.lower("lemma").alias("w"), F.lit(True).alias("known")).distinct(), 500_000)
    words = table(spark, d, "documents").select("doc_id", F.explode(X.words(F.col("text"))).alias("w")).groupBy("doc_id", "w").agg(F.count(F.lit(1)).alias("n"))
    rows = words.join(lemmas, "w", "left")
    return rows.groupBy("doc_id").agg(
        F.sum("n").alias("words"), F.coalesce(F.sum(F.when(F.col("known"), F.col("n"))), F.lit(0)).alias("known"), F.count_if(F.col("known").isNull()).alias("unknown")
    )


@query("SELECT source_type, status, count(*) AS operations, count(DISTINCT source_name) AS sources, max(operation_timestamp) AS last FROM ingestion_operations GROUP BY ALL")
def operation_summary(spark, d):
    return table(spark, d, "ingestion_operations").groupBy("source_type", "status").agg(F.count(F.lit(1)).alias("operations"), F.countDistinct("source_name").alias("sources"), F.max("operation_timestamp").alias("last"))


@query("SELECT source_name, count(DISTINCT a.article_id) AS articles, count(DISTINCT o.operation_id) AS operations FROM newspaper_articles a LEFT JOIN (SELECT DISTINCT operation_id FROM ingestion_operations) o USING (operation_id) GROUP BY source_name")
def articles_by_operation(spark, d):
    ops = broadcast_if_small(table(spark, d, "ingestion_operations").select("operation_id", F.col("operation_id").alias("known")).distinct(), 200_000)
    rows = table(spark, d, "newspaper_articles").select("article_id", "source_name", "operation_id").join(ops, "operation_id", "left")
    return rows.groupBy("source_name").agg(F.countDistinct("article_id").alias("articles"), F.countDistinct("known").alias("operations"))


@query("""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(trim(text), '[\\s\\v\\x{85}\\p{Z}]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL),
c AS (SELECT doc_id, w, unnest(range(0, greatest(1, CAST(ceil((len(w) - 50) / 200) AS BIGINT)))) AS part FROM w WHERE len(w) > 0)
SELECT doc_id, CAST(part AS INTEGER) AS part, len(w[part * 200 + 1 : part * 200 + 250]) AS words, array_to_string(w[part * 200 + 1 : part * 200 + 250], ' ') AS chunk FROM c
""")
def chunks(spark, d):
    """Chunks of 250 words that overlap by 50, until the text ends."""
    w = F.filter(F.split(F.trim("text"), r"(?U)\s+"), lambda x: x != "")
    rows = table(spark, d, "documents").where("text is not null").select("doc_id", w.alias("w")).where(F.size("w") > 0)
    last = F.greatest(F.lit(1), F.ceil((F.size("w") - 50) / 200)).cast("int") - 1
    parts = rows.select("doc_id", "w", F.explode(F.sequence(F.lit(0), last)).alias("part"))
    piece = F.slice("w", F.col("part") * 200 + 1, 250)
    return parts.select("doc_id", "part", F.size(piece).cast("bigint").alias("words"), F.array_join(piece, " ").alias("chunk"))


@query("""
WITH n AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE) / sqrt(list_sum(list_transform(embedding, lambda y: CAST(y AS DOUBLE) * y)))) AS v FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.v, c.v) AS score FROM n q, n c WHERE q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, vec_id, CAST(rank AS INTEGER) AS rank, round(score, 5) AS score FROM r WHERE rank <= 5
""")
def nearest_vectors(spark, d):
    """The five nearest by inner product of unit vectors, for every vector whose id is divisible by 20, against all; queries go in blocks."""
    vectors = table(spark, d, "embeddings")
    return nearest(vectors.where("vec_id % 20 = 0"), vectors, "vec_id", "embedding", 5)


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS events, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def hourly_events(spark, d):
    return windowed_events(table(spark, d, "events"))


@query("""
WITH g AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events),
s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n FROM g)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS events FROM s GROUP BY user_id, n
""")
def user_sessions(spark, d):
    return sessions(table(spark, d, "events"))


@query("SELECT author, count(*) AS texts, min(y) AS first_year, max(y) AS last_year FROM (SELECT author, text_id, try_cast(nullif(regexp_extract(publication_date, '(1[5-9]|20)[0-9]{2}'), '') AS INTEGER) AS y FROM (SELECT DISTINCT text_id, author, publication_date FROM archive_org_texts) WHERE author IS NOT NULL) WHERE y IS NOT NULL GROUP BY author")
def author_timeline(spark, d):
    rows = table(spark, d, "archive_org_texts").where("author is not null").select("text_id", "author", "publication_date").distinct()
    year = F.nullif(F.regexp_extract("publication_date", r"(?:1[5-9]|20)\d{2}", 0), F.lit("")).cast("int")
    rows = rows.where(year.isNotNull())
    return rows.groupBy("author").agg(F.count(F.lit(1)).alias("texts"), F.min(year).alias("first_year"), F.max(year).alias("last_year"))


@query("WITH y AS (SELECT try_cast(nullif(regexp_extract(publication_date, '(1[5-9]|20)[0-9]{2}'), '') AS INTEGER) AS y, content_length_chars AS n FROM (SELECT DISTINCT text_id, publication_date, content_length_chars FROM archive_org_texts)) SELECT CAST(floor(y / 10) * 10 AS INTEGER) AS decade, count(*) AS texts, CAST(sum(n) AS BIGINT) AS chars, count(*) < 10 AS gap FROM y WHERE y IS NOT NULL GROUP BY 1")
def decade_coverage(spark, d):
    rows = table(spark, d, "archive_org_texts").select("text_id", "publication_date", "content_length_chars").distinct()
    year = F.nullif(F.regexp_extract("publication_date", r"(?:1[5-9]|20)\d{2}", 0), F.lit("")).cast("int")
    g = rows.select((F.floor(year / 10) * 10).cast("int").alias("decade"), "content_length_chars").where("decade is not null").groupBy("decade")
    return g.agg(F.count(F.lit(1)).alias("texts"), F.sum("content_length_chars").alias("chars"), (F.count(F.lit(1)) < 10).alias("gap"))


@query("SELECT doc_id, round((n_chars - min(n_chars) OVER ()) / nullif(max(n_chars) OVER () - min(n_chars) OVER (), 0), 6) AS scaled FROM documents WHERE n_chars IS NOT NULL")
def scaled_lengths(spark, d):
    """Min-max scaled values; the bounds are aggregated apart, so rows stay where they are."""
    rows = table(spark, d, "documents").where("n_chars is not null")
    bounds = rows.agg(F.min("n_chars").alias("lo"), F.max("n_chars").alias("hi"))
    return rows.join(F.broadcast(bounds)).select("doc_id", F.round((F.col("n_chars") - F.col("lo")) / F.nullif(F.col("hi") - F.col("lo"), F.lit(0)), 6).alias("scaled"))
