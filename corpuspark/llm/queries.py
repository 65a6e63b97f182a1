"""The training-data queries and their SQL, by name."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuspark.llm import encoding_repair, language, leakage, main_content, mixing, scan_repair, site_lines, split_overlap, unicode_form
from corpuspark.session import spread, table as read


def table(spark, sf_dir, name):
    """A table whose texts costly work waits for, spread over the cores if it is read in few pieces."""
    return spread(read(spark, sf_dir, name)) if name in LARGE else read(spark, sf_dir, name)


LARGE = ("documents", "document_records", "crawl_results", "newspaper_articles", "lexicon_entries")

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def p1_found(spark, sf_dir):
    found, _ = site_lines.boilerplate(table(spark, sf_dir, "newspaper_articles"))
    return found.select(F.col("key").alias("article_id"), "line_no")


@query
def p1_blocks(spark, sf_dir):
    _, blocks = site_lines.boilerplate(table(spark, sf_dir, "newspaper_articles"))
    return blocks


@query
def p1_clean(spark, sf_dir):
    articles = table(spark, sf_dir, "newspaper_articles")
    found, _ = site_lines.boilerplate(articles)
    out = site_lines.without_lines(articles, found, "article_id", "content")
    return out.select(F.col("key").alias("article_id"), F.col("text").alias("content"), "removed")


SQL["p1_found"] = r"""
WITH lines AS (
  SELECT article_id, source_name, unnest(string_split(content, chr(10))) AS line, generate_subscripts(string_split(content, chr(10)), 1) AS line_no
  FROM newspaper_articles WHERE content IS NOT NULL AND source_name IS NOT NULL
), keyed AS (
  SELECT DISTINCT article_id, source_name, CAST(line_no AS INTEGER) AS line_no,
         regexp_replace(replace(lower(line), 'և', 'եւ'), '[^\p{L}]+', '', 'g') AS k
  FROM lines
), often AS (
  SELECT source_name, k FROM keyed WHERE k <> '' GROUP BY ALL HAVING count(DISTINCT article_id) >= 5
)
SELECT DISTINCT article_id, line_no FROM keyed JOIN often USING (source_name, k)
"""


SQL["p1_clean"] = (
    "WITH found AS (" + SQL["p1_found"] + r"""), d AS (SELECT DISTINCT article_id, content FROM newspaper_articles), g AS (SELECT article_id, list(line_no) AS gone FROM found GROUP BY article_id),
k AS (SELECT d.article_id, gone, array_to_string(list_filter(string_split(content, chr(10)), lambda x, i: gone IS NULL OR NOT list_contains(gone, i)), chr(10)) AS t FROM d LEFT JOIN g USING (article_id))
SELECT article_id, regexp_replace(trim(regexp_replace(t, '\n[ \t]*(\n[ \t]*)+\n', chr(10) || chr(10), 'g'), ' '), '^\n+|\n+$', '', 'g') AS content, CAST(coalesce(len(gone), 0) AS INTEGER) AS removed FROM k
"""
)


def _unified(spark, sf_dir):
    records = table(spark, sf_dir, "document_records").select(F.lit("document_records").alias("table_name"), F.col("document_id").alias("record_key"), "text")
    lemmas = table(spark, sf_dir, "lexicon_entries").select(F.lit("lexicon_entries").alias("table_name"), F.col("entry_id").alias("record_key"), F.col("lemma").alias("text"))
    return unicode_form.unified(records.unionByName(lemmas), "text")


@query
def p2_found(spark, sf_dir):
    return _unified(spark, sf_dir).where("odd").select("table_name", "record_key").distinct()


@query
def p2_forms(spark, sf_dir):
    return _unified(spark, sf_dir).select("table_name", "record_key", "form", "odd").distinct()


@query
def p3_found(spark, sf_dir):
    return split_overlap.overlaps(table(spark, sf_dir, "document_records")).select("document_id_a", "document_id_b")


@query
def p3_counts(spark, sf_dir):
    records = table(spark, sf_dir, "document_records")
    return split_overlap.counts(records, split_overlap.overlaps(records))


@query
def p7_found(spark, sf_dir):
    found = leakage.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))
    return found.select("doc_id", "item_id")


@query
def p7_report(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    found = leakage.leaks(documents, table(spark, sf_dir, "eval_items"))
    return found.join(documents.select("doc_id", "source"), "doc_id").groupBy("item_id").agg(
        F.countDistinct("doc_id").alias("documents"), F.max("part").alias("longest"), F.max("answered").alias("answered"), F.array_sort(F.collect_set("source")).alias("sources")
    )


@query
def p9_found(spark, sf_dir):
    return encoding_repair.garbled(table(spark, sf_dir, "documents")).select("doc_id")


@query
def p9_text(spark, sf_dir):
    return encoding_repair.garbled(table(spark, sf_dir, "documents")).select("doc_id", "restored", "whole")


def _pages(spark, sf_dir, what):
    pages = what(table(spark, sf_dir, "crawl_results"), "url", "text", "domain").select(F.lit("crawl_results").alias("table_name"), "*")
    articles = what(table(spark, sf_dir, "newspaper_articles"), "article_id", "content", "source_name").select(F.lit("newspaper_articles").alias("table_name"), "*")
    return pages.unionByName(articles).withColumnRenamed("key", "record_key")


@query
def p4_found(spark, sf_dir):
    return _pages(spark, sf_dir, main_content.around).select("table_name", "record_key", F.explode("around").alias("line_no")).distinct()


@query
def p4_bodies(spark, sf_dir):
    return _pages(spark, sf_dir, main_content.bodies).select("table_name", "record_key", "body").distinct()


@query
def p5_found(spark, sf_dir):
    return language.wrong_labels(table(spark, sf_dir, "document_records"), table(spark, sf_dir, "text_metadata"))


@query
def p5_languages(spark, sf_dir):
    return language.languages(table(spark, sf_dir, "document_records"), table(spark, sf_dir, "text_metadata"))


@query
def p6_found(spark, sf_dir):
    return scan_repair.noise(table(spark, sf_dir, "archive_org_texts"), table(spark, sf_dir, "ocr_page_metrics"))


@query
def p6_clean(spark, sf_dir):
    return scan_repair.repaired(table(spark, sf_dir, "archive_org_texts"), table(spark, sf_dir, "ocr_page_metrics"))


@query
def p8_mix(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[0]


@query
def p8_shares(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[1]
