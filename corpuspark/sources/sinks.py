"""Writers: sorted exports, line files, reports and keyed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpuspark.operators.release import upsert


def export_sorted(df: DataFrame, path: str, key: str, other: str, files: int | None = None) -> None:
    """Parquet range-sorted by (key, other); with one file the order is total, with more it is total over the file names."""
    rows = df.repartitionByRange(files, key, other) if files else df.repartitionByRange(key, other)
    rows.sortWithinPartitions(key, other).write.mode("overwrite").parquet(path)


def emit_clean(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", label: str | None = None, wanted: str | None = None) -> None:
    """JSON lines of (key, text), of one label if asked; null and empty texts are left out."""
    rows = df.where(F.col(text).isNotNull() & (F.col(text) != ""))
    if label:
        rows = rows.where(F.col(label) == wanted)
    rows.select(F.col(key).alias("id"), F.col(text).alias("text")).write.mode("overwrite").json(path)


def write_report(df: DataFrame, path: str, form: str = "csv") -> None:
    """A report as CSV with a header, or as JSON lines."""
    writer = df.write.mode("overwrite")
    writer.option("header", "true").csv(path) if form == "csv" else writer.json(path)


def replace_report(df: DataFrame, path: str, order: list[str], preview: int = 100) -> DataFrame:
    """Replaces a report's rows and gives its first `preview` rows in order."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path).orderBy(*order).limit(preview)


def upsert_table(incoming: DataFrame, path: str, keys: list[str], version: int) -> None:
    """Writes the next version of a keyed table: rows of the last one whose keys came again are replaced."""
    spark = incoming.sparkSession
    stamped = incoming.withColumn("updated_at", F.current_timestamp())
    rows = upsert(spark.read.parquet(f"{path}/v={version - 1:06d}"), stamped, keys) if version else stamped
    rows.write.mode("overwrite").parquet(f"{path}/v={version:06d}")


def write_dashboard(counts: DataFrame, path: str, title: str = "Corpus") -> None:
    """A page with one row per source of (source, documents, latest), largest first, written as text; made of aggregated rows only."""
    cell = lambda c: F.concat(F.lit("<td>"), F.replace(F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit("</td>"))
    rows = counts.orderBy(F.desc("documents"), "source").select(F.concat(F.lit("<tr>"), *[cell(c) for c in ("source", "documents", "latest")], F.lit("</tr>")).alias("row"))
    body = rows.agg(F.array_join(F.collect_list("row"), "\n").alias("rows"))
    page = F.concat(F.lit(f"<html><head><meta charset='utf-8'><title>{title}</title></head><body><table>\n<tr><th>source</th><th>documents</th><th>latest</th></tr>\n"), "rows", F.lit("\n</table></body></html>"))
    body.select(page.alias("value")).coalesce(1).write.mode("overwrite").text(path)


def with_updates(existing: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """`existing` with the fields that `updates` has and that aren't null there; keys not in `existing` are left out."""
    fields = [c for c in updates.columns if c not in keys]
    new = updates.groupBy(*keys).agg(*[F.max(c).alias(f"__{c}") for c in fields])
    rows = existing.join(new, keys, "left")
    return rows.select(*[F.coalesce(F.col(f"__{c}"), F.col(c)).alias(c) if c in fields else F.col(c) for c in existing.columns])
