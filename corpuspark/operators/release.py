"""Deterministic release splits, sorted export and manifests."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F


def split_of(key: Column, seed: str = "corpus", train: float = 0.9, validation: float = 0.05) -> Column:
    """train, validation or test by the first 64 bits of SHA-256 of seed:key."""
    if not 0 <= train + validation <= 1 + 1e-6:
        raise ValueError("shares must sum to at most 1")
    bits = F.conv(F.substring(F.sha2(F.concat(F.lit(seed + ":"), key), 256), 1, 16), 16, 10).cast("decimal(20,0)").cast("double") / F.lit(2.0**64)
    return F.when(bits < train, "train").when(bits < train + validation, "validation").otherwise("test")


def checksums(spark, path: str) -> DataFrame:
    """(file, bytes, sha256) of the files of a release, hashed where they are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    return files.select(F.regexp_extract("path", r"([^/]+/[^/]+)$", 1).alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def card_of(manifest: dict) -> str:
    """A short description of a release in words."""
    rows = "\n".join(f"- {k}: {v} documents" for k, v in sorted(manifest["rows"].items()))
    return f"# Corpus release\n\nSplit by hash with seed `{manifest['seed']}`, {sum(manifest['rows'].values())} documents in all.\n\n{rows}\n\nFiles and their checksums are listed in `checksums`.\n"


def write_release(df: DataFrame, path: str, key: str = "content_hash", seed: str = "corpus") -> dict:
    """Writes the rows by split, each split range-sorted by key, all rows sorted beside, checksums, manifest and card; returns the manifest.

    Everything is written by tasks; the driver only sees a count per split. Any file system that Spark writes to will do.
    """
    spark = df.sparkSession
    rows = df.withColumn("split", split_of(F.col(key).cast("string"), seed))
    rows.repartitionByRange("split", key).sortWithinPartitions("split", key).write.mode("overwrite").partitionBy("split").parquet(f"{path}/splits")
    written = spark.read.parquet(f"{path}/splits")
    written.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite").parquet(f"{path}/full")
    counts = {r["split"]: r["n"] for r in written.groupBy("split").agg(F.count(F.lit(1)).alias("n")).toLocalIterator()}
    manifest = {"seed": seed, "rows": counts}
    checksums(spark, path).orderBy("file").write.mode("overwrite").json(f"{path}/checksums")
    for name, text in (("manifest", json.dumps(manifest, sort_keys=True)), ("card", card_of(manifest))):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{name}")
    return manifest


def insert_new(incoming: DataFrame, existing: DataFrame, key: str = "content_hash", order: str = "doc_id") -> DataFrame:
    """Rows of `incoming` whose key is not in `existing`, the first of each key by `order`; rows without a key are all new."""
    keyed = incoming.where(F.col(key).isNotNull())
    firsts = keyed.groupBy(key).agg(F.min(order).alias(order))
    fresh = keyed.join(firsts, [key, order], "left_semi").join(existing.select(key).distinct(), key, "left_anti")
    return fresh.select(*incoming.columns).unionByName(incoming.where(F.col(key).isNull()))


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """`existing` with rows of the same keys replaced by those of `incoming`."""
    return existing.join(incoming.select(*keys).distinct(), keys, "left_anti").select(*existing.columns).unionByName(incoming, allowMissingColumns=True)
