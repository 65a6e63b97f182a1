"""Exact top-k retrieval of a stated query set against all rows, in blocks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from corpuspark.session import cut

BLOCK_QUERIES = 5_000


def _blocks(queries: DataFrame, vectors: DataFrame, key: str, vector: str, choose) -> DataFrame:
    """(query_id, key, score): what `choose` keeps of the cosines of each block of queries and each batch of rows."""
    asked = queries.where(f"{vector} is not null").select(key, vector)
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    rows, out = vectors.where(f"{vector} is not null").select(key, F.col(vector).alias(key + "__v")), None
    for n in range(blocks):  # the driver holds one block of queries at a time
        block = sorted((r[key], r[vector]) for r in asked.where(F.pmod(F.xxhash64(key), F.lit(blocks)) == n).toLocalIterator())
        unit = np.array([v for _, v in block], dtype=float)
        unit = unit / np.linalg.norm(unit, axis=1, keepdims=True) if len(block) else unit
        sent = vectors.sparkSession.sparkContext.broadcast((np.array([i for i, _ in block]), unit))

        def run(batches, sent=sent):
            ids, unit = sent.value
            for pdf in batches:
                if len(ids) and len(pdf):
                    v, names = np.array(pdf[key + "__v"].tolist(), dtype=float), pdf[key].to_numpy()
                    scores = unit @ (v / np.linalg.norm(v, axis=1, keepdims=True)).T
                    scores[ids[:, None] == names[None, :]] = -np.inf
                    q, c = choose(scores)
                    yield pd.DataFrame({"query_id": ids[q], key: names[c], "score": scores[q, c]})

        found = rows.mapInPandas(run, f"query_id bigint, {key} bigint, score double")
        out = found if out is None else out.unionByName(found)
    return out


def nearest(queries: DataFrame, vectors: DataFrame, key: str, vector: str, k: int = 5) -> DataFrame:
    """(query_id, key, rank, score): the k rows of greatest cosine for each query, itself left out, ties by key.

    Each block of queries is broadcast and meets every row once; a task keeps only its own best k, so what is shuffled is
    some k rows per query and batch. Null vectors have no neighbours and are none.
    """

    def best(scores):
        few = min(k, scores.shape[1])
        top = np.argpartition(-scores, few - 1, axis=1)[:, :few]
        edge = np.take_along_axis(scores, top, axis=1).min(axis=1)  # ties at the edge stay for the final order
        return np.nonzero((scores >= edge[:, None]) & np.isfinite(scores))

    out = _blocks(queries, vectors, key, vector, best)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), key)
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", key, "rank", F.round("score", 5).alias("score"))


def within(queries: DataFrame, vectors: DataFrame, key: str, vector: str, distance: float) -> DataFrame:
    """(query_id, key, distance): rows whose unit vector lies within a Euclidean distance of a query's, exact."""
    least = 1 - distance**2 / 2
    out = _blocks(queries, vectors, key, vector, lambda scores: np.nonzero(scores >= least))
    return out.select("query_id", key, F.round(F.sqrt(F.greatest(2 - 2 * F.col("score"), F.lit(0.0))), 5).alias("distance"))


#: Tables of random projections, projections of a table, and width of a projection's cells in distances: a pair at the
#: distance itself shares a cell of some table with a chance of 0.99, a nearer one with a greater.
TABLES, PROJECTIONS, WIDTH = 16, 4, 4.0


def _cells(vector: str, distance: float, unit: bool, seed: int):
    """(key, band, h): the cell of each vector in each table of random projections."""

    def run(batches):
        random = np.random.default_rng(seed)
        rays = offsets = None
        for pdf in batches:
            if not len(pdf):
                continue
            v = np.array(pdf[vector].tolist(), dtype=float)
            v = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12) if unit else v
            if rays is None:
                rays, offsets = random.standard_normal((v.shape[1], TABLES * PROJECTIONS)), random.random(TABLES * PROJECTIONS)
            cell = np.floor(v @ rays / (WIDTH * distance) + offsets).astype(np.int64).reshape(len(v), TABLES, PROJECTIONS)
            h = np.zeros((len(v), TABLES), dtype=np.uint64)
            for p in range(PROJECTIONS):
                h = (h ^ cell[:, :, p].view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            yield pd.DataFrame({"key": np.repeat(pdf["key"].to_numpy(), TABLES), "band": np.tile(np.arange(TABLES), len(v)), "h": h.reshape(-1).view(np.int64)})

    return run


def near_vectors(df: DataFrame, key: str, vector: str, distance: float, angular: bool = False, seed: int = 42) -> DataFrame:
    """(a, b, distance): pairs of vectors, a < b, within a Euclidean distance, or within 1 - cosine if angular.

    Random projections find candidates, exact distances decide; each pair is missed with a chance under 0.01. Null vectors
    have no neighbours.
    """
    from corpuspark.operators.dedup import bucket_pairs

    rows = cut(df.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v")))
    span = float(np.sqrt(2 * distance)) if angular else distance
    cells = rows.mapInPandas(_cells("v", span, angular, seed), f"key {rows.schema['key'].dataType.simpleString()}, band int, h bigint")
    pairs = bucket_pairs(cut(cells))
    sides = pairs.join(rows.select(F.col("key").alias("a"), F.col("v").alias("x")), "a").join(rows.select(F.col("key").alias("b"), F.col("v").alias("y")), "b")
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda s, z: s + z)
    apart = F.sqrt(total(F.zip_with("x", "y", lambda p, q: (p - q) * (p - q))))
    if angular:
        norm = lambda c: F.sqrt(total(F.transform(c, lambda z: z * z)))
        apart = 1 - total(F.zip_with("x", "y", lambda p, q: p * q)) / (norm("x") * norm("y"))
    return sides.select("a", "b", apart.alias("distance")).where(F.col("distance") <= distance).select("a", "b", F.round("distance", 6).alias("distance"))


def kept_vectors(df: DataFrame, key: str, vector: str, distance: float, angular: bool = False) -> DataFrame:
    """(key, kept): a vector goes if an earlier kept one is within the distance; null vectors are left out."""
    from corpuspark.operators.dedup import keep_first

    keys = df.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(F.col(key).alias("key"))
    return keep_first(keys, near_vectors(df, key, vector, distance, angular).select("a", "b"))
