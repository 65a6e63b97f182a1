"""Density clusters of feature vectors: fitted on a bounded, documented sample, given to every row."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

#: Rows clustered at most: the method compares all of them, so the sample, not the corpus, is its input.
MOST_ROWS = 5000


def standardized(matrix: np.ndarray) -> np.ndarray:
    spread = matrix.std(axis=0)
    return (matrix - matrix.mean(axis=0)) / np.where(spread > 0, spread, 1.0)


def principal(matrix: np.ndarray, dimensions: int = 2) -> np.ndarray:
    centred = matrix - matrix.mean(axis=0)
    _, _, v = np.linalg.svd(centred, full_matrices=False)
    return centred @ v[:dimensions].T


def dbscan(matrix: np.ndarray, eps: float, least: int) -> np.ndarray:
    """Cluster number of each row, -1 for noise; clusters are numbered by their first core row."""
    n = len(matrix)
    if n > MOST_ROWS:
        raise ValueError(f"at most {MOST_ROWS} rows")
    near = [np.flatnonzero(((matrix - x) ** 2).sum(axis=1) <= eps**2) for x in matrix]
    core = np.array([len(x) >= least for x in near], dtype=bool)
    labels, number = np.full(n, -1), 0
    for i in range(n):
        if not core[i] or labels[i] >= 0:
            continue
        stack, labels[i] = [i], number
        while stack:
            for j in near[stack.pop()]:
                if labels[j] < 0:
                    labels[j] = number
                    if core[j]:
                        stack.append(j)
        number += 1
    return labels


def sweep(matrix: np.ndarray, eps: tuple[float, ...] = (0.3, 0.5, 0.8, 1.0, 1.5), least: tuple[int, ...] = (4, 8, 12)) -> list[dict]:
    flat = principal(standardized(matrix))
    out = []
    for e in eps:
        for m in least:
            labels = dbscan(flat, e, m)
            out.append({"eps": e, "least": m, "clusters": int(labels.max() + 1), "noise": float((labels < 0).mean())})
    return out


def clustered(df: DataFrame, key: str, features: str, eps: float = 0.8, least: int = 8, dimensions: int | None = None, rows: int = MOST_ROWS) -> DataFrame:
    """(key, cluster): the cluster of every row by its features (array<double>), -1 for noise.

    Means and spreads are taken over all rows. Clusters are fitted on `rows` rows, those of the least hashes of their keys,
    so the same ones each time; every other row joins the cluster of its nearest core row within eps, if there is one. With
    dimensions, the clusters are those of so many principal components of the sample. Null features are left out; where
    there are no more than `rows` rows the outcome is that of the plain method.
    """
    if rows > MOST_ROWS:
        raise ValueError(f"at most {MOST_ROWS} rows")
    kept = df.where(F.col(key).isNotNull() & F.col(features).isNotNull()).select(F.col(key).alias("key"), F.col(features).cast("array<double>").alias("f"))
    stats = kept.select(F.posexplode("f").alias("i", "x")).groupBy("i").agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s")).orderBy("i").collect()  # a row per feature
    sample = kept.orderBy(F.xxhash64("key"), "key").limit(rows).collect()
    spark, kind = df.sparkSession, f"key {kept.schema['key'].dataType.simpleString()}, cluster int"
    if not sample:
        return spark.createDataFrame([], kind).withColumnRenamed("key", key)
    mean, spread = np.array([r["m"] for r in stats]), np.array([r["s"] if r["s"] and r["s"] > 0 else 1.0 for r in stats])
    matrix = (np.array([r["f"] for r in sample]) - mean) / spread
    rays = np.linalg.svd(matrix - matrix.mean(axis=0), full_matrices=False)[2][:dimensions].T if dimensions else np.eye(matrix.shape[1])
    flat = matrix @ rays
    labels = dbscan(flat, eps, least)
    near = np.array([((flat - x) ** 2).sum(axis=1).__le__(eps**2).sum() for x in flat])
    core = (near >= least) & (labels >= 0)
    known = {r["key"]: int(c) for r, c in zip(sample, labels)}
    sent = spark.sparkContext.broadcast((mean, spread, rays, flat[core], labels[core], known))

    def run(batches):
        mean, spread, rays, cores, of, known = sent.value
        for pdf in batches:
            v = (np.array(pdf["f"].tolist()) - mean) / spread @ rays if len(pdf) else np.zeros((0, rays.shape[1]))
            out = []
            for k, x in zip(pdf["key"], v):
                if k in known:
                    out.append(known[k])
                    continue
                d = ((cores - x) ** 2).sum(axis=1) if len(cores) else np.array([np.inf])
                out.append(int(of[d.argmin()]) if d.min() <= eps**2 else -1)
            yield pd.DataFrame({"key": pdf["key"], "cluster": out})

    return kept.mapInPandas(run, kind).withColumnRenamed("key", key)
