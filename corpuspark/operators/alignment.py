"""Sentence alignment and greedy matching of two sub-corpora, one pair or block at a time."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from corpuspark.operators.order import ranked


def align(a: list[str], b: list[str], skip: float = 0.5) -> list[tuple[str, str]]:
    """One-to-one alignment of least cost by length: the difference in characters for a pair, `skip` times its length for a sentence left out.

    Of equal costs a pair goes before leaving out a sentence of a, and that before one of b.
    """
    cost = np.zeros((len(a) + 1, len(b) + 1))
    step = np.zeros((len(a) + 1, len(b) + 1), dtype=np.int8)
    left, right = np.array([len(x) for x in a], dtype=float), np.array([len(x) for x in b], dtype=float)
    cost[1:, 0], cost[0, 1:] = np.cumsum(left) * skip, np.cumsum(right) * skip
    step[1:, 0], step[0, 1:] = 1, 2
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            options = (cost[i - 1, j - 1] + abs(left[i - 1] - right[j - 1]), cost[i - 1, j] + left[i - 1] * skip, cost[i, j - 1] + right[j - 1] * skip)
            step[i, j] = min(range(3), key=options.__getitem__)
            cost[i, j] = options[step[i, j]]
    out, i, j = [], len(a), len(b)
    while i or j:
        if step[i, j] == 0:
            i, j = i - 1, j - 1
            out.append((a[i], b[j]))
        elif step[i, j] == 1:
            i -= 1
        else:
            j -= 1
    return out[::-1]


def aligned(pairs: DataFrame) -> DataFrame:
    """(pair_id, position, left, right) of rows (pair_id, left array, right array); null arrays align nothing."""

    def run(batches):
        for pdf in batches:
            rows = []
            for key, a, b in zip(pdf["pair_id"], pdf["left"], pdf["right"]):
                found = align(list(a) if a is not None else [], list(b) if b is not None else [])
                rows += [(key, i, x, y) for i, (x, y) in enumerate(found)]
            yield pd.DataFrame(rows, columns=["pair_id", "position", "left", "right"])

    return pairs.select("pair_id", "left", "right").mapInPandas(run, "pair_id bigint, position int, left string, right string")


def matched_by_length(left: DataFrame, right: DataFrame, key: str, length: str, width: int = 10) -> DataFrame:
    """(left, right, left_n, right_n): rows of two tables paired by near length, each used at most once.

    Lengths are cut into bands of `width`; within a band both sides are ranked by length and paired rank by rank, so of a
    band the smaller side is used up. Ranks are made over range partitions: no band, however full, is gathered. Null
    lengths have no partner.
    """
    sides = []
    for side, df in (("left", left), ("right", right)):
        rows = df.where(F.col(length).isNotNull()).select(F.col(key).alias(side), F.col(length).alias(f"{side}_n"), F.floor(F.col(length) / width).alias("band"))
        placed = ranked(rows, [], ["band", f"{side}_n", side])
        firsts = placed.groupBy("band").agg(F.min("rank").alias("__first"))
        sides.append(placed.join(firsts, "band").select(side, f"{side}_n", "band", (F.col("rank") - F.col("__first")).alias("place")))
    return sides[0].join(sides[1], ["band", "place"]).select("left", "right", "left_n", "right_n")
