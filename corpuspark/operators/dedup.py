"""Exact, near and vector duplicates with a keep-first rule."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from corpuspark.functions.text import word_shingles, words
from corpuspark.session import broadcast_if_small, cut

BANDS, ROWS = 20, 5
SIMILARITY = 0.8
#: The profile of single characters: 128 permutations as 32 bands of 4, runs of five characters.
CHARACTER_BANDS, CHARACTER_ROWS, CHARACTER_SIMILARITY = 32, 4, 0.85
#: Members of a bucket from which on it is split into a grid of tasks.
HOT_BUCKET = 1_000
#: Chance that the sketches rule out a pair of the least similarity; for the characters' profile no bucket holds it with a chance of 6e-11.
LOST = 1e-11
#: Shingles and pairs of a block of texts that are compared in one task, and rows of keys that are broadcast.
BLOCK_SHINGLES, BLOCK_PAIRS, BROADCAST_KEYS = 2_000_000, 20_000, 500_000


def first_by(df: DataFrame, group: Column, order: Column) -> DataFrame:
    """Marks the first row of each group; rows with a null group are all kept. The group's first is found by aggregation, so no group is gathered."""
    rows = df.withColumn("__g", group).withColumn("__o", order)
    firsts = rows.where("__g is not null").groupBy("__g").agg(F.min("__o").alias("__first"))
    return rows.join(firsts, "__g", "left").withColumn("kept", F.col("__first").isNull() | (F.col("__o") == F.col("__first"))).drop("__g", "__o", "__first")


def _mixed(v):
    """64-bit numbers of which every bit depends on all bits of the given ones."""
    import numpy as np

    v = (v ^ (v >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    v = (v ^ (v >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return v ^ (v >> np.uint64(31))


def _sketches(bands: int, rows: int):
    """What arrays of distinct 64-bit shingles are compared by: n, class (equal for equal sets), two bits of the least value of each permutation (high and low, 64 a column) and the hashes of the MinHash bands."""
    import numpy as np

    random, size = np.random.default_rng(5), bands * rows
    mul = ((random.integers(1, 1 << 62, size, dtype=np.uint64) << np.uint64(1)) | np.uint64(1))[:, None]
    add = random.integers(1, 1 << 62, size, dtype=np.uint64)[:, None]
    planes = _planes(size)

    @F.pandas_udf(", ".join(["n int", "class bigint", *(f"{c} bigint" for c in planes), "bands array<bigint>"]))
    def run(sets: pd.Series) -> pd.DataFrame:
        least = np.full((len(sets), size), np.iinfo(np.uint64).max, dtype=np.uint64)
        n, classes = np.zeros(len(sets), dtype=np.int32), np.zeros(len(sets), dtype=np.uint64)
        for i, x in enumerate(sets):
            h = np.asarray([] if x is None else x, dtype=np.int64).view(np.uint64)
            n[i], classes[i] = len(h), _mixed(h).sum(dtype=np.uint64)
            for at in range(0, len(h), 256):
                part = mul * h[at : at + 256]
                part += add
                part ^= part >> np.uint64(29)
                np.minimum(least[i], part.min(axis=1), out=least[i])
        hashes = np.zeros((len(sets), bands), dtype=np.uint64)
        for r in range(rows):
            hashes = (hashes ^ least[:, r::rows]) * np.uint64(0x9E3779B97F4A7C15)
        out = {"n": n, "class": _mixed(classes).view(np.int64)}
        words = np.zeros((2, len(sets), len(planes) // 2 * 64), dtype=np.uint8)
        drawn = _mixed(least ^ _mixed(np.arange(1, size + 1, dtype=np.uint64)))
        for bit in (0, 1):
            words[bit, :, :size] = (drawn >> np.uint64(63 - bit)) & np.uint64(1)
        packed = np.packbits(words, axis=2).view(np.int64)
        for k, c in enumerate(planes):
            out[c] = packed[k % 2, :, k // 2]
        return pd.DataFrame(out | {"bands": list(hashes.view(np.int64))})

    return run


def _planes(size: int) -> list[str]:
    return [f"{bit}{k}" for k in range(-(-size // 64)) for bit in ("high", "low")]


def _apart(planes: list[str]) -> Column:
    """In how many permutations the sketches of a and b differ."""
    total = F.lit(0)
    for k in sorted({x.lstrip("highlow") for x in planes}):
        differ = [F.col(f"a_{x}").bitwiseXOR(F.col(f"b_{x}")) for x in planes if x.lstrip("highlow") == k]
        total = total + F.bit_count(differ[0].bitwiseOR(differ[1]) if len(differ) > 1 else differ[0])
    return total


def _most_apart(size: int, similarity: float, bits: int) -> int:
    """In how many of the permutations the sketches of a pair of that similarity may differ; more is less likely than LOST."""
    from math import comb

    equal = similarity + (1 - similarity) / 2**bits
    k, sure = size, 1.0
    while k > 0 and (sure := sum(comb(size, i) * (1 - equal) ** i * equal ** (size - i) for i in range(k, size + 1))) <= LOST:
        k -= 1
    return k


def word_prints(df: DataFrame, key: str, text: str, profile: str = "any") -> DataFrame:
    """(key, set): hashes of the five-word shingles of each text."""
    # the words come from a generator, so that the shingles' inner loop doesn't make them again at each step
    tokens = df.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.explode(F.array(words(F.col(text), profile, 1))).alias("words"))
    return tokens.select("key", word_shingles(F.col("words")).alias("set"))


@F.pandas_udf(T.ArrayType(T.LongType()))
def _character_hashes(texts: pd.Series, k: pd.Series) -> pd.Series:
    """Distinct 64-bit hashes of the runs of k characters of each text, over arrays of code points."""
    import numpy as np

    out = []
    for text, n in zip(texts, k):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        h = np.zeros(max(1, len(codes) - n + 1), dtype=np.uint64)
        for i in range(min(n, len(codes))):
            h = (h ^ codes[i : i + len(h)]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
        out.append(np.unique(h).view(np.int64))
    return pd.Series(out)


def character_prints(df: DataFrame, key: str, text: str, k: int = 5) -> DataFrame:
    """(key, set): hashes of the runs of k characters of each text; a shorter text is its own, an empty one has none."""
    return df.where(F.col(text).isNotNull() & (F.col(text) != "")).select(F.col(key).alias("key"), _character_hashes(F.col(text), F.lit(k)).alias("set"))


def near_pairs(df: DataFrame, key: str = "doc_id", text: str = "text", profile: str = "any", similarity: float = SIMILARITY) -> DataFrame:
    """(a, b, similarity): pairs of different texts whose five-word shingles have that Jaccard similarity, a < b.

    Equal shingle sets share one representative, the smallest key. MinHash bands find candidates, exact Jaccard decides.
    """
    return near_classes(word_prints(df, key, text, profile), similarity, again=lambda keys: word_prints(chosen(df, key, keys), key, text, profile))[1]


def chosen(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows of the keys (key), before anything is made of their texts."""
    return df.join(keys, df[key] == keys["key"], "left_semi")


def bucket_pairs(bands: DataFrame, by: tuple[str, ...] = ("band", "h"), carried: tuple[str, ...] = (), near: Column | None = None) -> DataFrame:
    """(a, b): pairs of keys that share a bucket (by), a < b; the members of a full bucket meet in a grid of cells.

    near: a condition on the carried columns of both, named a_ and b_; it is tried where the members meet, so the pairs
    it rules out are written nowhere. Joins are by sorting: estimates of exploded rows are far too low for a broadcast.
    """
    full = cut(bands.groupBy(*by).agg(F.count(F.lit(1)).alias("n_of_bucket")).where(F.col("n_of_bucket") > HOT_BUCKET))

    def side(rows: DataFrame, x: str, *more: Column) -> DataFrame:
        return rows.select(F.col("key").alias(x), *(F.col(c).alias(f"{x}_{c}") for c in carried), *by, *more)

    def met(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
        return left.hint("merge").join(right, on).where((F.col("a") < F.col("b")) & (F.lit(True) if near is None else near)).select("a", "b")

    if full.isEmpty():
        return met(side(bands, "a"), side(bands, "b"), [*by]).distinct()
    full = broadcast_if_small(full, BROADCAST_KEYS)
    rest = bands.join(full, [*by], "left_anti")
    cells = F.ceil(F.col("n_of_bucket") / HOT_BUCKET).cast("int")
    rows = bands.join(full, [*by]).withColumn("cells", cells).withColumn("own", F.pmod(F.xxhash64("key"), cells).cast("int"))
    each = F.explode(F.sequence(F.lit(0), F.col("cells") - 1))
    grid = met(side(rows, "a", F.col("own").alias("x"), each.alias("y")), side(rows, "b", each.alias("x"), F.col("own").alias("y")), [*by, "x", "y"])
    return met(side(rest, "a"), side(rest, "b"), [*by]).union(grid).distinct()


def near_classes(prints: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, again: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """(key, first), the representative of every text that has shingles (key, set), and the pairs (a, b, similarity) between representatives.

    The sets are made twice, for all texts when they are sketched and for those of a likely pair when it is verified;
    they are neither kept nor joined to candidates. Sketches and sizes rule out candidates, exact Jaccard decides.
    again: makes (key, set) of the keys (key) it is given; without it those are chosen after all sets are made again.
    """
    planes, size = _planes(bands * rows), bands * rows
    high = [x for x in planes if x.startswith("high")]
    sketches = cut(prints.select("key", _sketches(bands, rows)("set").alias("sketch"))).select("key", "sketch.*").where("n > 0")
    firsts = cut(sketches.groupBy("class").agg(F.min("key").alias("first")))
    members = sketches.select("key", "class").join(firsts, "class").select("key", "first").distinct()
    others = cut(sketches.select("key").join(firsts.select(F.col("first").alias("key")), "key", "left_anti").distinct())
    classes = sketches.join(broadcast_if_small(others, BROADCAST_KEYS), "key", "left_anti")
    sized = F.least("a_n", "b_n") >= (similarity - 1e-6) * F.greatest("a_n", "b_n")
    near = sized & (_apart(high) <= _most_apart(size, similarity, 1))
    pairs = bucket_pairs(classes.select("key", "n", *high, F.explode("bands").alias("h")), ("h",), ("n", *high), near)
    sides = pairs
    for x in ("a", "b"):
        sides = sides.join(sketches.select(F.col("key").alias(x), *(F.col(c).alias(f"{x}_{c}") for c in ("n", *planes))).hint("merge"), x)
    likely = cut(sides.where(sized & (_apart(planes) <= _most_apart(size, similarity, 2))).select("a", "b").distinct())
    both, one, other = F.col("both"), F.col("na"), F.col("nb")
    found = _common(likely, again or (lambda keys: prints.join(keys, "key", "left_semi")), sketches).select("a", "b", F.round(both / (one + other - both), 6).alias("similarity")).where(F.col("similarity") >= similarity)
    return members, found.distinct()


def _common(pairs: DataFrame, prints: Callable[[DataFrame], DataFrame], sketches: DataFrame) -> DataFrame:
    """(a, b, both, na, nb): the shingles that the sets of each pair share and the sizes of the two.

    The pairs are dealt into cells of two blocks of texts; a set is sent once to each cell that needs it, however many
    pairs it is part of there, and never broadcast.
    """
    import numpy as np

    kind = pairs.schema["a"].dataType.simpleString()
    keys = cut(pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct())
    listed = broadcast_if_small(keys, BROADCAST_KEYS)
    shingles = sketches.join(listed, "key", "left_semi").agg(F.sum("n")).first()[0] or 0
    blocks = int(max(1, np.ceil(shingles / BLOCK_SHINGLES), np.ceil((pairs.count() / BLOCK_PAIRS) ** 0.5)))
    x, y = (F.pmod(F.xxhash64(c), F.lit(blocks)) for c in ("a", "b"))
    cells = pairs.select("a", "b", F.least(x, y).alias("x"), F.greatest(x, y).alias("y"))
    needed = cut(cells.select(F.col("a").alias("key"), "x", "y").union(cells.select("b", "x", "y")).distinct())
    sets = prints(listed).hint("merge").join(broadcast_if_small(needed, BROADCAST_KEYS), "key")

    def run(wanted: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        known: dict = {}
        for key, values in zip(there["key"], there["set"]):
            known.setdefault(key, []).append(np.asarray(values))
        out = [(a, b, len(np.intersect1d(p, q, assume_unique=True)), len(p), len(q)) for a, b in zip(wanted["a"], wanted["b"]) for p in known.get(a, ()) for q in known.get(b, ())]
        return pd.DataFrame(out, columns=["a", "b", "both", "na", "nb"])

    return cells.groupBy("x", "y").cogroup(sets.groupBy("x", "y")).applyInPandas(run, f"a {kind}, b {kind}, both bigint, na bigint, nb bigint")


def keep_first(keys: DataFrame, pairs: DataFrame) -> DataFrame:
    """(key, kept): a key goes if an earlier kept key is its neighbour; settled round by round, each round in parallel.

    keys: (key); pairs: (a, b) with a < b. A key whose earlier neighbours are all out is kept, one with a kept earlier
    neighbour is out, until none is open.
    """
    state = cut(keys.select("key").distinct().withColumn("kept", F.lit(None).cast("boolean")))
    pairs = cut(pairs.select("a", "b").distinct())
    while True:
        earlier = pairs.join(state.select(F.col("key").alias("a"), F.col("kept").alias("of")), "a").groupBy("b").agg(
            F.coalesce(F.bool_or("of"), F.lit(False)).alias("some"), F.bool_or(F.col("of").isNull()).alias("open")
        )
        step = state.join(earlier, state.key == earlier.b, "left")
        now = F.when(F.col("kept").isNotNull(), F.col("kept")).when(F.coalesce("some", F.lit(False)), F.lit(False)).when(F.coalesce("open", F.lit(False)), F.lit(None)).otherwise(F.lit(True))
        state = cut(step.select("key", now.alias("kept")))
        if state.where("kept is null").isEmpty():
            return state

