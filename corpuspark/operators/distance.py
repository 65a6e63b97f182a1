"""Distances between two sub-corpora's word distributions and between word forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpuspark.operators.order import steps


def distributions(a: DataFrame, b: DataFrame) -> DataFrame:
    """(word, na, nb, p, q): counts and relative frequencies side by side over the union of words."""
    both = a.select("word", F.col("n").alias("na")).join(b.select("word", F.col("n").alias("nb")), "word", "full_outer").fillna(0, ["na", "nb"])
    totals = both.agg(F.sum("na").alias("ta"), F.sum("nb").alias("tb"))
    return both.crossJoin(F.broadcast(totals)).select("word", "na", "nb", (F.col("na") / F.nullif("ta", F.lit(0))).alias("p"), (F.col("nb") / F.nullif("tb", F.lit(0))).alias("q"))


def divergences(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: Jensen-Shannon (base 2 and natural), Hellinger, cosine, weighted Jaccard and KL of two word counts."""
    d = distributions(a, b)
    p, q = F.coalesce("p", F.lit(0.0)), F.coalesce("q", F.lit(0.0))
    m = (p + q) / 2
    half = lambda x: F.when(x > 0, x * F.ln(x / m)).otherwise(0.0)
    js = F.sum(half(p) + half(q)) / 2
    cosine = 1 - F.sum(p * q) / F.sqrt(F.sum(p * p) * F.sum(q * q))
    kl = F.sum(F.when(p > 0, p * F.ln(p / F.greatest(q, F.lit(1e-10)))).otherwise(0.0))
    return d.agg(
        F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), js / F.ln(F.lit(2.0)))), 6).alias("js_bits"),
        F.round(js, 6).alias("js_nats"),
        F.round(F.sqrt(F.sum(F.pow(F.sqrt(p) - F.sqrt(q), F.lit(2)))) / F.sqrt(F.lit(2.0)), 6).alias("hellinger"),
        F.round(cosine, 6).alias("cosine"),
        F.round(1 - F.sum(F.least("na", "nb")) / F.sum(F.greatest("na", "nb")), 6).alias("jaccard"),
        F.round(kl, 6).alias("kl"),
    )


def wasserstein(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row (distance): area between the distribution functions of two samples (value), over their span.

    Values are counted first; the running sums go over range partitions of the different values.
    """
    both = a.groupBy("value").agg(F.count(F.lit(1)).alias("na")).join(b.groupBy("value").agg(F.count(F.lit(1)).alias("nb")), "value", "full_outer").fillna(0, ["na", "nb"])
    rows = steps(both, "value", ["na", "nb"]).crossJoin(F.broadcast(both.agg(F.sum("na").alias("ta"), F.sum("nb").alias("tb"))))
    gap = F.abs(F.col("upto_na") / F.nullif("ta", F.lit(0)) - F.col("upto_nb") / F.nullif("tb", F.lit(0))) * (F.col("next") - F.col("value"))
    return rows.agg(F.round(F.coalesce(F.sum(gap), F.lit(0.0)) / F.nullif(F.max("value") - F.min("value"), F.lit(0)), 6).alias("distance"))


def orthographic_load(a: Column, b: Column, alpha: float = 1.0, beta: float = 2.0) -> Column:
    """alpha times the difference in letters plus beta times that in spaces."""
    letters = lambda x: F.regexp_count(x, F.lit(r"\p{L}"))
    spaces = lambda x: F.regexp_count(x, F.lit(" "))
    return alpha * F.abs(letters(a) - letters(b)) + beta * F.abs(spaces(a) - spaces(b))


def token_jaccard(a: Column, b: Column) -> Column:
    """Jaccard of two word sets, 1 where both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def mapping_shift(tokens: DataFrame, mapping: DataFrame) -> DataFrame:
    """One row (rate): share of word occurrences (word, n) that are eastern forms of the mapping (eastern)."""
    known = mapping.select(F.col("eastern").alias("word"), F.lit(True).alias("hit")).distinct()
    return tokens.join(known, "word", "left").agg(F.round(F.coalesce(F.sum(F.when(F.col("hit"), F.col("n"))), F.lit(0)) / F.nullif(F.sum("n"), F.lit(0)), 6).alias("rate"))


def variant_usage(west: DataFrame, east: DataFrame, pairs: DataFrame, alpha: float = 1.0) -> DataFrame:
    """One row (distance): mean difference in how often each side uses the first of two variants, smoothed, weighted by ln(1 + support)."""
    def side(df, name):
        a = df.select(F.col("word").alias("first"), F.col("n").alias(f"{name}1"))
        b = df.select(F.col("word").alias("second"), F.col("n").alias(f"{name}2"))
        return a, b

    rows = pairs.select("first", "second")
    for name, df in (("w", west), ("e", east)):
        a, b = side(df, name)
        rows = rows.join(a, "first", "left").join(b, "second", "left")
    rows = rows.fillna(0)
    rate = lambda s: (F.col(f"{s}1") + alpha) / (F.col(f"{s}1") + F.col(f"{s}2") + 2 * alpha)
    weight = F.log1p(F.col("w1") + F.col("w2") + F.col("e1") + F.col("e2"))
    return rows.agg(F.round(F.sum(F.abs(rate("w") - rate("e")) * weight) / F.nullif(F.sum(weight), F.lit(0.0)), 6).alias("distance"))


def context_divergence(west: DataFrame, east: DataFrame) -> DataFrame:
    """(keyword, js_bits): Jensen-Shannon divergence of two context counts (keyword, word, n), keyword by keyword."""
    def relative(df, name):
        total = df.groupBy("keyword").agg(F.sum("n").alias("t"))
        return df.join(total, "keyword").select("keyword", "word", (F.col("n") / F.col("t")).alias(name))

    both = relative(west, "p").join(relative(east, "q"), ["keyword", "word"], "full_outer").fillna(0.0, ["p", "q"])
    m = (F.col("p") + F.col("q")) / 2
    half = lambda x: F.when(F.col(x) > 0, F.col(x) * F.log2(F.col(x) / m)).otherwise(0.0)
    return both.groupBy("keyword").agg(F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.sum(half("p") + half("q")) / 2)), 6).alias("js_bits"))


def composite(phonetic: Column, lexical: Column, orthographic: Column) -> Column:
    return 0.4 * phonetic + 0.4 * lexical + 0.2 * orthographic


# Weights of the parts of a component distance; the parts a call has no data for count as 0.
LEXICAL, STRUCTURAL = 0.65, 0.35
LEXICAL_PARTS = {"js_bits": 0.40, "jaccard": 0.25, "mapping_shift": 0.15, "variant_usage": 0.20, "context_js": 0.0}
STRUCTURAL_PARTS = {"distance": 0.60, "bigram_js": 0.40}


def _weighted(df: DataFrame, parts: dict[str, float]) -> Column:
    total = sum(max(w, 0.0) for w in parts.values())
    share = {k: max(w, 0.0) / total if total > 0 else 1 / len(parts) for k, w in parts.items()}
    return sum((w * F.coalesce(F.col(k), F.lit(0.0)) for k, w in share.items() if k in df.columns), F.lit(0.0))


def components(parts: DataFrame, lexical: dict[str, float] | None = None, structural: dict[str, float] | None = None) -> DataFrame:
    """One row (lexical, structural, total) of one row of parts; weights of each side are brought to a sum of 1."""
    a, b = _weighted(parts, lexical or LEXICAL_PARTS), _weighted(parts, structural or STRUCTURAL_PARTS)
    return parts.select(F.round(a, 6).alias("lexical"), F.round(b, 6).alias("structural"), F.round(LEXICAL * a + STRUCTURAL * b, 6).alias("total"))
