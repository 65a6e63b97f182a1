"""Word-frequency lists: weights, facets, incremental maintenance and drift."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from corpuspark.functions.text import words
from corpuspark.operators.order import ranked
from corpuspark.session import broadcast_if_small

# Weight of a source in the list; a source "kind:name" falls back to its kind, others weigh 1.
SOURCE_WEIGHTS = {
    "wikipedia": 1.0, "wikipedia_wa": 1.0, "wikipedia_ea": 0.5, "wikisource": 1.0, "newspaper": 1.5, "eastern_armenian_news": 0.5, "rss_news": 1.5,
    "archive_org": 1.2, "hathitrust": 1.2, "loc": 1.2, "dpla": 1.0, "gallica": 1.2, "gomidas": 1.2, "culturax": 0.8, "english_sources": 0.3, "nayiri": 1.0, "mss_nkr": 1.2,
}
LEAST_TOTAL = 2.0
#: Targets are listed by hand; up to this many they are sent to every task.
MOST_TARGETS = 100_000


def source_weight(source: Column) -> Column:
    table = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in SOURCE_WEIGHTS.items()))
    return F.coalesce(F.try_element_at(table, source), F.try_element_at(table, F.substring_index(source, ":", 1)), F.lit(1.0))


def word_counts(df: DataFrame, by: list[str], text: str = "text", profile: str = "frequency") -> DataFrame:
    """(by..., word, n): counted before the shuffle, so a hot source costs no more than its vocabulary."""
    return df.select(*by, F.explode(words(F.col(text), profile)).alias("word")).groupBy(*by, "word").agg(F.count(F.lit(1)).alias("n"))


def weighted_list(counts: DataFrame, weight: Column | None = None, least: float = LEAST_TOTAL) -> DataFrame:
    """(rank, word, total, sources): the list over (source, word, n), heaviest first, ties by word.

    The cut is on the unrounded total, the order on the rounded one. The rank is a running number over the kept words.
    """
    weight = source_weight(F.col("source")) if weight is None else weight
    rows = counts.groupBy("word").agg(F.sum(F.col("n") * weight).alias("raw"), F.countDistinct("source").alias("sources")).where(F.col("raw") >= least)
    rows = rows.select("word", F.round("raw", 2).alias("total"), "sources")
    return ranked(rows, ["total"], ["word"])


def target_weights(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, weight): target share over actual share, between 0.1 and 10.

    A source "kind:name" without a share of its own takes that of its kind; one without a positive share weighs 1.
    """
    counts = docs.where("source is not null").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("current", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0))))  # a row per source
    shares = targets.where("source is not null").groupBy(F.col("source").alias("of")).agg(F.max("target_share").alias("share"))
    shares = broadcast_if_small(shares, MOST_TARGETS)
    own = counts.join(shares.withColumnRenamed("share", "own"), F.col("source") == F.col("of"), "left").drop("of")
    both = own.join(shares.withColumnRenamed("share", "kind"), F.substring_index("source", ":", 1) == F.col("of"), "left").drop("of")
    share = F.coalesce(F.nullif("own", F.lit(0.0)), F.col("kind"))
    clamped = F.greatest(F.lit(0.1), F.least(F.lit(10.0), share / F.greatest(F.col("current"), F.lit(1e-6))))
    return both.select("source", F.round(F.when(share > 0, clamped).otherwise(1.0), 6).alias("weight"))


def hybrid_weights(docs: DataFrame, strength: float = 0.2) -> DataFrame:
    """(source, weight): the fixed weight times 1 + strength * (mean score - 5) / 5, that factor between 0.5 and 2."""
    mean = docs.where("source is not null").groupBy("source").agg(F.avg("wa_score").alias("mean"))
    factor = F.greatest(F.lit(0.5), F.least(F.lit(2.0), 1 + strength * (F.col("mean") - 5) / 5))
    return mean.select("source", F.round(source_weight(F.col("source")) * F.coalesce(factor, F.lit(1.0)), 6).alias("weight"))


def delta(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., change): signed differences of two states of counts (keys..., n), unchanged ones left out."""
    a, b = old.withColumnRenamed("n", "was"), new.withColumnRenamed("n", "now")
    joined = a.join(b, keys, "full_outer")
    return joined.select(*keys, (F.coalesce("now", F.lit(0)) - F.coalesce("was", F.lit(0))).alias("change")).where("change <> 0")


def merged(totals: DataFrame, change: DataFrame, keys: list[str]) -> DataFrame:
    """Totals with a delta applied; counts that fall to nothing go."""
    both = totals.select(*keys, "n").unionByName(change.select(*keys, F.col("change").alias("n")))
    return both.groupBy(*keys).agg(F.sum("n").alias("n")).where("n > 0")


def facets(df: DataFrame, values: dict[str, Column], text: str = "text", profile: str = "frequency") -> DataFrame:
    """(facet, facet_value, word, n): word sums along each facet; null and empty facet values are left out."""
    pairs = F.filter(F.array(*[F.struct(F.lit(k).alias("facet"), v.cast("string").alias("facet_value")) for k, v in values.items()]), lambda x: x["facet_value"].isNotNull() & (x["facet_value"] != ""))
    base = df.select(F.explode(pairs).alias("f"), words(F.col(text), profile).alias("ws"))
    return base.select("f.*", F.explode("ws").alias("word")).groupBy("facet", "facet_value", "word").agg(F.count(F.lit(1)).alias("n"))


def drift(base: DataFrame, now: DataFrame, top: int = 100, alert: float = 0.05) -> DataFrame:
    """One row: greatest and mean absolute change of relative frequency over the union of each side's top words, and an alert."""

    def head(df, name):
        rel = df.crossJoin(F.broadcast(df.agg(F.sum("n").alias("all")))).withColumn(name, F.col("n") / F.col("all"))
        return rel.select("word", name).orderBy(F.desc(name), "word").limit(top)

    both = head(base, "p").join(head(now, "q"), "word", "full_outer")
    gap = F.abs(F.coalesce("p", F.lit(1e-9)) - F.coalesce("q", F.lit(1e-9)))
    return both.agg(F.round(F.max(gap), 8).alias("max_gap"), F.round(F.avg(gap), 8).alias("mean_gap"), F.coalesce(F.max(gap) > alert, F.lit(False)).alias("alert"), F.count(F.lit(1)).alias("compared"))
