"""Coverage of authors, periods, kinds and works, gaps by priority, and summaries of an inventory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Shares of covered works under which a gap is reported, and the priorities in order.
AUTHOR_LOW, PERIOD_LOW, KIND_LOW = 0.25, 0.30, 0.40
PRIORITIES = ("high", "medium", "low")


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


def gaps(works: DataFrame) -> DataFrame:
    """(gap_type, name, works, covered, share, priority, impact) of works (work, author, year, kind, covered).

    An author without any covered work is of high priority, one under a quarter of medium; periods and kinds under their
    shares are of medium and low. impact is how many works are missing. Null authors, years and kinds make no gap.
    """

    def side(name: str, value: Column, low: float, priority: Column) -> DataFrame:
        g = works.where(value.isNotNull()).groupBy(value.cast("string").alias("name")).agg(F.count(F.lit(1)).alias("works"), F.count_if("covered").alias("covered"))
        g = g.withColumn("share", F.round(F.col("covered") / F.col("works"), 6)).where(F.col("share") < low)
        return g.select(F.lit(name).alias("gap_type"), "name", "works", "covered", "share", priority.alias("priority"), (F.col("works") - F.col("covered")).alias("impact"))

    out = side("author", F.col("author"), AUTHOR_LOW, F.when(F.col("covered") == 0, "high").otherwise("medium"))
    out = out.unionByName(side("period", decade(F.col("year")), PERIOD_LOW, F.lit("medium")))
    return out.unionByName(side("kind", F.col("kind"), KIND_LOW, F.lit("low")))


def ranked_gaps(found: DataFrame, most: int) -> DataFrame:
    """The first gaps by priority, then by impact, then by name."""
    place = F.array_position(F.array(*map(F.lit, PRIORITIES)), F.col("priority"))
    return found.orderBy(place, F.desc("impact"), "gap_type", "name").limit(most)


def inventory_summary(works: DataFrame) -> DataFrame:
    """(facet, value, works, covered, words): counts by kind, decade and author, and over all."""
    facets = F.array(*[F.struct(F.lit(n).alias("facet"), v.cast("string").alias("value")) for n, v in (("all", F.lit("all")), ("kind", F.col("kind")), ("decade", decade(F.col("year"))), ("author", F.col("author")))])
    rows = works.select("covered", "words", F.explode(facets).alias("f")).where("f.value is not null")
    return rows.groupBy("f.facet", "f.value").agg(F.count(F.lit(1)).alias("works"), F.count_if("covered").alias("covered"), F.coalesce(F.sum(F.when(F.col("covered"), F.col("words"))), F.lit(0)).alias("words"))


def active_in(profiles: DataFrame, start: int, end: int) -> DataFrame:
    """Profiles (name, first, last) whose years overlap a period; an open end counts as the year of the other."""
    first, last = F.coalesce("first", "last"), F.coalesce("last", "first")
    return profiles.where((first <= end) & (last >= start))


def named(profiles: DataFrame, name: str, fuzzy: bool = True) -> DataFrame:
    """Profiles one of whose variants has a name in it, or is it if not fuzzy; letter case doesn't count."""
    wanted = name.strip().lower()
    return profiles.where(F.exists("variants", lambda v: F.lower(v).contains(wanted) if fuzzy else F.lower(v) == wanted))


# The years that generations of authors begin with.
GENERATIONS = ((1870, "before 1870"), (1890, "1870 to 1889"), (1920, "1890 to 1919"), (1950, "1920 to 1949"), (1975, "1950 to 1974"))


def generation(year: Column) -> Column:
    out = F.when(year.isNull(), "unknown")
    for end, name in GENERATIONS:
        out = out.when(year < end, name)
    return out.otherwise("from 1975")
