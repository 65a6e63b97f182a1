"""Ranks and running sums over ordered rows without gathering them in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from corpuspark.session import cut


def _ranged(df: DataFrame, order: list) -> DataFrame:
    """Rows in range partitions with the partition's number; written out, so that every later use sees the same bounds."""
    return cut(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))


def ranked(df: DataFrame, falling: list[str], rising: list[str]) -> DataFrame:
    """Adds a running rank: rows are numbered within range partitions and offset by the sizes of those before."""
    order = [F.col(x).desc() for x in falling] + [F.col(x).asc() for x in rising]
    parts = _ranged(df, order)
    sizes = parts.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    before = sizes.select("__part", (F.sum("__size").over(Window.orderBy("__part")) - F.col("__size")).alias("__before"))  # a row per partition
    local = parts.withColumn("__at", F.row_number().over(Window.partitionBy("__part").orderBy(*order)))
    return local.join(F.broadcast(before), "__part").withColumn("rank", (F.col("__before") + F.col("__at")).cast("bigint")).drop("__part", "__at", "__before")


def running(values: DataFrame, group: str, value: str, n: str = "n") -> DataFrame:
    """Adds `upto`, the sum of n over the group's values up to this one, and `all`, the group's sum; a group may be of any size."""
    parts = _ranged(values, [F.col(group), F.col(value)])
    sizes = parts.groupBy(group, "__part").agg(F.sum(n).alias("__size"))
    by_group = Window.partitionBy(group)
    sizes = sizes.select(group, "__part", (F.sum("__size").over(by_group.orderBy("__part")) - F.col("__size")).alias("__before"), F.sum("__size").over(by_group).alias("all"))
    local = parts.withColumn("__at", F.sum(n).over(Window.partitionBy("__part", group).orderBy(value)))
    return local.join(sizes, [group, "__part"]).withColumn("upto", F.col("__before") + F.col("__at")).drop("__part", "__at", "__before")


def steps(values: DataFrame, value: str, sums: list[str]) -> DataFrame:
    """Adds upto_<c> for each column of sums, running over all rows by value, and next, the following value; rows have different values."""
    parts = _ranged(values, [F.col(value)])
    heads = parts.groupBy("__part").agg(F.min(value).alias("__head"), *[F.sum(c).alias(f"__of_{c}") for c in sums])
    over = Window.orderBy("__part")  # a row per partition
    heads = heads.select("__part", F.lead("__head").over(over).alias("__after"), *[(F.sum(f"__of_{c}").over(over) - F.col(f"__of_{c}")).alias(f"__before_{c}") for c in sums])
    local = Window.partitionBy("__part").orderBy(value)
    rows = parts.withColumns({f"__at_{c}": F.sum(c).over(local) for c in sums} | {"next": F.lead(value).over(local)}).join(F.broadcast(heads), "__part")
    rows = rows.withColumns({f"upto_{c}": F.col(f"__before_{c}") + F.col(f"__at_{c}") for c in sums} | {"next": F.coalesce("next", "__after")})
    return rows.select(*values.columns, *[f"upto_{c}" for c in sums], "next")
