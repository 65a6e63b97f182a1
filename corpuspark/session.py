"""Session helpers shared by all operators."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


#: Bytes of an Arrow batch that Python works on: words as objects take some ten times that.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "16m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables of a scale directory. Batches for Python are bounded by bytes unless the session sets its own bound."""
    if spark.conf.get(BATCH_BYTES[0], None) in (None, "67108864b"):  # not set by the session
        spark.conf.set(*BATCH_BYTES)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that spark.checkpoint.dir names.

    Where it is unset a temporary folder serves a session that runs on this machine alone; on a cluster that is an error,
    since executors can't read each other's disks. Files go when nothing refers to them any more.
    """
    context = spark.sparkContext
    known = context._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not named and not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context._jsc.sc().conf().set("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    context.setCheckpointDir(named or tempfile.mkdtemp(prefix="corpuspark-"))
    return context._jsc.sc().getCheckpointDir().get()


def spread(df: DataFrame) -> DataFrame:
    """A table read in few pieces spread over all cores before costly work; one of as many pieces as half the cores stays as it is.

    For reads of files only: it looks at their planned pieces and runs nothing.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    pieces = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df.repartition(cores) if 0 < 2 * pieces <= cores else df


def cut(df: DataFrame) -> DataFrame:
    """The same rows with a short lineage, written to reliable storage so that a lost executor costs nothing."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """Hints a broadcast when a counted table has at most `rows` rows; a shuffled join serves beyond that.

    The count stops at rows + 1; give it a table that reads a written stage, so that counting runs no long lineage twice.
    """
    from pyspark.sql import functions as F

    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
