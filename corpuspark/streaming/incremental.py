"""Word counts kept up by a stream of documents, and windowed counts of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpuspark.operators.frequency import delta, word_counts


#: Batches after which what they added is folded into a new base.
FOLD_AFTER = 20


def start_counts(documents: DataFrame, state_dir: str, checkpoint: str, by: list[str] | None = None, fold_after: int = FOLD_AFTER):
    """Keeps (by..., word, n) under `state_dir` as documents arrive.

    Each batch writes what it adds to a part of its own, so its cost is that of the batch; after some batches the parts are
    folded into a base. A batch replayed after a failure rewrites its own part, and a base is written aside and only read
    once it is whole. `counts_now` reads the state.
    """
    by = by or ["source"]
    keys = [*by, "word"]

    def apply(batch: DataFrame, number: int):
        word_counts(batch, by).write.mode("overwrite").parquet(f"{state_dir}/part={number:09d}")
        if (number + 1) % fold_after == 0:
            _sum(batch.sparkSession, state_dir, number, keys, fold_after).write.mode("overwrite").parquet(f"{state_dir}/base={number:09d}")

    return documents.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _sum(spark: SparkSession, state_dir: str, last: int, keys: list[str], fold_after: int) -> DataFrame:
    base = last // fold_after * fold_after - 1  # the last base before this batch
    paths = [f"{state_dir}/part={n:09d}" for n in range(base + 1, last + 1)] + ([f"{state_dir}/base={base:09d}"] if base >= 0 else [])
    return spark.read.parquet(*paths).groupBy(*keys).agg(F.sum("n").alias("n"))


def counts_now(spark: SparkSession, state_dir: str, last: int, by: list[str] | None = None, fold_after: int = FOLD_AFTER) -> DataFrame:
    """(by..., word, n) after batch number `last`: the last base and the parts since."""
    return _sum(spark, state_dir, last, [*(by or ["source"]), "word"], fold_after)


def changed_documents(old_state: DataFrame, documents: DataFrame, by: list[str]) -> DataFrame:
    """Signed changes of (by..., doc_id, word) counts between a stored state and the documents now, removed ones included."""
    keys = [*by, "doc_id", "word"]
    return delta(old_state, word_counts(documents, [*by, "doc_id"]), keys)


def windowed_events(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums by tumbling window and type; events later than `late` are left out when streaming."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("events"), F.round(F.sum("value"), 4).alias("total")).select(
        F.col("window.start").alias("start"), "event_type", "events", "total"
    )


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Sessions of a user: runs of events with less than `gap` between them."""
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count(F.lit(1)).alias("events")).select(
        "user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "events"
    )
