"""Validation, enrichment and upkeep of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpuspark.session import broadcast_if_small

# What a field may say.
KNOWN = {
    "source_language_code": ("hyw", "hye", "hy", "xcl", "en"),
    "internal_language_code": ("hy", "eng"),
    "internal_language_branch": ("hye-w", "hye-e", "eng"),
    "dialect_label": ("likely_western", "likely_eastern", "likely_classical", "inconclusive"),
    "dialect": ("western_armenian", "eastern_armenian", "classical_armenian", "mixed", "unknown"),
    "source_type": ("encyclopedia", "literature", "newspaper", "news_agency", "blog", "social_media", "archive", "library", "academic", "historical_collection", "website"),
    "content_type": ("article", "literature", "academic", "transcription", "legal", "poem", "prose", "historical", "religious", "mixed"),
    "writing_category": ("book", "manuscript", "scientific_paper", "liturgical", "fiction", "non_fiction", "history", "politics", "news", "academic", "literature", "article", "unknown"),
}
NEEDED, SHARES = ("text", "source_family"), ("wa_score", "confidence_region")


def warnings(df: DataFrame) -> Column:
    """Array of what speaks against a record; checks of columns the table doesn't have are left out."""
    checks = [F.when(F.coalesce(F.trim(c), F.lit("")) == "", F.lit(f"empty {c}")) for c in NEEDED if c in df.columns]
    checks += [F.when((F.col(c) != "") & ~F.col(c).isin(*known), F.concat(F.lit(f"unknown {c}: "), F.col(c))) for c, known in KNOWN.items() if c in df.columns]
    checks += [F.when(~F.col(c).between(0.0, 1.0), F.lit(f"{c} out of range")) for c in SHARES if c in df.columns]
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def status(df: DataFrame, flags: list[str]) -> DataFrame:
    """(flag, yes, no, pct): how many rows have a flag set; a missing flag counts as not set."""
    n = F.count(F.lit(1))
    one = df.agg(*[F.count_if(F.coalesce(F.col(f), F.lit(False))).alias(f) for f in flags], n.alias("__n"))
    cells = F.array(*[F.struct(F.lit(f).alias("flag"), F.col(f).alias("yes"), (F.col("__n") - F.col(f)).alias("no"), F.round(100.0 * F.col(f) / F.greatest("__n", F.lit(1)), 2).alias("pct")) for f in flags])
    return one.select(F.explode(cells).alias("x")).select("x.*")


def enriched(df: DataFrame, dimension: DataFrame, source: str, fields: list[str], most: int = 200_000) -> DataFrame:
    """Fills nulls of fields from a dimension (key, fields...): by the source itself, else by its kind before the colon."""
    small = broadcast_if_small(dimension, most)
    own = small.select(F.col("key").alias("__k"), *[F.col(f).alias(f"__own_{f}") for f in fields])
    kind = small.select(F.col("key").alias("__k"), *[F.col(f).alias(f"__kind_{f}") for f in fields])
    rows = df.join(own, F.col(source) == F.col("__k"), "left").drop("__k").join(kind, F.substring_index(source, ":", 1) == F.col("__k"), "left").drop("__k")
    return rows.select(*[F.coalesce(F.col(c), F.col(f"__own_{c}"), F.col(f"__kind_{c}")).alias(c) if c in fields else F.col(c) for c in df.columns])


def signature(filters: dict) -> str:
    """One string for a filter, whatever the order of its keys; a change of it calls for a full rebuild."""
    import json

    return json.dumps(filters, sort_keys=True, ensure_ascii=False, default=str)


def must_rebuild(known: str | None, filters: dict, state_rows: int) -> bool:
    return not state_rows or known != signature(filters)


def review_id(*parts: Column) -> Column:
    """The parts that say something joined by colons, with other characters than letters, digits and ._:- as dashes."""
    said = F.concat_ws(":", *[F.when(F.trim(p) != "", F.trim(p)) for p in parts])
    return F.regexp_replace(said, r"[^\p{L}\p{N}._:-]+", "-")


def pending(tasks: DataFrame, done: DataFrame, key: str = "task_uid") -> DataFrame:
    """Tasks not done yet; tasks without a key are left out."""
    return tasks.where(F.col(key).isNotNull()).join(done.select(key).distinct(), key, "left_anti")
