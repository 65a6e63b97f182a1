"""Corpus-based spelling correction: rare words against frequent ones one edit away."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _deletions(word: Column) -> Column:
    """The word and the word without each of its letters, distinct."""
    cut = F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))))
    return F.array_distinct(F.concat(F.array(word), cut))


def corrections(counts: DataFrame, least: int = 3, rare: int = 1) -> DataFrame:
    """(word, correction, n): for each word seen at most `rare` times the most frequent word one edit away seen at least `least` times, ties by word.

    counts: (word, n). Two words one edit apart share a form with at most one letter deleted, so only those meet.
    """
    odd = counts.where((F.col("n") <= rare) & (F.length("word") >= 3)).select("word", F.explode(_deletions(F.col("word"))).alias("form"))
    good = counts.where((F.col("n") >= least) & (F.length("word") >= 3)).select(F.col("word").alias("correction"), "n", F.explode(_deletions(F.col("word"))).alias("form"))
    pairs = odd.join(good, "form").where((F.col("word") != F.col("correction")) & (F.levenshtein("word", "correction") <= 1)).select("word", "correction", "n").distinct()
    best = pairs.groupBy("word").agg(F.min_by(F.struct("correction", "n"), F.struct(-F.col("n"), F.col("correction"))).alias("x"))
    return best.select("word", "x.correction", "x.n")


# What scanning takes for what; each way is tried, one place a candidate.
CONFUSED = (("ճ", "հ"), ("ն", "բ"), (",", "չ"), ("Պ", "հ"))


def confusion_candidates(token: Column) -> Column:
    """Different forms of a token with the first place of one confusion undone, either way."""
    def first(old: str, new: str) -> Column:
        at = F.instr(token, old)
        return F.when(at > 0, F.concat(F.substring(token, F.lit(1), at - 1), F.lit(new), F.substring(token, at + 1, F.length(token))))

    every = F.array(*[first(a, b) for pair in CONFUSED for a, b in (pair, pair[::-1])])
    return F.filter(every, lambda x: x.isNotNull())


def confusion_corrections(tokens: DataFrame, known: DataFrame) -> DataFrame:
    """(token, correction): tokens not among the known words (word) of whose candidates exactly one is."""
    odd = tokens.select("token").distinct().where(F.col("token").rlike("[԰-֏]")).join(known.select(F.col("word").alias("token")).distinct(), "token", "left_anti")
    forms = odd.select("token", F.explode(confusion_candidates(F.col("token"))).alias("word")).join(known.select("word").distinct(), "word", "left_semi")
    return forms.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.min("word").alias("correction")).where("n = 1").select("token", "correction")
