"""Lines that one source repeats across its documents.

Every line becomes a node (source, letters of the line) weighted by the number of different documents that hold
it; consecutive repeated lines become weighted edges. Nodes and edges of high support stay, connected components
of what is left are the boilerplate blocks of the source, and every occurrence of a block's line is removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from corpuspark.session import broadcast_if_small, cut

MIN_DOCUMENTS = 5
#: Lines of blocks are joined by broadcast up to this many distinct lines (24 bytes each), by a shuffle beyond.
BROADCAST_LINES = 1_000_000


def letters(line: Column) -> Column:
    """The line's letters in one case; the ligature ech-yiwn counts as its two letters, as its capital form does."""
    return F.regexp_replace(F.replace(F.lower(line), F.lit("և"), F.lit("եւ")), r"[^\p{L}]+", "")


def lines_of(df: DataFrame, key: str, source: str, text: str) -> DataFrame:
    """(key, source, line_no, h1, h2): the lines with at least one letter, numbered from 1; 128 bits stand for the letters."""
    rows = df.where(F.col(text).isNotNull() & F.col(source).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).alias("key"), F.col(source).alias("source"), F.posexplode(F.split(F.col(text), "\n")).alias("pos", "line")
    )
    rows = rows.select("key", "source", (F.col("pos") + 1).cast("int").alias("line_no"), letters(F.col("line")).alias("letters"))
    rows = rows.where("letters <> ''")
    return rows.select("key", "source", "line_no", F.xxhash64("letters").alias("h1"), F.xxhash64(F.lit(1), "letters").alias("h2"))


def components(nodes: DataFrame, edges: DataFrame, rounds: int = 200) -> DataFrame:
    """(node, block): connected components by least labels, with each label jumping to its own label's label.

    nodes: (node), edges: (a, b). Runs until nothing changes; labels jump, so `rounds` are never needed, and running out of them is an error.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both, labels = cut(both), cut(nodes.select("node", F.col("node").alias("block")))
    for _ in range(rounds):
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("block").alias("near"))
        step = labels.join(near, labels.node == near.a, "left").select("node", "block", F.least("block", F.coalesce("near", "block")).alias("to"))
        up = labels.select(F.col("node").alias("up"), F.col("block").alias("up_block"))
        step = step.join(up, F.col("to") == F.col("up"), "left").select("node", "block", F.least("to", F.coalesce("up_block", "to")).alias("to"))
        step = cut(step)
        labels = step.select("node", F.col("to").alias("block"))
        if step.where("block <> to").isEmpty():
            return labels
    raise RuntimeError(f"labels still change after {rounds} rounds")


def boilerplate(df: DataFrame, key: str = "article_id", source: str = "source_name", text: str = "content", min_documents: int = MIN_DOCUMENTS):
    """(found, blocks) of a table of documents.

    found: (key, line_no, source, block), one row per occurrence of a block's line.
    blocks: (source, block, lines, documents, edges).
    Nulls in key, source or text give no rows; a row delivered twice counts once; an empty table gives empty results.
    """
    lines = cut(lines_of(df, key, source, text))  # split and hashed once, read twice
    nodes = lines.groupBy("source", "h1", "h2").agg(F.countDistinct("key").alias("documents")).where(F.col("documents") >= min_documents)
    nodes = cut(nodes.withColumn("node", F.xxhash64("source", "h1", "h2")))
    small = broadcast_if_small(nodes.select("source", "h1", "h2", "node"), BROADCAST_LINES)
    hits = lines.join(small, ["source", "h1", "h2"]).select("key", "line_no", "source", "node").distinct()
    hits = cut(hits)
    order = Window.partitionBy("key", "source").orderBy("line_no")
    # consecutive: the next line, or the next but an empty one
    pairs = hits.withColumns({"next": F.lead("node").over(order), "next_no": F.lead("line_no").over(order)}).where("next_no - line_no <= 2 and next <> node")
    edges = pairs.groupBy(F.col("node").alias("a"), F.col("next").alias("b")).agg(F.countDistinct("key").alias("weight"))
    edges = cut(edges.where(F.col("weight") >= min_documents))
    labels = components(nodes.select("node").distinct(), edges)
    found = hits.join(broadcast_if_small(labels, BROADCAST_LINES), "node").select("key", "line_no", "source", "block")
    inside = edges.join(labels, edges.a == labels.node).groupBy("block").agg(F.count(F.lit(1)).alias("edges"))
    blocks = nodes.join(labels, "node").groupBy("source", "block").agg(F.count(F.lit(1)).alias("lines"), F.max("documents").alias("documents"))
    blocks = blocks.join(inside, "block", "left").select("source", "block", "lines", "documents", F.coalesce("edges", F.lit(0)).alias("edges"))
    return found, blocks


def without_lines(df: DataFrame, found: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text, removed): each document once without the lines found in it; runs of empty lines left behind shrink to one.

    A null text stays null. Where a key has several texts, each text loses the lines at the found numbers.
    """
    gone = found.groupBy("key").agg(F.sort_array(F.collect_set("line_no")).alias("gone"))
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text")).distinct().join(gone, "key", "left")
    kept = F.filter(F.split("text", "\n"), lambda x, i: F.col("gone").isNull() | ~F.array_contains("gone", i + 1))
    tidy = F.trim(F.regexp_replace(F.array_join(kept, "\n"), r"\n[ \t]*(\n[ \t]*)+\n", "\n\n"))
    return rows.select("key", F.regexp_replace(tidy, r"^\n+|\n+$", "").alias("text"), F.coalesce(F.size("gone"), F.lit(0)).alias("removed"))
