"""Documents of several sources combined to target shares of tokens.

Each source is repeated as often as its share asks for, within its cap: whole passes over it, and for the fraction a
balanced sample by the cube method. Inclusion probabilities move through the null space of two constraints, the
source's token and document totals, in blocks side by side, until less than three documents of a block are undecided;
these move on together, and only the last two of a source are rounded in the landing.
"""

from __future__ import annotations

import base64
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from corpuspark.session import cut

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: The published split pattern of the byte-level vocabularies.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLOCK_DOCUMENTS = 20_000
MEMO_PIECES = 500_000
#: Targeted sources are few and listed by hand; more than this is an error, not a mix.
MOST_SOURCES = 100_000


class Tokens:
    """Counts the tokens of texts; the count of each piece of the split pattern is remembered, so it is exact."""

    def __init__(self, vocabulary: bytes):
        import regex
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        self.encoding = tiktoken.Encoding("mix", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pieces, self.known = regex.compile(PATTERN).findall, {}

    def count(self, text: str) -> int:
        total, known = 0, self.known
        for piece in self.pieces(text):
            n = known.get(piece)
            if n is None:
                if len(known) > MEMO_PIECES:
                    known.clear()
                n = known[piece] = len(self.encoding.encode_ordinary(piece))
            total += n
        return total


def vocabulary_of(path: str) -> bytes:
    """A tokenizer's file, read where the query is planned; tasks get its bytes, so no other machine needs the file."""
    with open(path, "rb") as f:
        return f.read()


def _token_counts(vocabulary):
    def run(batches):
        tokens = None
        for pdf in batches:
            tokens = tokens or Tokens(vocabulary.value)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "source": pdf["source"], "tokens": [tokens.count(x) for x in pdf["text"]]})

    return run


def token_counts(documents: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """(doc_id, source, tokens) of every document with text; a document delivered twice counts once."""
    rows = documents.where("doc_id is not null and source is not null and text is not null").select("doc_id", "source", "text")
    return rows.mapInPandas(_token_counts(documents.sparkSession.sparkContext.broadcast(vocabulary_of(path))), "doc_id bigint, source string, tokens bigint").dropDuplicates(["doc_id"])


def flight(p: np.ndarray, tokens: np.ndarray, seed: int) -> np.ndarray:
    """Inclusion probabilities moved until at most two are undecided; the sums of p and of p * tokens stay."""
    random = np.random.default_rng(seed)
    p = p.astype(float).copy()
    order = random.permutation(np.flatnonzero((p > 1e-9) & (p < 1 - 1e-9)))
    queue, active = iter(order), []
    while True:
        while len(active) < 3 and (i := next(queue, None)) is not None:
            active.append(i)
        if len(active) < 2 or len(active) == 2 and tokens[active[0]] != tokens[active[1]]:
            return p
        t = [float(tokens[i]) for i in active]
        if len(active) == 2:
            u = [1.0, -1.0]
        else:
            u = [t[1] - t[2], t[2] - t[0], t[0] - t[1]]
            if not any(u):
                u = [1.0, -1.0, 0.0]
        up = min((1 - p[i]) / x if x > 0 else -p[i] / x for i, x in zip(active, u) if x)
        down = min(p[i] / x if x > 0 else (p[i] - 1) / x for i, x in zip(active, u) if x)
        step = up if random.random() * (up + down) < down else -down
        for i, x in zip(active, u):
            p[i] = min(1.0, max(0.0, p[i] + step * x))
        active = [i for i in active if 1e-9 < p[i] < 1 - 1e-9]


def landing(p: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """The last undecided documents rounded so that tokens, then documents, stay nearest to their totals."""
    rest = np.flatnonzero((p > 1e-9) & (p < 1 - 1e-9))
    want, many = (p[rest] * tokens[rest]).sum(), p[rest].sum()
    best = min(range(1 << len(rest)), key=lambda m: (abs(sum(int(tokens[i]) for k, i in enumerate(rest) if m >> k & 1) - want), abs(m.bit_count() - many)))
    out = np.round(p)
    out[rest] = [best >> k & 1 for k in range(len(rest))]
    return out


def _cube(last: bool, seed: int):
    def run(key, pdf):
        pdf = pdf.sort_values("doc_id", ignore_index=True)
        tokens = pdf["tokens"].to_numpy()
        p = flight(pdf["p"].to_numpy(), tokens, zlib.crc32(f"{seed}|{key[0]}|{key[1]}|{len(pdf)}".encode()))
        return pdf.assign(p=landing(p, tokens) if last else p)

    return run


def plan(tokens: DataFrame, targets: DataFrame, total: int | None = None) -> DataFrame:
    """(source, target_share, max_repeats, documents, tokens, passes, rest): how often each targeted source is repeated.

    total is the size of the mix in tokens, by default that of the targeted sources. A source that can't reach its share
    within max_repeats is repeated that often; a target without documents stays at nothing.
    """
    have = tokens.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum("tokens").alias("tokens"))
    wanted = targets.where("source is not null and target_share is not null").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    rows = wanted.join(have, "source", "left").fillna(0, ["documents", "tokens"])
    size = F.lit(float(total)) if total is not None else F.sum("tokens").over(_everything())
    asked = F.when(F.col("tokens") > 0, F.least(F.col("target_share") / F.sum("target_share").over(_everything()) * size / F.col("tokens"), F.coalesce("max_repeats", F.lit(1)).cast("double"))).otherwise(0.0)
    return rows.withColumn("asked", asked).select("source", "target_share", "max_repeats", "documents", "tokens", F.floor("asked").cast("int").alias("passes"), (F.col("asked") - F.floor("asked")).alias("rest"))


def _everything():
    from pyspark.sql.window import Window

    return Window.partitionBy(F.lit(0))  # over the few targeted sources only


def mix(documents: DataFrame, targets: DataFrame, total: int | None = None, path: str = TOKENIZER, seed: int = 11):
    """(chosen, shares): the documents of the mix with their repeats, and what share each source got.

    chosen: doc_id, source, tokens, repeats. shares: source, target_share, share, tokens, documents, repeats.
    Documents of untargeted or null sources and null texts are left out; empty texts weigh nothing; an empty table gives
    an empty mix whose shares are null.
    """
    counted = cut(token_counts(documents, path))
    planned = cut(plan(counted, targets, total))
    few = planned.limit(MOST_SOURCES + 1).count()
    if few > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} targeted sources")
    rows = counted.join(F.broadcast(planned.select("source", "passes", "rest", "documents")), "source")
    whole = rows.where("passes > 0 or rest > 0").select("doc_id", "source", "tokens", "passes")
    most = planned.agg(F.max("documents")).first()[0] or 0
    blocks = max(1, -(-most // BLOCK_DOCUMENTS))
    left = rows.where("rest > 0").select("doc_id", "source", "tokens", F.col("rest").alias("p"))
    decided, level = [], 0
    while True:
        share = F.pmod(F.xxhash64("doc_id", F.lit(level)), F.lit(blocks)).cast("int")
        done = left.withColumn("block", share).groupBy("source", "block").applyInPandas(_cube(blocks == 1, seed), "doc_id bigint, source string, tokens bigint, p double, block int").drop("block")
        done = cut(done)
        decided.append(done.where("p >= 1 - 1e-9").select("doc_id", F.lit(1).alias("extra")))
        if blocks == 1:
            break
        left, level = done.where("p > 1e-9 and p < 1 - 1e-9"), level + 1
        blocks = max(1, -(-2 * blocks // BLOCK_DOCUMENTS))
    extra = decided[0]
    for more in decided[1:]:
        extra = extra.unionByName(more)
    chosen = whole.join(extra, "doc_id", "left").withColumn("repeats", F.col("passes") + F.coalesce("extra", F.lit(0)))
    chosen = chosen.where("repeats > 0").select("doc_id", "source", "tokens", "repeats")
    got = chosen.groupBy("source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("tokens"), F.count(F.lit(1)).alias("documents"), F.max("repeats").alias("repeats"))
    shares = planned.select("source", "target_share").join(got, "source", "left").fillna(0, ["tokens", "documents", "repeats"])
    shares = shares.withColumn("share", F.col("tokens") / F.nullif(F.sum("tokens").over(_everything()), F.lit(0)))
    return chosen, shares.select("source", "target_share", "share", "tokens", "documents", "repeats")
