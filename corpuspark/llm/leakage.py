"""Evaluation passages that occur in corpus documents, whole or in part.

Latent semantic retrieval: document frequencies of the items' words are counted over the whole corpus; TF-IDF passages
of the items are factorised by randomised SVD, block by block on the executors, each space with full rank, so that no
copy is lost by the projection; every passage of every document is projected into the spaces whose words it has enough
of, and scored by cosine and by how much of the item's passage it covers. Two scans of the corpus serve any number of
items. Documents that score are compared with the item word by word: a stretch of at least half of its words, with
isolated changes and one insertion allowed; how many of the words that answer the item, its rarest ones, stand in the
stretch is reported.
"""

from __future__ import annotations

import difflib
import pickle
import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from corpuspark.llm.words import MEMO_WORDS, lcs, number, summed, words_of
from corpuspark.session import cut

HALF = 12
#: Passages of one latent space, and its rank: of that many passages the space keeps all, so a copy is scored in full.
RANK = 256
#: Least share of an item passage's weight that a document passage covers in the latent space, and least cosine of both.
COVER, COSINE = 0.35, 0.1
#: Rarest words of an item, whose presence answers it.
ANSWERS = 8
STRETCH = 0.5
AGREEING = 0.82
#: Words that may stand between two parts of a stretch: one inserted sentence or line.
INSERTED = 60
#: Items of one block of spaces: what a task holds at a time.
ITEMS_PER_BLOCK = 300
#: Bits of the set of the items' words, 16 MB whatever their number.
SET_BITS = 27
CHUNK_WORDS = 100_000
#: Rows of the term projection gathered at once.
GATHERED = 16_384
_SENTENCE = re.compile(r"(?<=[.։:?!])\s+")


def _first(text: str) -> str:
    return _SENTENCE.split(text.strip(), maxsplit=1)[0]


def without_stock(items: DataFrame) -> DataFrame:
    """(item_id, words) of items without the stock instruction: a first sentence that several different items share."""

    def cut_first(batches):
        for pdf in batches:
            parts = [_SENTENCE.split(x.strip(), maxsplit=1) for x in pdf["text"]]
            yield pd.DataFrame({"item_id": pdf["item_id"], "text": pdf["text"], "first": [p[0] for p in parts], "rest": [p[1] if len(p) > 1 else None for p in parts]})

    rows = items.where("item_id is not null and text is not null").select("item_id", "text").distinct()
    rows = cut(rows.mapInPandas(cut_first, "item_id bigint, text string, first string, rest string"))
    shared = rows.select("text", "first").distinct().groupBy("first").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("first", F.lit(True).alias("stock"))
    rows = rows.join(shared, "first", "left").select("item_id", F.when(F.col("stock") & F.col("rest").isNotNull(), F.col("rest")).otherwise(F.col("text")).alias("text"))

    def words(batches):
        for pdf in batches:
            out = [(i, w) for i, w in zip(pdf["item_id"], map(words_of, pdf["text"])) if w]
            yield pd.DataFrame(out, columns=["item_id", "words"])

    return rows.mapInPandas(words, "item_id bigint, words array<string>").distinct()


def stretch(document: list[str], item: list[str]) -> float:
    """Share of the item's words in the longest stretch of it that the document holds."""
    blocks = [b for b in difflib.SequenceMatcher(None, document, item, autojunk=False).get_matching_blocks() if b.size]
    runs: list[list[int]] = []
    for b in blocks:
        if runs and b.a - runs[-1][1] <= 3 and b.b - runs[-1][3] <= 3:
            runs[-1][1], runs[-1][3], runs[-1][4] = b.a + b.size, b.b + b.size, runs[-1][4] + b.size
        else:
            runs.append([b.a, b.a + b.size, b.b, b.b + b.size, b.size])
    runs = [r for r in runs if r[4] >= 5 or r[4] >= STRETCH * len(item)]
    best = 0
    for i, r in enumerate(runs):
        if r[4] >= AGREEING * max(r[3] - r[2], r[1] - r[0]):
            best = max(best, r[3] - r[2])
        if i + 1 < len(runs):
            q = runs[i + 1]
            if q[0] - r[1] <= INSERTED and q[2] - r[3] <= 3 and r[4] + q[4] >= AGREEING * max(q[3] - r[2], r[1] - r[0] + q[1] - q[0]):
                best = max(best, q[3] - r[2])
    return best / len(item)


def least_threes(n: int) -> int:
    """Three-word sequences that a stretch of half of n words must share: each change or insertion ends a run and costs two."""
    return max(1, int(STRETCH * n * AGREEING - 2 * (STRETCH * n * (1 - AGREEING) + 2)))


def _word_slots(batches):
    from pyspark import TaskContext

    bits, some = np.zeros((1 << SET_BITS) // 8, dtype=np.uint8), False
    for pdf in batches:
        for w in pdf["word"]:
            s = number(w.encode("utf-8", "surrogatepass")) >> (64 - SET_BITS)
            bits[s >> 3] |= 1 << (s & 7)
            some = True
    if some:
        yield summed.slices(bits, TaskContext.get().partitionId())


def _count(model):
    """(word, n): in how many documents of the task each word of the set occurs; null stands for all documents."""

    def run(batches):
        bits, n, wanted = model.value, 0, {}
        counts: Counter = Counter()
        for pdf in batches:
            n += len(pdf)
            if len(wanted) > MEMO_WORDS:
                wanted.clear()
            for text in pdf["text"]:
                for w in set(words_of(text)):
                    ok = wanted.get(w)
                    if ok is None:
                        s = number(w.encode("utf-8", "surrogatepass")) >> (64 - SET_BITS)
                        ok = wanted[w] = bool(bits[s >> 3] >> (s & 7) & 1)
                    if ok:
                        counts[w] += 1
        if n:
            yield pd.DataFrame([*counts.items(), (None, n)], columns=["word", "n"])

    return run


def latent_space(passages: list[list[int]], idf: np.ndarray, rank: int = RANK, seed: int = 7):
    """(term projection, latent passages, squared norms): a randomised SVD with one power iteration of the TF-IDF rows."""
    a = np.zeros((len(passages), len(idf)))
    for i, p in enumerate(passages):
        np.add.at(a[i], p, 1.0)
    a *= idf
    wide = min(len(a), len(idf), rank + 16)
    y = a @ np.random.default_rng(seed).standard_normal((a.shape[1], wide))
    q, _ = np.linalg.qr(a @ (a.T @ y))
    _, _, v = np.linalg.svd(q.T @ a, full_matrices=False)
    v = v[:rank].T
    return (idf[:, None] * v).astype(np.float32), (a @ v).astype(np.float32), (a**2).sum(axis=1)


def _chunks(batches):
    """(ids, words of each document) in pieces of some CHUNK_WORDS words."""
    ids, docs, n = [], [], 0
    for pdf in batches:
        for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
            ids.append(doc_id)
            docs.append(words_of(text))
            n += len(docs[-1])
            if n >= CHUNK_WORDS:
                yield ids, docs
                ids, docs, n = [], [], 0
    if ids:
        yield ids, docs


def _hits(docs, base, vocabulary, energy, term, queries, lengths, item_of, least):
    """(document, item, start) for each passage of a document that covers enough of an item's passage of this space."""
    index, half = [], []
    for d, words in enumerate(docs):
        for i, w in enumerate(words):
            if (x := vocabulary.get(w)) is not None:
                index.append(x)
                half.append(base[d] + i // HALF)
    if not index:
        return
    index, half = np.array(index), np.array(half)
    weight = np.bincount(half, weights=energy[index], minlength=base[-1])
    inside = np.ones(base[-1], dtype=bool)
    inside[base[1:] - 1] = False
    starts = np.flatnonzero(inside)
    starts = starts[weight[starts] + weight[starts + 1] >= least]
    if not len(starts):
        return
    need = np.zeros(base[-1], dtype=bool)
    need[starts] = need[starts + 1] = True
    place = np.cumsum(need) - 1
    ok = need[half]
    index, half = index[ok], place[half[ok]]
    latent = np.zeros((need.sum(), term.shape[1]), dtype=np.float32)
    for at in range(0, len(index), GATHERED):
        h = half[at : at + GATHERED]
        heads = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        latent[h[heads]] += np.add.reduceat(term[index[at : at + GATHERED]], heads, axis=0)
    owner = np.searchsorted(base, starts, side="right") - 1
    for at in range(0, len(starts), 4096):
        s = place[starts[at : at + 4096]]
        both = latent[s] + latent[s + 1]
        score = both @ queries  # dot product over the query's squared norm
        cosine = score * (lengths[None, :] / np.maximum(np.linalg.norm(both, axis=1), 1e-9)[:, None])
        for x, q in zip(*np.nonzero((score >= COVER) & (cosine >= COSINE))):
            yield int(owner[at + x]), int(item_of[q]), int(starts[at + x])


def _spaces(block: list[tuple[int, list[str]]], idf: dict[str, float]) -> list[tuple]:
    """Latent spaces of at most RANK passages each; a space has the vocabulary of its passages only."""
    parts = [(i, words[s : s + 2 * HALF - 8]) for i, (_, words) in enumerate(block) for s in range(0, max(1, len(words) - HALF), 8)]
    count, out = -(-len(parts) // RANK), []
    for k in range(count):
        own = parts[len(parts) * k // count : len(parts) * (k + 1) // count]
        vocabulary: dict[str, int] = {}
        for _, p in own:
            for w in p:
                vocabulary.setdefault(w, len(vocabulary))
        weights = np.array([idf[w] for w in vocabulary])
        term, latent, norms = latent_space([[vocabulary[w] for w in p] for _, p in own], weights)
        queries = (latent / norms[:, None]).T.astype(np.float32).copy()
        out.append((vocabulary, weights**2, term, queries, np.sqrt(norms).astype(np.float32), np.array([i for i, _ in own]), COVER * norms.min()))
    return out


def _fit(n: int):
    """The spaces of a block of items, fitted where the block is, as one binary."""

    def run(pdf):
        idf = {w: float(np.log((n + 1) / (c + 1)) + 0.05) for ws, cs in zip(pdf["words"], pdf["counts"]) for w, c in zip(ws, cs)}
        block = sorted((int(i), list(w)) for i, w in zip(pdf["item_id"], pdf["words"]))
        answers = [sorted(set(w), key=lambda x: (-idf[x], x))[:ANSWERS] for _, w in block]
        return pd.DataFrame({"block": [pdf["block"].iat[0]], "model": [pickle.dumps((_spaces(block, idf), block, answers))]})

    return run


#: Blocks of items that a worker keeps at hand; with more its memory doesn't grow, it loads them anew for each piece of the corpus.
BLOCKS_KEPT = 8


def _search(models: list):
    """(doc_id, item_id, part, answered): documents that hold enough of an item, block of items by block."""

    def run(batches):
        kept: dict[int, tuple] = {}
        for ids, docs in _chunks(batches):
            halves = np.array([max(2, -(-len(d) // HALF)) for d in docs], dtype=np.int64)
            base = np.concatenate(([0], np.cumsum(halves)))
            out = []
            for k, sent in enumerate(models):
                if k not in kept:
                    if len(kept) >= BLOCKS_KEPT:
                        kept.clear()
                    kept[k] = pickle.loads(sent.value)
                spaces, items, answers = kept[k]
                hits: dict[tuple[int, int], list[int]] = {}
                for space in spaces:
                    for d, i, start in _hits(docs, base, *space):
                        hits.setdefault((d, i), []).append(start)
                for (d, i), found in hits.items():
                    item_id, words = items[i]
                    around = len(words) + INSERTED
                    first, last = (min(found) - base[d]) * HALF, (max(found) - base[d] + 2) * HALF
                    near = docs[d][max(0, first - around) : last + around]
                    if len(set(zip(words, words[1:], words[2:])).intersection(zip(near, near[1:], near[2:]))) < least_threes(len(words)):
                        continue
                    if lcs(words, near) >= STRETCH * AGREEING * len(words) and (part := stretch(near, words)) >= STRETCH:
                        out.append((ids[d], item_id, part, sum(w in near for w in answers[i]) / max(1, len(answers[i]))))
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "part", "answered"])

    return run


def leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, part, answered): documents that hold an item or a stretch of at least half of its words.

    part is that stretch's share of the item, answered the share of the item's rarest words that stand with it.
    documents: doc_id, text; items: item_id, text. Null ids and texts give no rows, repeated rows count once, an item
    without words is in no document.
    """
    spark = documents.sparkSession
    texts = documents.where("doc_id is not null and text is not null").select("doc_id", "text")
    listed = cut(without_stock(items))
    blocks = max(1, -(-listed.count() // ITEMS_PER_BLOCK))
    each = listed.select("item_id", "words", F.posexplode("words").alias("at", "word"))
    bits = spark.sparkContext.broadcast(summed(each.select("word").distinct().mapInPandas(_word_slots, summed.KIND), (1 << SET_BITS) // 8, np.uint8, np.bitwise_or))
    counted = cut(texts.mapInPandas(_count(bits), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")))
    found = counted.where("word is null").first()
    n = found["n"] if found else 0
    known = each.join(counted.where("word is not null"), "word", "left").groupBy("item_id", "words").agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce("n", F.lit(0)).alias("n")))).alias("c"))
    known = known.select("item_id", "words", F.transform("c", lambda x: x["n"]).alias("counts"), F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int").alias("block"))
    fitted = cut(known.groupBy("block").applyInPandas(_fit(n), "block int, model binary"))
    models = [spark.sparkContext.broadcast(bytes(r["model"])) for r in fitted.orderBy("block").toLocalIterator()]  # one at a time on the driver
    kind = "doc_id bigint, item_id bigint, part double, answered double"
    out = texts.mapInPandas(_search(models), kind) if models else spark.createDataFrame([], kind)
    return out.groupBy("doc_id", "item_id").agg(F.max("part").alias("part"), F.max("answered").alias("answered"))
