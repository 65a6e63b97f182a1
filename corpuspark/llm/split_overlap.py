"""Records of evaluation splits that occur again, the same or nearly so, in the training split.

A weighted cosine join between the splits. A text is the vector of its runs of two adjacent words, or of three where the
two are common, each occurrence by its number, weighted by rarity; how often a run occurs is counted over all records in
a sketch of fixed size, so that both texts cut their runs alike. If four fifths of the longer text's words agree in place,
whatever stands in the others, the texts share at least 0.4 n - 2 of their n words' runs; where runs of two are rare the
same holds for words put in and left out anywhere, and for three tenths of the words changed or slipped in place. So a
text indexes its runs of greatest weight until the squared norm of the rest falls under the least dot product of a
partner, and some further, so that partners share a known number of indexed runs. Texts of four words and less, all of
whose words must agree, are indexed by their words without one letter (two in long words), so that slips meet.

Inverted lists are built by blocks of terms; training terms no evaluation text indexes are dropped by a bit set of fixed
size before they are shuffled, and the lists of hot terms are split into a grid of blocks. Within a list only texts of
fitting length and position meet, and a parity bitmap of the words rules out those that differ in too many. Exact dot
products over all terms, and then the word-by-word agreement, decide. Exact copies are one class throughout.
"""

from __future__ import annotations

import hashlib
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from corpuspark.llm.words import Numbers, agreement, number, shortened, sketch_of, summed, words_of
from corpuspark.session import broadcast_if_small, cut

AGREEMENT = 0.8
#: Texts of at most this many words agree in all of them or not at all.
SHORT = 4
#: Texts up to LONG words are cut into runs of two, from MIDDLE on into runs of three where two are common.
MIDDLE, LONG = 12, 15
#: Records that hold a run of two words from which on it is common.
COMMON = 60
#: Share of the longer text's words in which two texts may differ as they stand, slips included, on either side.
DIFFERING = 0.45
#: Least share of the terms that any partner shares, used against the exact dot product.
LEAST_SHARED = 0.1
RAREST = 1000.0
SKETCH_BITS = 20
#: Bits of the set of evaluation terms, 16 MB at any size of the data; a fuller set only filters less.
SET_BITS = 27
TERMS_PER_BLOCK = 400_000
#: Records that hold a term from which on its lists are split.
HOT = 100_000
#: Pairs made at once within a block.
PAIRS_AT_ONCE = 1_000_000
BROADCAST_ROWS = 400_000
#: Words of a parity bitmap, 64 bits each.
LANES = 4
_ONE, _TWO, _OWN = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
_POSTING = np.dtype([("term", "u8"), ("name", "i8"), ("n", "i4"), ("at", "i4"), ("bits", "u8", (LANES,))])


def project_hash(text: str) -> int:
    """First 64 bits of the SHA-256 of the NFKC text with white space collapsed and trimmed."""
    if not unicodedata.is_normalized("NFKC", text):
        text = unicodedata.normalize("NFKC", text)
    return int.from_bytes(hashlib.sha256(" ".join(text.split()).encode("utf-8", "surrogatepass")).digest()[:8], "big", signed=True)


def class_of(words: list[str], text: str) -> int:
    """One number for all texts of the same words; a text without words is alone with its exact copies."""
    return number((" ".join(words) or "\n" + text).encode("utf-8", "surrogatepass")) - (1 << 63)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _runs(docs: list[list[int]]):
    """(row, position, run of two, run of three or 0 at the end) of documents given as numbers of their words."""
    lengths = np.array([len(x) for x in docs], dtype=np.int64)
    flat = np.array([y for x in docs for y in x], dtype=np.uint64)
    row = np.repeat(np.arange(len(docs)), lengths)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    two = _mixed(flat[:-1] * _ONE + flat[1:] * _TWO)
    three = np.zeros(len(two), dtype=np.uint64)
    if len(flat) > 2:
        three[:-1] = np.where(row[:-2] == row[2:], _mixed(two[:-1] * _ONE + flat[2:] * _OWN), np.uint64(0))
    within = row[:-1] == row[1:]
    return row[:-1][within], at[:-1][within].astype(np.int32), two[within], three[within]


def _numbered(row: np.ndarray, at: np.ndarray, run: np.ndarray):
    """(row, term, position): each occurrence of a run in a document is a term; the position is -1 where a run occurs again."""
    order = np.lexsort((at, run, row))
    row, run, at = row[order], run[order], at[order]
    head = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (run[1:] != run[:-1])))) if len(row) else np.zeros(0, dtype=np.int64)
    size = np.diff(np.concatenate((head, [len(row)]))) if len(row) else head
    nth = np.arange(len(row)) - np.repeat(head, size)
    at[np.repeat(size > 1, size)] = -1
    return row, _mixed(run + nth.astype(np.uint64) * _OWN), at


def terms_of(docs: list[list[str]], numbers: Numbers, counts: np.ndarray):
    """(row, term, position, held) of the terms of each document; held is how many records are counted for the term's run.

    Texts up to LONG words have runs of two; those from MIDDLE on have runs of three where two are common, so that texts
    of lengths on either side still meet.
    """
    numbered = [numbers.of(x) for x in docs]
    parts = []
    for low, high, cut_common in ((SHORT + 1, LONG, False), (MIDDLE, None, True)):
        some = [i for i, x in enumerate(numbered) if len(x) >= low and (high is None or len(x) <= high)]
        if not some:
            continue
        row, at, two, three = _runs([numbered[i] for i in some])
        run = two
        if cut_common:
            common = counts[sketch_of(two, SKETCH_BITS)] > COMMON
            keep = ~common | (three != 0)
            row, at, run = row[keep], at[keep], np.where(common, three, two + np.uint64(1))[keep]
        held = counts[sketch_of(np.where(common[keep], run, run - np.uint64(1)) if cut_common else run, SKETCH_BITS)]
        order = np.lexsort((at, run, row))
        held = held[order]
        row, term, at = _numbered(row, at, run)
        parts.append((np.array(some)[row], term, at, held))
    short = [(d, number(f"{len(x)} {i} {k}".encode("utf-8", "surrogatepass"))) for d, x in enumerate(docs) if len(x) <= SHORT for i, w in enumerate(x) for k in shortened(w)]
    if short:
        term = np.array([t for _, t in short], dtype=np.uint64)
        parts.append((np.array([d for d, _ in short]), term, np.full(len(short), -1, dtype=np.int32), counts[sketch_of(term, SKETCH_BITS)]))
    if not parts:
        return tuple(np.zeros(0, dtype=x) for x in (np.int64, np.uint64, np.int32, np.int64))
    return tuple(np.concatenate(x) for x in zip(*parts))


def counted(docs: list[list[str]], numbers: Numbers) -> np.ndarray:
    """Everything a term may be made of, to be counted."""
    _, _, two, three = _runs([numbers.of(x) for x in docs])
    short = [number(f"{len(x)} {i} {k}".encode("utf-8", "surrogatepass")) for x in docs if len(x) <= SHORT for i, w in enumerate(x) for k in shortened(w)]
    return np.concatenate((two, three[three != 0], np.array(short, dtype=np.uint64)))


def needed(n: np.ndarray) -> np.ndarray:
    """Indexed terms that partners share at least, by the words of the longer one."""
    return np.maximum(1, np.floor(0.12 * n) - 1).astype(np.int64)


def left_out(n: np.ndarray) -> np.ndarray:
    """Terms, the lightest, that a text of n words doesn't index: what it shares with any partner less what is needed."""
    shared = np.where(n > SHORT, np.maximum(1, np.ceil(0.4 * n - 2)), n)
    return np.maximum(0, shared - needed(n)).astype(np.int64)


def _texts(batches, most: int = 2000):
    """Slices of the batches, so that what a task holds as words stays small."""
    for pdf in batches:
        for at in range(0, len(pdf), most):
            yield pdf.iloc[at : at + most]


def _first_pass(batches):
    """Rows of two kinds: a record with its class and hash, or a slice of the task's term counts."""
    from pyspark import TaskContext

    numbers, sketch, n = Numbers(), np.zeros(1 << SKETCH_BITS, dtype=np.int32), 0
    for pdf in _texts(batches):
        docs = [words_of(x) for x in pdf["text"]]
        n += len(pdf)
        sketch += np.bincount(sketch_of(counted(docs, numbers), SKETCH_BITS), minlength=1 << SKETCH_BITS).astype(np.int32)
        yield pd.DataFrame(
            {"document_id": pdf["document_id"], "train": pdf["train"], "class": [class_of(w, x) for w, x in zip(docs, pdf["text"])], "hash": [project_hash(x) for x in pdf["text"]], "slice": -1, "task": 0, "counts": None, "n": 0}
        )
    if n:
        rows = summed.slices(sketch, TaskContext.get().partitionId())
        yield rows.assign(document_id=None, train=None, hash=0, n=n, **{"class": 0})


def _indexed(docs: list[list[str]], names: list[int], numbers: Numbers, counts: np.ndarray):
    """(postings, estimated records that hold each): all terms of a text but the lightest, with the parity bitmap of its words."""
    row, term, at, held = terms_of(docs, numbers, counts)
    order = np.lexsort((term, held, row))  # rarest, so heaviest, first: the same order for all texts
    row, term, at, held = row[order], term[order], at[order], held[order]
    n = np.array([len(x) for x in docs], dtype=np.int64)
    size = np.bincount(row, minlength=len(docs))
    rank = np.arange(len(row)) - (np.cumsum(size) - size)[row]
    keep = rank < (size - left_out(n))[row]
    out = np.zeros(keep.sum(), dtype=_POSTING)
    out["term"], out["name"], out["n"], out["at"] = term[keep], np.array(names, dtype=np.int64)[row[keep]], n[row[keep]], at[keep]
    flat = np.array([y for x in docs for y in numbers.of(x)], dtype=np.uint64)
    slot = np.repeat(np.arange(len(docs)), n) * (64 * LANES) + (_mixed(flat) >> np.uint64(32)).astype(np.int64) % (64 * LANES)
    parity = (np.bincount(slot, minlength=len(docs) * 64 * LANES) & 1).astype(np.uint8).reshape(len(docs), -1)
    out["bits"] = np.packbits(parity, axis=1).view(np.uint64)[row[keep]]
    return out, held[keep]


def _index(model, blocks: int, train: bool, allowed=None):
    """A mapInPandas function: rows (block, postings) by block of terms; hot terms go to a grid of blocks."""

    def run(batches):
        numbers, counts, seen = Numbers(), model.value, set()
        bits = allowed.value if allowed is not None else None
        for pdf in _texts(batches):
            docs, names = [], []
            if len(seen) > 1_000_000:
                seen.clear()
            for text in pdf["text"]:
                words = words_of(text)
                if words and (name := class_of(words, text)) not in seen:
                    seen.add(name)
                    names.append(name)
                    docs.append(words)
            if not docs:
                continue
            posting, held = _indexed(docs, names, numbers, counts)
            if bits is not None:
                slot = (posting["term"] % np.uint64(1 << SET_BITS)).astype(np.int64)
                ok = (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
                posting, held = posting[ok], held[ok]
            parts = np.maximum(1, held // HOT).astype(np.int64)
            own = (posting["name"].view(np.uint64) % parts.astype(np.uint64)).astype(np.int64)
            copies = np.repeat(np.arange(len(posting)), parts)
            other = np.arange(len(copies)) - np.repeat(np.cumsum(parts) - parts, parts)
            cell = own[copies] * parts[copies] + other if train else other * parts[copies] + own[copies]
            block = ((posting["term"][copies] + cell.astype(np.uint64) * _OWN) % np.uint64(blocks)).astype(np.int64)
            # the cell is part of the term from here on: only the two sides of one cell meet
            posting = posting[copies]
            posting["term"] += cell.astype(np.uint64) * _OWN
            order = np.argsort(block, kind="stable")
            block, posting = block[order], posting[order]
            head = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1]))) if len(block) else []
            ends = [*head[1:], len(block)]
            yield pd.DataFrame({"block": block[head] if len(block) else [], "postings": [posting[a:b].tobytes() for a, b in zip(head, ends)]})

    return run


def _eval_slots(model, groups: int):
    """Slots of a task's evaluation terms in the bit set, by slice of it; the tasks are put in `groups`."""

    def run(batches):
        from pyspark import TaskContext

        numbers = Numbers()
        for pdf in _texts(batches):
            if docs := [w for x in pdf["text"] if (w := words_of(x))]:
                slot = np.unique((_indexed(docs, [0] * len(docs), numbers, model.value)[0]["term"] % np.uint64(1 << SET_BITS)).astype(np.uint32))
                ends = np.searchsorted(slot, np.arange(summed.SLICES + 1, dtype=np.int64) * ((1 << SET_BITS) // summed.SLICES))
                yield pd.DataFrame({"slice": range(summed.SLICES), "task": TaskContext.get().partitionId() % groups, "counts": [slot[x:y].tobytes() for x, y in zip(ends, ends[1:])]})

    return run


def _bits_of_slots(pdf):
    """The packed bits of one slice of the bit set."""
    bits = np.zeros((1 << SET_BITS) // summed.SLICES, dtype=np.uint8)
    for x in pdf["counts"]:
        bits[np.frombuffer(x, dtype=np.uint32) % np.uint32(len(bits))] = 1
    return pd.DataFrame({"slice": [pdf["slice"].iat[0]], "task": [pdf["task"].iat[0]], "counts": [summed.packed(np.packbits(bits, bitorder="little"))]})


def _candidates(pdf):
    """Pairs of an evaluation and a training class that can agree by length, position and words, with the indexed terms of this block they share and those they need."""
    sides = [np.concatenate([np.frombuffer(x, dtype=_POSTING) for x in pdf["postings"][pdf["train"] == t]] or [np.zeros(0, dtype=_POSTING)]) for t in (False, True)]
    none = pd.DataFrame({x: pd.Series(dtype="int64") for x in ("a", "b", "shared", "need")})
    both = np.intersect1d(sides[0]["term"], sides[1]["term"])
    if not len(both):
        return none
    keys = []
    for i, x in enumerate(sides):
        at = np.searchsorted(both, x["term"])
        at[at == len(both)] = 0
        ok = both[at] == x["term"]
        key = (at[ok] << 32) | x["n"][ok].astype(np.int64)
        order = np.argsort(key, kind="stable")
        sides[i] = x[ok][order]
        keys.append(key[order])
    left, right = sides
    n = left["n"].astype(np.int64)
    base = keys[0] - n
    low = np.searchsorted(keys[1], base + np.ceil(AGREEMENT * n - 1e-9).astype(np.int64))
    high = np.searchsorted(keys[1], base + np.floor(n / AGREEMENT + 1e-9).astype(np.int64), side="right")
    count, found, start = high - low, [], 0
    upto = np.cumsum(count)
    while start < len(left):  # some pairs at a time, whatever the length of a list
        done = upto[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(upto, done + PAIRS_AT_ONCE, side="right")))
        size = count[start:end]
        total = int(size.sum())
        for at in range(0, total, PAIRS_AT_ONCE):
            k = np.arange(at, min(total, at + PAIRS_AT_ONCE))
            owner = np.searchsorted(np.cumsum(size), k, side="right")
            x = left[start + owner]
            y = right[low[start + owner] + k - (np.cumsum(size) - size)[owner]]
            longer = np.maximum(x["n"], y["n"])
            ok = (x["name"] != y["name"]) & ((x["at"] < 0) | (y["at"] < 0) | (np.abs(x["at"] - y["at"]) <= (1 - AGREEMENT) * longer + 1))
            x, y, longer = x[ok], y[ok], longer[ok]
            apart = np.bitwise_count(x["bits"] ^ y["bits"]).sum(axis=1)
            ok = (longer <= SHORT) | (apart <= 2 * DIFFERING * longer + 1)
            n_longer = longer[ok].astype(np.int64)
            found.append(np.stack((x["name"][ok], y["name"][ok], np.ones(ok.sum(), dtype=np.int64), needed(n_longer)), axis=1))
            if len(found) > 4:
                found = [_added(found)]
        start = end
    return pd.DataFrame(_added(found), columns=none.columns) if found else none


def _added(found: list[np.ndarray]) -> np.ndarray:
    """Rows (a, b, shared, need) with one row a pair, shared terms added up."""
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    head = np.flatnonzero(np.concatenate(([True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)))) if len(rows) else np.zeros(0, dtype=np.int64)
    out = rows[head]
    if len(rows):
        out[:, 2] = np.add.reduceat(rows[:, 2], head)
    return out


def products(a: list[str], b: list[str], numbers: Numbers, counts: np.ndarray, n: int) -> tuple[float, float, bool]:
    """(cosine, dot product, whether the product can be a partner's) of two texts over all their terms."""
    row, term, _, held = terms_of([a, b], numbers, counts)
    square = np.clip(np.log(max(n, 1) / np.maximum(held, 1)), 0.05, np.log(RAREST)) ** 2
    dot = float(square[np.isin(term, term[row == 1]) & (row == 0)].sum())
    norms, least = [], []
    for side in (0, 1):
        own = np.sort(square[row == side])
        norms.append(float(own.sum()))
        least.append(float(own[: max(1, int(LEAST_SHARED * len(own)))].sum()))
    return dot / max(1e-12, (norms[0] * norms[1]) ** 0.5), dot, dot >= min(least) - 1e-9


def _verify(model, n: int):
    def run(batches):
        numbers, counts = Numbers(), model.value
        for pdf in _texts(batches):
            out = []
            for k, l, x, y in zip(pdf["a"], pdf["b"], pdf["text_a"], pdf["text_b"]):
                x, y = words_of(x), words_of(y)
                cosine, _, can = products(x, y, numbers, counts, n)
                if can and (share := agreement(x, y, AGREEMENT)) >= AGREEMENT:
                    out.append((k, l, cosine, share))
            yield pd.DataFrame(out, columns=["a", "b", "cosine", "share"])

    return run


def overlaps(df: DataFrame, train: str = "train") -> DataFrame:
    """(document_id_a, document_id_b, share): every pair of records across the splits with the same or nearly the same text.

    df needs document_id, split, text and content_hash; a record with null or empty text pairs with the records whose
    text has its content_hash. Rows without document_id or split give no pairs; a row delivered twice counts once; texts
    without words are the same only if one of them is named by hash. share is the agreeing part of the longer text.
    """
    spark = df.sparkSession
    rows = df.select("document_id", (F.col("split") == train).alias("train"), "text", "content_hash").where("document_id is not null and train is not null")
    texts = rows.where("text is not null and text <> ''").select("document_id", "train", "text")
    kind = "document_id string, train boolean, class bigint, hash bigint, slice int, task int, counts binary, n bigint"
    first = cut(texts.mapInPandas(_first_pass, kind))
    members = first.where("slice < 0").select("document_id", "train", "class", "hash").distinct()
    n = first.where("slice = 0").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    counts = summed(first.where("slice >= 0").select("slice", "task", "counts"), 1 << SKETCH_BITS, np.int32)
    blocks = max(16, n * 25 // TERMS_PER_BLOCK)
    sent = spark.sparkContext.broadcast(counts.astype(np.int64))
    slots = texts.where("not train").mapInPandas(_eval_slots(sent, 1 + n // 2_000_000), summed.KIND).groupBy("slice", "task").applyInPandas(_bits_of_slots, summed.KIND)
    bits = summed(slots, (1 << SET_BITS) // 8, np.uint8, np.bitwise_or)
    allowed = spark.sparkContext.broadcast(bits)
    kind = "block bigint, postings binary"
    evals = texts.where("not train").mapInPandas(_index(sent, blocks, False), kind).withColumn("train", F.lit(False))
    trains = texts.where("train").mapInPandas(_index(sent, blocks, True, allowed), kind).withColumn("train", F.lit(True))
    pairs = evals.unionByName(trains).groupBy("block").applyInPandas(_candidates, "a bigint, b bigint, shared bigint, need bigint")
    pairs = pairs.groupBy("a", "b").agg(F.sum(F.col("shared").cast("int")).alias("shared"), F.max("need").alias("need")).where("shared >= need")
    pairs = cut(pairs.select("a", "b"))
    wanted = cut(pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct())
    chosen = cut(members.join(broadcast_if_small(wanted, BROADCAST_ROWS), "class").groupBy("class").agg(F.min("document_id").alias("document_id")))
    chosen = cut(texts.join(broadcast_if_small(chosen, BROADCAST_ROWS), "document_id").select("class", "text").dropDuplicates(["class"]))
    sides = pairs.join(chosen.select(F.col("class").alias("a"), F.col("text").alias("text_a")), "a").join(chosen.select(F.col("class").alias("b"), F.col("text").alias("text_b")), "b")
    near = cut(sides.mapInPandas(_verify(sent, n), "a bigint, b bigint, cosine double, share double"))
    left, right = members.where("not train").select(F.col("document_id").alias("x"), F.col("class").alias("a")), members.where("train").select(F.col("document_id").alias("y"), F.col("class").alias("b"))
    out = near.select("a", "b", "share").join(left, "a").join(right, "b").select("x", "y", "share")
    out = out.union(left.join(right, left.a == right.b).select("x", "y", F.lit(1.0)))
    empty = rows.where("(text is null or text = '') and content_hash is not null").select("document_id", "train", F.conv(F.substring("content_hash", 1, 16), 16, -10).cast("bigint").alias("hash")).distinct()
    named = empty.select(F.col("document_id").alias("x"), "hash", F.col("train").alias("empty_train")).join(members, "hash").where("train <> empty_train")
    out = out.union(named.select("x", F.col("document_id").alias("y"), F.lit(1.0)))
    return out.groupBy(F.least("x", "y").alias("document_id_a"), F.greatest("x", "y").alias("document_id_b")).agg(F.max("share").alias("share"))


def counts(df: DataFrame, pairs: DataFrame, train: str = "train") -> DataFrame:
    """(split, source_family, pairs, records): pairs and different evaluation records by evaluation split and their source; a null source is a group."""
    facts = df.where(F.col("split") != train).select("document_id", "split", "source_family").distinct()
    each = pairs.select(F.explode(F.array("document_id_a", "document_id_b")).alias("document_id"), F.struct("document_id_a", "document_id_b").alias("pair"))
    return each.join(facts, "document_id").groupBy("split", "source_family").agg(F.countDistinct("pair").alias("pairs"), F.countDistinct("document_id").alias("records"))
