"""Text decoded with the wrong character encoding: found, and restored where it can be.

Suspicious documents are joined with clean near-twins on the text without its non-ASCII characters: each document gives
the least hashes of windows of that text, and one of all of it, and the clean document that shares most is the twin.
Clauses of both that are equal without their non-ASCII characters are aligned; each pair of runs votes for the reading
that turns the garbled run into the clean one, and, whatever the encoding, for the characters that stand for each clean
character: as many as the bytes of its UTF-8, or one. What is learned is applied to the remaining records, readings with
most votes first, then the learned characters to runs no reading explains. A run counts as garbled only if undoing it
gives text of the languages at hand; a replacement character is garbled but lost unless a twin has it.
"""

from __future__ import annotations

import difflib
import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from corpuspark.llm.words import number
from corpuspark.session import broadcast_if_small, cut

#: Single-byte encodings in which UTF-8 gets read.
READINGS = ("cp1252", "mac_roman", "cp1251", "cp437", "cp866")
BROADCAST_ROWS = 400_000
#: Votes a learned substitution needs, and its share among all that its character got.
LEAST_VOTES, LEAST_SHARE = 5, 0.9

_FRENCH = "àâäæçèéêëîïñôöùûüÿœÀÂÇÈÉÊËÎÏÔÙÛÜŒ"
_ORDINARY = f"\\x00-\\x7fԱ-Ֆՙ-՟ա-և։֊А-яЁё’‘“”„«»—–…•№°{_FRENCH}"
_ODD = re.compile(f"[^{_ORDINARY}]|[ÀÂÇÈÊËÎÏÔÙÛÜàâäæçèéêëîïñôöùûüÿ]{{3}}")
_SWAPPED = re.compile(r"[а-яё][А-ЯЁЈ]{2}|[А-ЯЁЈі]{2,}")
_PLAIN = re.compile("[\u00a0-ÿŒœŠšŽžŸƒˆ˜€’‘“”„‚‹›†‡‰«»—–…•№™ʼЀ-џҐґԱ-և։֊ՙ-՟]+")
_NON_ASCII = re.compile(r"[^\x00-\x7f]+")
_CLAUSE = re.compile(r"(?<=[,.;!?\n])")
#: Windows of the ASCII remainder: pieces of one, its characters at least, and how many a document gives.
WINDOW, WINDOW_CHARS, WINDOWS = 6, 12, 8


def _characters(codec: str) -> list[str]:
    """The character of each byte; bytes without one in the encoding stand for the control character of their number."""
    out = []
    for b in range(256):
        try:
            out.append(bytes([b]).decode(codec))
        except UnicodeDecodeError:
            out.append(chr(b))
    return out


class Utf8Read:
    """UTF-8 read as a single-byte encoding."""

    def __init__(self, codec: str):
        chars = _characters(codec)
        self.name, self.codes = f"utf-8 as {codec}", {x: b for b, x in enumerate(chars) if b >= 0x80}
        if codec == "cp1252":  # as ISO 8859-1 too, which has the control characters
            self.codes |= {chr(b): b for b in range(0x80, 0xA0)}
        cls = lambda lo, hi: "[" + "".join(re.escape(x) for x, b in self.codes.items() if lo <= b <= hi) + "]"
        rest = cls(0x80, 0xBF)
        self.unit = f"(?:{cls(0xC2, 0xDF)}{rest}|{cls(0xE0, 0xEF)}{rest}{{2}}|{cls(0xF0, 0xF4)}{rest}{{3}})"
        self.run = re.compile(f"{self.unit}+")
        # leads and followers that ordinary text has side by side, as an apostrophe before a letter or a capital before a quote
        self.weak = {"mac_roman": "[’‘–—“”][^\x00-\x7f]", "cp1251": "[А-Яа-я][«»“”‘’–—…№ёЁ ]"}.get(codec, "[À-ßà-ï][»«’”“—– ]")
        self.weak = re.compile(f"(?:{self.weak}){{1,2}}")

    def undo(self, run: str) -> str | None:
        try:
            return bytes(self.codes[x] for x in run).decode("utf-8")
        except (KeyError, UnicodeDecodeError):
            return None

    def repaired(self, text: str) -> tuple[str, int]:
        """The text with units undone, and how many sure ones there were; unsure ones are undone beside sure ones only."""
        sure, spans = 0, []
        for m in self.run.finditer(text):
            out = self.undo(m[0])
            if out is None or not _PLAIN.fullmatch(re.sub("[\x80-\x9f]", "", out) or "é"):
                continue
            sure += not self.weak.fullmatch(m[0])
            spans.append((m.start(), m.end(), out))
        if not sure:
            return text, 0
        parts, at = [], 0
        for start, end, out in spans:
            parts += [text[at:start], out]
            at = end
        return "".join(parts) + text[at:], sure


def _armscii() -> dict[int, str]:
    """ARMSCII-8 above 0xA0: signs by list, then capital and small letters in turn."""
    out = dict(zip(range(0xA2, 0xB2), "և։)(»«—.՝,-֊…՜՛՞"))
    for i in range(38):
        out[0xB2 + 2 * i], out[0xB3 + 2 * i] = chr(0x531 + i), chr(0x561 + i)
    return out | {0xFE: "՚"}


def _bytes_of(codec: str) -> dict[int, str]:
    return {b: x for b, x in enumerate(_characters(codec)) if b >= 0x80}


class OtherRead:
    """A single-byte encoding read as another one."""

    def __init__(self, name: str, right: dict[int, str], wrong: dict[int, str], letters: str, run: str):
        self.name, self.map = name, {x: right[b] for b, x in wrong.items() if b in right}
        self.shape = re.compile(f"(?:[{letters[0]}]?[{letters[1]}]+|[{letters[0]}]+)[^\\w]*|[^\\w]+")
        self.run, self.letter = re.compile(run), re.compile(f"[{letters[0]}{letters[1]}]")

    def undo(self, run: str) -> str:
        return "".join(self.map.get(x, x) for x in run)

    def repaired(self, text: str) -> tuple[str, int]:
        sure, parts, at = 0, [], 0
        for m in self.run.finditer(text):
            out = self.undo(m[0])
            if not self.shape.fullmatch(out):
                continue
            sure += sum(map(bool, map(self.letter.match, out))) >= 3
            parts += [text[at : m.start()], out]
            at = m.end()
        return ("".join(parts) + text[at:], sure) if sure else (text, 0)


LATIN1_RUN = "(?<![A-Za-zĀ-ʯ])[¡-ÿ]+(?![A-Za-zĀ-ʯ])"
_LATIN1 = {b: chr(b) for b in range(0xA0, 0x100)}
UTF8_READS = [Utf8Read(x) for x in READINGS]
BYTE_READS = [
    OtherRead("armscii-8 as cp1252", _armscii(), _LATIN1, ("Ա-Ֆ", "ա-և"), LATIN1_RUN),
    OtherRead("cp1251 as cp1252", _bytes_of("cp1251"), _LATIN1, ("А-ЯЁ", "а-яё"), LATIN1_RUN),
]
KOI8 = OtherRead("koi8-r as cp1251", _bytes_of("koi8_r"), _bytes_of("cp1251"), ("А-ЯЁ", "а-яё"), "[А-яЁёЈіЇї]+")
ALL_READS = [*UTF8_READS, *BYTE_READS, KOI8]
_SMALL = "абвгдежзийклмнопрстуфхцчшщъыьэюяё"


def bigrams_of(text: str) -> Counter:
    """Counts of Cyrillic letter pairs with word ends, of ordinarily written words."""
    return Counter(x for w in re.findall(r"\b[А-ЯЁ]?[а-яё]+\b", text) for x in zip("_" + w.lower(), w.lower() + "_"))


def _swapped(text: str, table: np.ndarray | None) -> tuple[str, int]:
    """Undoes KOI8-R read as CP1251, whose mark is swapped case; words all in capitals count if they read better undone."""
    if table is None:
        score = lambda w: 0.0
    else:
        place = {x: i for i, x in enumerate("_" + _SMALL)}
        score = lambda w: float(np.mean([table[place.get(a, 0), place.get(b, 0)] for a, b in zip("_" + w.lower(), w.lower() + "_")]))
    sure, parts, at = 0, [], 0
    for m in KOI8.run.finditer(text):
        word = m[0]
        if word.islower() or len(word) > 1 and word[0].isupper() and word[1:].islower():
            continue
        out = KOI8.undo(word)
        if not KOI8.shape.fullmatch(out):
            continue
        odd = bool(re.match("[а-яё][А-ЯЁЈ]+$", word)) or "Ј" in word
        better = score(out) > score(word) + 0.7
        if not (odd and better or odd and table is None or better and word.isupper()):
            continue
        sure += len(word) >= 3 and (odd or score(out) > score(word) + 1.2)
        parts += [text[at : m.start()], out]
        at = m.end()
    return ("".join(parts) + text[at:], sure) if sure else (text, 0)


def repair(text: str, order: list[str] | None = None, learned: dict[str, str] | None = None, table: np.ndarray | None = None) -> tuple[str, bool]:
    """(restored text, whether it was garbled). What can't be restored stays as it is."""
    odd, swapped = _ODD.search(text), _SWAPPED.search(text)
    if not odd and not swapped:
        return text, False
    reads = [*UTF8_READS, *BYTE_READS]
    if order:
        reads.sort(key=lambda r: order.index(r.name) if r.name in order else len(order))
    garbled, out = "�" in text, text
    def other():
        return max(((sure, new) for read in BYTE_READS for new, sure in [read.repaired(out)]), key=lambda x: x[0])

    if odd:  # the reading with more sure runs goes first: each finds chance hits in text garbled by the other
        byte_runs, new = other()
        if byte_runs > max(read.repaired(out)[1] for read in UTF8_READS):
            out, garbled = new, True
    while True:  # text decoded wrongly several times gets shorter with each reading undone
        before = out
        for read in reads if odd else ():
            if isinstance(read, Utf8Read):
                out, sure = read.repaired(out)
                garbled |= sure > 0
        if out == before:
            break
    if odd:
        byte_runs, new = other()
        if byte_runs:
            out, garbled = new, True
    if swapped:
        out, sure = _swapped(out, table)
        garbled |= sure > 0
    if learned and odd:
        for m in reversed(list(_NON_ASCII.finditer(out))):
            if _ODD.search(m[0]) and (new := respelled(m[0], learned)):
                out, garbled = out[: m.start()] + new + out[m.end() :], True
    return out, garbled


def respelled(run: str, learned: dict[str, str]) -> str | None:
    """A run in learned characters, the longest that fit first; None unless all of it fits and the outcome is ordinary."""
    at, parts, longest = 0, [], max(map(len, learned))
    while at < len(run):
        size = next((n for n in range(min(longest, len(run) - at), 0, -1) if run[at : at + n] in learned), 0)
        if not size:
            return None
        parts.append(learned[run[at : at + size]])
        at += size
    out = "".join(parts)
    return out if len(run) >= 3 and len(parts) >= 2 and not _ODD.search(out) else None


def suspicious(text: str) -> bool:
    return bool(_ODD.search(text) or _SWAPPED.search(text))


def windows(text: str) -> list[int]:
    """Hashes of a text without its non-ASCII characters: of all of it, and the least ones of its windows."""
    bare = _NON_ASCII.sub("", text)
    pieces = re.findall(r"\s+|\S+", bare)
    parts = ("".join(pieces[i : i + WINDOW]) for i in range(max(0, len(pieces) - WINDOW + 1)))
    hashes = {number(b"w" + x.encode()) - (1 << 63) for x in parts if len(x) >= WINDOW_CHARS}
    return [number(bare.encode()) - (1 << 63), *sorted(hashes)[:WINDOWS]]


def _skeletons(batches):
    pairs = np.zeros((34, 34), dtype=np.int64)
    place = {x: i for i, x in enumerate("_" + _SMALL)}
    for pdf in batches:
        keys, odd = [], []
        for text in pdf["text"]:
            keys.append(windows(text))
            odd.append(suspicious(text))
            if not odd[-1] and "о" in text:
                for (a, b), n in bigrams_of(text).items():
                    pairs[place[a], place[b]] += n
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "keys": keys, "odd": odd, "pairs": None})
    if pairs.any():
        yield pd.DataFrame({"doc_id": [0], "keys": [[]], "odd": [None], "pairs": [pairs.tobytes()]})


def _sum_pairs(pdf):
    return pd.DataFrame({"pairs": [sum(np.frombuffer(x, dtype=np.int64) for x in pdf["pairs"]).tobytes()]})


def aligned_runs(bad: str, good: str):
    """Pairs of non-ASCII runs at the same place of clauses that are equal without them."""
    sides = []
    for text in (bad, good):
        clauses = [c for c in _CLAUSE.split(text) if c]
        sides.append(([tuple(_NON_ASCII.split(c)) for c in clauses], [_NON_ASCII.findall(c) for c in clauses]))
    (x, runs), (y, others) = sides
    same = range(len(x)) if x == y else None
    blocks = [(0, 0, len(x))] if same else difflib.SequenceMatcher(None, x, y, autojunk=False).get_matching_blocks()
    for i, j, n in blocks:
        for k in range(n):
            yield from zip(runs[i + k], others[j + k])


def _votes(batches):
    """Rows (kind, garbled, clean, votes): readings by name, and the characters that stand for a clean one."""
    for pdf in batches:
        count: Counter = Counter()
        for bad, good in zip(pdf["bad"], pdf["good"]):
            for run, clean in aligned_runs(bad, good):
                if run == clean or not _ODD.search(run):
                    continue
                for name in [r.name for r in ALL_READS if r.undo(run) == clean][:1]:
                    count["read", name, ""] += 1
                sizes = [len(c.encode("utf-8", "surrogatepass")) for c in clean]
                if len(run) == len(clean):
                    sizes = [1] * len(clean)
                if len(run) == sum(sizes):
                    at = 0
                    for c, n in zip(clean, sizes):
                        count["letter", run[at : at + n], c] += 1
                        at += n
        yield pd.DataFrame([(*k, n) for k, n in count.items()], columns=["kind", "garbled", "clean", "votes"])


def learn(documents: DataFrame):
    """(order, learned, table, twins, some): readings by votes, learned characters, Cyrillic pair scores, (doc_id, twin, whole), texts of both."""
    texts = documents.where("doc_id is not null and text is not null").select("doc_id", "text")
    rows = cut(texts.mapInPandas(_skeletons, "doc_id bigint, keys array<bigint>, odd boolean, pairs binary"))
    table = None
    if found := rows.where("pairs is not null").select(F.lit(1).alias("one"), "pairs").groupBy("one").applyInPandas(_sum_pairs, "pairs binary").collect():
        counts = np.frombuffer(found[0]["pairs"], dtype=np.int64).reshape(34, 34) + 0.1
        table = np.log(counts / counts.sum(axis=1, keepdims=True))
    each = rows.where("odd is not null").select("doc_id", "odd", F.posexplode("keys").alias("at", "key")).withColumn("at", F.least("at", F.lit(1)))
    odd = cut(each.where("odd").select("doc_id", "at", "key").distinct())
    keys = broadcast_if_small(odd.select("at", "key").distinct(), BROADCAST_ROWS)
    # one clean document stands for all that share a window, so a window of many documents makes no pairs
    even = each.where("not odd").join(keys, ["at", "key"]).groupBy("at", "key").agg(F.min("doc_id").alias("twin"))
    shared = odd.join(even, ["at", "key"]).groupBy("doc_id", "twin").agg((F.max(1 - F.col("at")) == 1).alias("whole"), F.count(F.lit(1)).alias("n"))
    best = shared.groupBy("doc_id").agg(F.max_by(F.struct("twin", "whole"), F.struct("whole", "n", -F.col("twin"))).alias("x"))
    twins = cut(best.select("doc_id", "x.twin", "x.whole"))
    wanted = broadcast_if_small(twins.select(F.explode(F.array("doc_id", "twin")).alias("doc_id")).distinct(), BROADCAST_ROWS)
    some = cut(texts.join(wanted, "doc_id").dropDuplicates(["doc_id"]))
    sides = twins.join(some.select("doc_id", F.col("text").alias("bad")), "doc_id").join(some.select(F.col("doc_id").alias("twin"), F.col("text").alias("good")), "twin")
    votes = sides.select("bad", "good").mapInPandas(_votes, "kind string, garbled string, clean string, votes bigint")
    votes = votes.groupBy("kind", "garbled", "clean").agg(F.sum("votes").alias("votes")).where((F.col("votes") >= LEAST_VOTES) | (F.col("kind") == "read")).toPandas()
    reads = votes[votes["kind"] == "read"].sort_values("votes", ascending=False)
    letters = votes[votes["kind"] == "letter"]
    share = letters["votes"] / letters.groupby("garbled")["votes"].transform("sum")
    learned = dict(zip(letters["garbled"][share >= LEAST_SHARE], letters["clean"][share >= LEAST_SHARE]))
    return list(reads["garbled"]), learned, table, twins, some


def _apply(model):
    def run(batches):
        order, learned, table = model.value
        for pdf in batches:
            out = [repair(x, order, learned, table) for x in pdf["text"]]
            pdf = pdf.assign(restored=[x for x, _ in out], garbled=[y for _, y in out])
            yield pdf[pdf["garbled"]][["doc_id", "text", "restored"]]

    return run


def garbled(documents: DataFrame) -> DataFrame:
    """(doc_id, text, restored, whole): the garbled documents with the text restored; whole is false where characters stay lost.

    Null ids and texts give no rows; an empty text is never garbled; repeated rows count once.
    """
    order, learned, table, twins, some = learn(documents)
    texts = documents.where("doc_id is not null and text is not null").select("doc_id", "text")
    model = documents.sparkSession.sparkContext.broadcast((order, learned, table))
    out = texts.mapInPandas(_apply(model), "doc_id bigint, text string, restored string").distinct()
    lost = F.col("restored").contains("�")
    good = twins.where("whole").join(some.select(F.col("doc_id").alias("twin"), F.col("text").alias("good")), "twin").select("doc_id", "good")
    out = out.join(good, "doc_id", "left").withColumn("restored", F.when(lost & F.col("good").isNotNull(), F.col("good")).otherwise(F.col("restored")))
    return out.select("doc_id", "text", "restored", (~lost).alias("whole"))
