"""Words of texts as 64-bit numbers in arrays, shared by the operators that compare texts."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pandas as pd

from corpuspark.llm.unicode_form import spelled, suspect

WORD = re.compile(r"[^\W_]+")
#: Distinct words a task remembers before it starts over.
MEMO_WORDS = 400_000


def words_of(text: str) -> list[str]:
    """The words of a text in its one form: case, punctuation, spacing and invisible differences don't count."""
    if suspect(text):
        text = spelled(text)
    return WORD.findall(text.casefold())


def number(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little")


class Numbers(dict):
    """Word -> its 64-bit number."""

    def __missing__(self, word: str) -> int:
        if len(self) > MEMO_WORDS:
            self.clear()
        self[word] = out = number(word.encode("utf-8", "surrogatepass"))
        return out

    def of(self, words: list[str]) -> list[int]:
        return [self[w] for w in words]


def sketch_of(numbers: np.ndarray, bits: int) -> np.ndarray:
    """Slot of each number in a sketch of 2 ** bits counters."""
    return (numbers >> np.uint64(64 - bits)).astype(np.int64)


class _Summed:
    """Arrays of fixed size that each task makes, added up over all tasks without gathering them in one place.

    A task gives its array in slices of one row each; slices are added in groups of tasks first, then over the groups.
    """

    KIND, SLICES, GROUPS = "slice int, task int, counts binary", 64, 512

    def slices(self, array: np.ndarray, task: int) -> pd.DataFrame:
        return pd.DataFrame({"slice": range(self.SLICES), "task": task % self.GROUPS, "counts": [self.packed(x) for x in np.split(array, self.SLICES)]})

    @staticmethod
    def packed(array: np.ndarray) -> bytes:
        return zlib.compress(array.tobytes(), 1)

    def __call__(self, rows, size: int, dtype, add=np.add) -> np.ndarray:
        """The sum of the arrays of rows (slice, task, counts); zeros if there are none."""

        def run(pdf):
            total = add.reduce([np.frombuffer(zlib.decompress(x), dtype=dtype) for x in pdf["counts"]])
            return pd.DataFrame({"slice": [pdf["slice"].iat[0]], "task": [pdf["task"].iat[0]], "counts": [self.packed(total.astype(dtype))]})

        out = np.zeros((self.SLICES, size // self.SLICES), dtype=dtype)
        for r in rows.groupBy("slice", "task").applyInPandas(run, self.KIND).groupBy("slice").applyInPandas(run, self.KIND).collect():  # of fixed size
            out[r["slice"]] = np.frombuffer(zlib.decompress(r["counts"]), dtype=dtype)
        return out.reshape(-1)


summed = _Summed()


def lcs(a: list, b: list) -> int:
    """Length of the longest common subsequence, with the positions of b as bits of one number."""
    places: dict = {}
    for i, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(b)) - 1
    v = full
    for x in a:
        if m := places.get(x):
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(b) - v.bit_count()


def slip(a: str, b: str) -> bool:
    """Whether two different words are a typing slip apart: one letter more, less, other or swapped; two in long words."""
    if a == b:
        return True
    most = 1 if min(len(a), len(b)) < 9 else 2
    if abs(len(a) - len(b)) > most or min(len(a), len(b)) < 3:
        return False
    two, before = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            best = min(before[j] + 1, now[j - 1] + 1, before[j - 1] + (x != y))
            if two is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, two[j - 2] + 1)
            now.append(best)
        two, before = before, now
    return before[-1] <= most


def shortened(word: str) -> set[str]:
    """The word and what is left without one of its letters, without two in words of nine letters and more; shorter than three it stands."""
    out, last = {word}, {word}
    for _ in range(0 if len(word) < 3 else 1 if len(word) < 9 else 2):
        last = {w[:i] + w[i + 1 :] for w in last for i in range(len(w))}
        out |= last
    return out


def agreement(a: list[str], b: list[str], least: float) -> float:
    """Share of the longer text's words that agree in order; a word with a typing slip agrees."""
    longer = max(len(a), len(b))
    if not longer or min(len(a), len(b)) < least * longer:
        return 0.0 if longer else 1.0
    share = lcs(a, b) / longer
    if share >= least:
        return share
    mine, other = set(b), set(a)
    index: dict[str, list[str]] = {}
    for w in dict.fromkeys(b):
        if w not in other:
            for k in shortened(w):
                index.setdefault(k, []).append(w)
    same = {}
    for w in other - mine:
        if near := next((x for k in sorted(shortened(w)) for x in index.get(k, ()) if slip(w, x)), None):
            same[w] = near
    return lcs([same.get(w, w) for w in a], b) / longer if same else share
