"""Text of scanned pages made into continuous paragraphs.

Running headers and page numbers are told by their form and by how lines repeat within a text; words cut at line ends
are joined; misread words are corrected by a noisy channel. How likely each confusion of characters is, is estimated
over the corpus for each recognition engine, from word forms aligned with the forms they may be misread from; that times
the likelihood of a word after the one before it, from the corpus's counts of words, adjacent words and letter
sequences, is decoded by Viterbi over each line. Candidates come by joins: forms that are equal when every confusion is
folded away meet, whatever their number of confusions; where the right form isn't in the corpus, a Viterbi search over
the confusions of the form finds its likeliest spelling. No table of the corpus is held in one place; what is sent to
tasks is the letter sequences in a table of fixed size and the confusions of each engine.
"""

from __future__ import annotations

import difflib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from corpuspark.llm.words import Numbers, number, summed
from corpuspark.session import broadcast_if_small, cut

# What the characters of a word get misread as.
CONFUSIONS = """
ա>ш ո>n ր>ռ ե>է՛ ւ>ı տ>տ՛ ի>1 մ>յ1 ս>u կ>l| բ>ն հ>ճ օ>0 օ>o գ>q զ>q ց>g հ>h ու>nı ո>0 լ>l է>է՛ ն>տ՛ ի>l
e>c o>0 g>q h>li l>1 d>cl m>rn i>! i>1 s>5 b>6 i>l
о>0 з>3 б>6 и>n п>n т>m ш>щ е>с ч>4 н>и
"""
ORDER = 4
#: Slots of the table of letter sequences: letters are few, so it fills up only so far whatever the corpus.
SLOTS = 1 << 20
MARKS = "-֊­¬‐‑"
#: Nats by which the corrected word must beat the word as it stands.
MARGIN = 0.5
#: Share of a word's likelihood that its spelling gives, the rest its count.
SPELLED = 0.1
#: Weight of a word's own likelihood against what follows the word before it, in occurrences of that word.
ALONE = 20.0
#: A confusion's probability before any is counted, and how many uses that counts for; the same for an engine against all.
FIRST, FIRST_USES, ENGINE_USES = 0.003, 200.0, 200.0
#: Least nats that the letter sequences around a confusion must be unlikely by for its form to be searched.
UNLIKELY = 6.0
BROADCAST_SCANS = 200_000
#: Forms whose bits are set to rule out the others: 16 MB at any size of the data.
SET_BITS = 27

_PAIRS = [tuple(x.split(">")) for x in CONFUSIONS.split()]
_TOKEN = re.compile(r"[^\s,.։՝«»“”()\[\]—–;:?…/\x0c]+")
_DIGITS = r"[\dlIOoı|!]"
_PAGE = re.compile(
    rf"^\W*(?:(?:էջ|page|p\.|pp\.|стр\.?|с\.|№)\s*)?(?:(?=\S*[\dlO]){_DIGITS}{{1,3}})\W*$|^(?:[-—–\[(]+\s*|\W*(?:էջ|page|p\.|стр\.?)\s*){_DIGITS}{{1,4}}\s*[-—–\])]*$", re.I
)
_ROMAN = re.compile(r"^\W*(?:[ivxl]{1,7}|[IVXL]{1,7}|[Ա-Ղ]?[Ժ-Ղ]?[Ա-Թ]?)\W*$")
_NUMBERS = re.compile(rf"^\W*{_DIGITS}{{1,4}}(?=\s{{2,}}|\s+\D)\s+|\s+{_DIGITS}{{1,4}}\W*$")
_PURE = re.compile("(?:[a-zà-öø-ÿœ]+(?:['’-][a-zà-öø-ÿœ]+)*|[а-яё]+(?:-[а-яё]+)*|[ա-և]+(?:[՚’-][ա-և]+)*|\\d+(?:ին|[a-zа-я]{1,3})?|\\W+)$")
_SET_APART = re.compile(rf"^\W*(?=\S*[\dlO]){_DIGITS}{{1,4}}\s{{2,}}\S|\S\s{{2,}}(?=\S*[\dlO]){_DIGITS}{{1,4}}\W*$")
_ENDS = re.compile(r"[.։:?!…]\W*$")


def skeleton(line: str) -> str:
    """A line's letters in a form that misread characters don't change much."""
    line = line.casefold().replace("և", "եւ").replace("՛", "")
    for right, wrong in (("մ", "յ1"), ("կ", "l|"), ("h", "li"), ("d", "cl"), ("m", "rn")):
        line = line.replace(wrong, right)
    return re.sub(r"[\W_]+", "", line.translate(_FOLD))


#: Orders under which the runs of a line are compared, odd factors of a hash.
_FACTORS = np.random.default_rng(3).integers(1, 1 << 31, 10, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLD = str.maketrans("шnռıէ1uqg0o!5cճօ6", "աորւեիսգցոոիսեհոբ")


def _number_only(line: str) -> bool:
    s = line.strip(" \x0c\t")
    if not s or _ENDS.search(s) and not re.search(r"\d\.$", s):
        return False
    if _PAGE.match(s):
        return True
    bare = re.sub(r"\W+", "", s)
    return bool(bare) and len(s) <= 10 and bool(_ROMAN.match(s))


def structure(text: str, title: str | None = None, author: str | None = None) -> list[str]:
    """The kind of each line: running_header, page_number, body or empty."""
    lines = text.split("\n")
    kinds = ["" if not x.strip(" \x0c\t") else "page_number" if _number_only(x) else "body" for x in lines]
    keys: dict[int, str] = {}
    alike = Likeness()
    for i, k in enumerate(kinds):
        if k == "body":
            s = _NUMBERS.sub("", lines[i].strip(" \x0c\t"))
            if 6 <= len(key := skeleton(s)) and not _ENDS.search(lines[i].strip()) and s[-1] not in MARKS:
                keys[i] = key
    for i in keys:  # capitals throughout, or a number set apart from the words, are no running text
        s = lines[i].strip(" \x0c\t")
        if s.isupper() and len(s.split()) > 1 or _SET_APART.search(s):
            kinds[i] = "running_header"
    edges = set()
    for i, k in enumerate(kinds):
        if k in ("", "page_number") or "\x0c" in lines[i]:
            edges.update((i - 1, i, i + 1, i - 2, i + 2))
    edges.update((0, 1, len(lines) - 1, len(lines) - 2))
    loose = {i for i in keys if i in edges or _NUMBERS.search(lines[i].strip())}
    known = [x for x in (skeleton(title or ""), skeleton(author or "")) if len(x) >= 6]
    same = defaultdict(list)
    for i, key in keys.items():
        same[key].append(i)
    far = {key for key, at in same.items() if at[-1] - at[0] > 4}
    heads = list(dict.fromkeys([*known, *far]))
    for lead, at in alike.groups({i: keys[i] for i in sorted(loose)}).items():
        if at[-1] - at[0] > 4:  # lines at page edges that are much alike head each other's pages
            heads += [x for x in dict.fromkeys(keys[i] for i in at) if x not in heads]
    near = alike.to(heads)
    for key, at in same.items():
        if key in far or near(key):
            for i in at:
                if i in loose or len(key) < 60 or key in heads:
                    kinds[i] = "running_header"
    return kinds


class Likeness:
    """Whether two keys are much alike; runs of three letters rule most pairs out before the exact ratio."""

    def __init__(self):
        self.threes: dict[str, frozenset[str]] = {}

    def _runs(self, key: str) -> frozenset[str]:
        if key not in self.threes:
            self.threes[key] = frozenset(key[i : i + 3] for i in range(len(key) - 2))
        return self.threes[key]

    def groups(self, keys: dict[int, str]) -> dict[str, list[int]]:
        """Leading key -> lines much alike it; only keys with an equal least run under one of several orders are compared."""
        leads: dict[tuple[int, int], list[str]] = defaultdict(list)
        out: dict[str, list[int]] = {}
        done: dict[str, str] = {}
        for i, key in keys.items():
            if key not in done:
                hashes = np.array([zlib.crc32(x.encode("utf-8", "surrogatepass")) for x in self._runs(key)], dtype=np.uint64)
                bands = list(enumerate(((hashes[:, None] * _FACTORS[None, :]) & np.uint64(0xFFFFFFFF)).min(axis=0).tolist()))
                found = dict.fromkeys(x for band in bands for x in leads[band])
                done[key] = next((x for x in found if self(key, x)), key)
                if done[key] == key:
                    for band in bands:
                        leads[band].append(key)
                    out[key] = []
            out[done[key]].append(i)
        return out

    def to(self, heads: list[str]):
        """Whether a key is much alike one of the heads; only heads that share enough of its runs are compared."""
        holders: dict[str, list[str]] = defaultdict(list)
        for x in heads:
            for run in self._runs(x):
                holders[run].append(x)

        lengths = {n for x in heads for n in range(int(0.8 * len(x)), int(len(x) / 0.8) + 2)}

        def near(key: str) -> bool:
            if len(key) not in lengths:
                return False
            votes = Counter(x for run in self._runs(key) for x in holders.get(run, ()))
            return any(n >= 0.35 * min(len(self._runs(key)), len(self._runs(x))) and self(key, x) for x, n in votes.most_common())

        return near

    def __call__(self, a: str, b: str) -> bool:
        if a == b:
            return True
        if abs(len(a) - len(b)) > 0.2 * max(len(a), len(b)):
            return False
        x, y = self._runs(a), self._runs(b)
        if len(x & y) < 0.35 * min(len(x), len(y)):
            return False
        return difflib.SequenceMatcher(None, a, b, autojunk=False).ratio() >= 0.85


def broken(line: str, after: str | None) -> bool:
    """Whether a line ends in a word cut by a mark that isn't the word's own; a capital goes on after a compound's own hyphen."""
    s = line.rstrip(" \x0c\t")
    if not s or s[-1] not in MARKS or len(s) < 2 or not s[-2].isalpha():
        return False
    if s[-1] in "¬­":
        return True
    go = (after or "").lstrip(" \x0c\t")
    return not (go[:1].isupper() and not s[-3:-1].isupper())


def body_lines(text: str, kinds: list[str]) -> list[tuple[list[tuple[str, int]], int, bool]]:
    """(words with the line each begins on, line number, broken) of each body line; the word a line cuts comes whole, on both lines."""
    lines = text.split("\n")
    order = [i for i, k in enumerate(kinds) if k == "body"]
    out, carry, carry_line = [], None, 0
    for n, i in enumerate(order):
        line = lines[i].strip(" \x0c\t")
        after = lines[order[n + 1]] if n + 1 < len(order) else None
        is_broken = broken(line, after)
        tokens = _TOKEN.findall(line)
        words = []
        if carry and tokens:
            words.append((carry + tokens[0], carry_line))
            tokens_rest = tokens[1:]
        else:
            tokens_rest = tokens
        carry = None
        if is_broken and tokens_rest:
            carry, carry_line = tokens_rest[-1].rstrip(MARKS), i
            tokens_rest = tokens_rest[:-1]
        elif is_broken and words:
            carry, carry_line = words.pop()[0].rstrip(MARKS), i
        words += [(w, i) for w in tokens_rest]
        out.append((words, i, is_broken))
    if carry:
        out[-1][0].append((carry, out[-1][1]))
    return out


def folded(word: str) -> str:
    return word.casefold().replace("և", "եւ") if "և" not in word else word.replace("և", "\x01").casefold().replace("\x01", "և")


def forms(words: list[tuple[str, int]]) -> list[tuple[str, int, str]]:
    """(form, line, as written) of the parts of words; a compound is judged by its parts."""
    return [(folded(x), i, x) for w, i in words for x in w.split("-") if x]


def _frames() -> dict[int, str]:
    """Translation that folds away all confusions: a word and what it may be misread as come out equal."""
    pairs = [(a.replace("՛", ""), b.replace("՛", "")) for a, b in _PAIRS]
    root: dict[str, str] = {}

    def find(x: str) -> str:
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        if len(a) == len(b) == 1:
            root[find(a)] = find(b)
    wide = {find(a): b for a, b in pairs if len(a) == 1 and len(b) > 1}
    out = {x: wide.get(find(x), find(x)) for x in list(root) + [a for a in wide if a not in root]}
    return {ord(x): "".join(find(c) for c in y) for x, y in out.items()} | {ord("՛"): ""}


_FRAMES = _frames()


def frame(word: str) -> str:
    return word.translate(_FRAMES)


def may_err(word: str) -> bool:
    """Whether a form is a word at all: numbers, with their endings, are none, but for a day's number whose ending is misread."""
    return sum(map(str.isalpha, word)) >= 2 and not re.fullmatch(r"\d+(?:ին|[a-zа-я]{1,3})?", word) or bool(re.fullmatch(r"\d{1,2}1ն", word))


def alignment(right: str, wrong: str) -> list[int] | None:
    """The fewest confusions, as their numbers, that make `wrong` of `right`; None if there are none that do."""
    best: dict[tuple[int, int], list[int]] = {(0, 0): []}
    for i in range(len(right) + 1):
        for j in range(len(wrong) + 1):
            if (ops := best.get((i, j))) is None:
                continue
            if i < len(right) and j < len(wrong) and right[i] == wrong[j]:
                if len(best.get((i + 1, j + 1), ops + [0])) > len(ops):
                    best[i + 1, j + 1] = ops
            for p, (a, b) in enumerate(_PAIRS):
                if right.startswith(a, i) and wrong.startswith(b, j) and len(best.get((i + len(a), j + len(b)), ops + [0, 0])) > len(ops) + 1:
                    best[i + len(a), j + len(b)] = ops + [p]
    return best.get((len(right), len(wrong)))


def _grams(word: str) -> list[str]:
    marked = "^" * (ORDER - 1) + word + "$"
    return [marked[i : i + ORDER] for i in range(len(marked) - ORDER + 1)]


def _slot(gram: str) -> int:
    return number(gram.encode("utf-8", "surrogatepass")) % SLOTS


class Spelling:
    """Likelihood of letter sequences, and the likeliest spelling behind a form."""

    def __init__(self, table: np.ndarray):
        self.table, self.memo, self.words = table, {}, {}

    def log(self, gram: str) -> float:
        if (x := self.memo.get(gram)) is None:
            if len(self.memo) > 500_000:
                self.memo.clear()
            x = self.memo[gram] = math.log((float(self.table[_slot(gram)]) + 0.02) / (float(self.table[_slot(gram[:-1])]) + 1.0))
        return x

    def of(self, word: str) -> float:
        if (x := self.words.get(word)) is None:
            if len(self.words) > 500_000:
                self.words.clear()
            x = self.words[word] = sum(map(self.log, _grams(word)))
        return x

    def suspect(self, word: str) -> bool:
        """Whether a confusion can stand where the letter sequences are unlikely enough for another letter to be likelier."""
        logs = [self.log(g) for g in _grams(word)]
        for _, b in _PAIRS:
            at = word.find(b)
            while at >= 0:
                if -sum(logs[at : at + len(b) + ORDER - 1]) >= UNLIKELY:
                    return True
                at = word.find(b, at + 1)
        return False

    def likeliest(self, word: str, cost: list[float]) -> tuple[str, list[int]] | None:
        """The word with at least one confusion that gives the form with the greatest likelihood: a Viterbi search over its letters."""
        tail = "^" * (ORDER - 1)
        states: list[dict] = [{} for _ in range(len(word) + 1)]
        states[0][tail, False] = (0.0, "", [])
        for i in range(len(word)):
            steps = [(p, a, len(b)) for p, (a, b) in enumerate(_PAIRS) if word.startswith(b, i)]
            for (last, changed), (score, out, ops) in states[i].items():
                for p, a, n in [(-1, word[i], 1), *steps]:
                    x, t = score + (cost[p] if p >= 0 else 0.0), last
                    for c in a:
                        x += self.log(t + c)
                        t = (t + c)[1:]
                    key = (t, changed or p >= 0)
                    if key not in states[i + n] or states[i + n][key][0] < x:
                        states[i + n][key] = (x, out + a, ops + [p] if p >= 0 else ops)
        ends = [(x + self.log(t + "$"), out, ops) for (t, changed), (x, out, ops) in states[-1].items() if changed]
        return max(ends)[1:] if ends else None


def _structured(batches):
    """Texts with the kind of each line and the engine of its page; pages share the lines by their counts of characters."""
    for pdf in batches:
        out = []
        for key, text, title, author, pages in zip(pdf["text_id"], pdf["full_text"], pdf["title"], pdf["author"], pdf["pages"]):
            kinds = structure(text, title, author)
            sizes = [max(1, p["n"] or 1) for p in pages] if pages is not None and len(pages) else [1]
            names = [p["engine"] or "" for p in pages] if pages is not None and len(pages) else [""]
            ends = np.cumsum(sizes) / sum(sizes)
            at = np.cumsum([len(x) + 1 for x in text.split("\n")])
            page = np.minimum(np.searchsorted(ends, (at - 1) / max(1, at[-1])), len(names) - 1)
            out.append((key, text, "".join(_LETTER_OF[k] for k in kinds), [names[p] for p in page]))
        yield pd.DataFrame(out, columns=["text_id", "full_text", "kinds", "engines"])


_LETTER_OF = {"": "e", "body": "b", "page_number": "n", "running_header": "h"}
_KIND_OF = {v: k for k, v in _LETTER_OF.items()}


def _flow(row) -> list[tuple[list[tuple[str, int, str]], int, bool]]:
    return [(forms(ws), i, cut_) for ws, i, cut_ in body_lines(row.full_text, [_KIND_OF[k] for k in row.kinds])]


def _pair(a: int, b: int) -> int:
    return (a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F + 1) % (1 << 64) - (1 << 63)


def _paired(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    """_pair of arrays of numbers."""
    b = np.full(len(a), b, dtype=np.uint64) if isinstance(b, int) else b
    mixed = a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1)
    return (mixed - np.uint64(1 << 63)).view(np.int64)


def _count(batches):
    """Rows (word, engine, n) and (h, n): forms, and the numbers of adjacent forms and of single ones."""
    numbers = Numbers()
    for pdf in batches:
        words, ids, lines = Counter(), [], []
        for n, row in enumerate(pdf.itertuples()):
            for line, i, _ in _flow(row):
                words.update([(f, row.engines[at]) for f, at, _ in line])
                ids += [numbers[f] for f, _, _ in line]
                lines += [(n, i)] * len(line)
        yield pd.DataFrame([(w, e, n, 0) for (w, e), n in words.items()], columns=["word", "engine", "n", "h"])
        if ids:
            flat, of = np.array(ids, dtype=np.uint64), np.array(lines, dtype=np.int64)
            same = (of[1:] == of[:-1]).all(axis=1)
            pairs, n = np.unique(np.concatenate((_paired(flat, 0), _paired(flat[:-1], flat[1:])[same])), return_counts=True)
            yield pd.DataFrame({"word": pd.Series([None] * len(n), dtype=object), "engine": pd.Series([None] * len(n), dtype=object), "n": n, "h": pairs})


def _gram_counts(batches):
    from pyspark import TaskContext

    table, some = np.zeros(SLOTS, dtype=np.float32), False
    for pdf in batches:
        grams: Counter = Counter()
        for word, n in zip(pdf["word"], pdf["n"]):
            if n > 1 and word.isalpha() and _PURE.match(word):
                for g in _grams(word):
                    grams[g] += math.log(n)
                    grams[g[:-1]] += math.log(n)
        for g, x in grams.items():
            table[_slot(g)] += x
        some = True
    if some:
        yield summed.slices(table, TaskContext.get().partitionId())


def _aligned(batches):
    for pdf in batches:
        rows = [(w, n, c, cn, ops) for w, n, c, cn in zip(pdf["word"], pdf["n"], pdf["c"], pdf["cn"]) if (ops := alignment(c, w))]
        yield pd.DataFrame(rows, columns=["word", "n", "c", "cn", "ops"])


def _spelled(model):
    """(word, n, c, cn, ops): the likeliest spelling behind each form that is of no script alone or has unlikely letters."""

    def run(batches):
        spelling, first = Spelling(model.value), [math.log(FIRST)] * len(_PAIRS)
        for pdf in batches:
            out = []
            for word, n in zip(pdf["word"], pdf["n"]):
                if may_err(word) and (not _PURE.match(word) or spelling.suspect(word)) and (found := spelling.likeliest(word, first)):
                    out.append((word, n, found[0], 0, found[1]))
            yield pd.DataFrame(out, columns=["word", "n", "c", "cn", "ops"])

    return run


def _weights(pdf, spelling: Spelling, total: int, cost) -> list[tuple[float, list[float]]]:
    """For each row of a form and its candidates: log likelihood of the form as it stands, and of each candidate with its confusions."""
    out = []
    for word, n, options in zip(pdf["word"], pdf["n"], pdf["options"]):
        stands = likelihood(word, genuine(n, options, cost), total, spelling)
        out.append((stands, [likelihood(o["c"], o["cn"], total, spelling) + sum(cost[p] for p in o["ops"]) for o in options]))
    return out


def genuine(n: int, options, cost) -> int:
    """Occurrences of a form, the one at hand left out, that misreading its candidates doesn't explain: up to three standard deviations over twice the expected number."""
    expected = 2 * sum(o["cn"] * math.exp(sum(cost[p] for p in o["ops"])) for o in options)
    return n - 1 if n > expected + 3 * math.sqrt(expected) + 1 else 0


def likelihood(word: str, n: int, total: int, spelling: Spelling) -> float:
    """Log likelihood of a word: its other occurrences in the corpus if it is of one script's letters, and its spelling."""
    seen = max(0, n) / max(1, total) if _PURE.match(word) else 0.0
    return math.log((1 - SPELLED) * seen + SPELLED * math.exp(max(-60.0, spelling.of(word))) + 1e-20)


def _hits(model, total: int):
    """(engine, op, hits): expected occurrences of each confusion, by how likely each candidate is against the others."""

    def run(batches):
        spelling, first = Spelling(model.value), [math.log(FIRST)] * len(_PAIRS)
        hits: Counter = Counter()
        for pdf in batches:
            for engines, options, (stands, scores) in zip(pdf["engines"], pdf["options"], _weights(pdf, spelling, total, first)):
                top = max([stands, *scores])
                each = [math.exp(x - top) for x in scores]
                rest = math.exp(stands - top) + sum(each)
                for o, x in zip(options, each):
                    for e in engines:
                        for p in o["ops"]:
                            hits[e["engine"], int(p)] += e["n"] * x / rest
        yield pd.DataFrame([(e, p, x) for (e, p), x in hits.items()], columns=["engine", "op", "hits"])

    return run


def _uses(batches):
    """(engine, op, uses): how often what a confusion starts from occurs."""
    uses: Counter = Counter()
    for pdf in batches:
        for word, engine, n in zip(pdf["word"], pdf["engine"], pdf["n"]):
            for p, (a, _) in enumerate(_PAIRS):
                if k := word.count(a):
                    uses[engine, p] += k * n
    yield pd.DataFrame([(e, p, x) for (e, p), x in uses.items()], columns=["engine", "op", "uses"])


def confusions(hits: DataFrame, uses: DataFrame) -> dict[str, list[float]]:
    """Engine -> log probability of each confusion, drawn towards that over all engines where it is rarely used; "" stands for all."""
    table = hits.groupBy("engine", "op").agg(F.sum("hits").alias("hits")).join(uses.groupBy("engine", "op").agg(F.sum("uses").alias("uses")), ["engine", "op"], "full_outer").fillna(0)
    table = table.toPandas()  # engines times confusions
    out, every = {}, np.full(len(_PAIRS), FIRST)
    for p, x in table.groupby("op")[["hits", "uses"]].sum().iterrows():
        every[p] = min(0.5, (x["hits"] + FIRST * FIRST_USES) / (x["uses"] + x["hits"] + FIRST_USES))
    out[""] = np.log(every).tolist()
    for engine, part in table.groupby("engine"):
        own = every.copy()
        for p, h, u in zip(part["op"], part["hits"], part["uses"]):
            own[p] = min(0.5, (h + every[p] * ENGINE_USES) / (u + h + ENGINE_USES))
        out[engine] = np.log(own).tolist()
    return out


def _asked_forms(model):
    def run(batches):
        bits, numbers = model.value, Numbers()
        for pdf in batches:
            rows = []
            for row in pdf.itertuples():
                words = {f for line, _, _ in _flow(row) for f, _, _ in line}
                rows += [(row.at, w) for w in words if bits[(s := numbers[w] >> (64 - SET_BITS)) >> 3] >> (s & 7) & 1]
            yield pd.DataFrame(rows, columns=["at", "word"])

    return run


def _bit_slots(batches):
    from pyspark import TaskContext

    bits, some = np.zeros((1 << SET_BITS) // 8, dtype=np.uint8), False
    for pdf in batches:
        for w in pdf["word"]:
            s = number(w.encode("utf-8", "surrogatepass")) >> (64 - SET_BITS)
            bits[s >> 3] |= 1 << (s & 7)
            some = True
    if some:
        yield summed.slices(bits, TaskContext.get().partitionId())


def _asked_pairs(batches):
    """(at, h): numbers of the forms and adjacent forms that the decoding of a text weighs."""
    numbers = Numbers()
    for pdf in batches:
        out = []
        for row in pdf.itertuples():
            known = {o["word"]: [o["word"], *(c["c"] for c in o["options"])] for o in row.options}
            asked = set()
            for line, _, _ in _flow(row):
                choice = [known.get(f, [f]) for f, _, _ in line]
                for x, y in zip(choice, choice[1:]):
                    if len(x) > 1 or len(y) > 1:
                        asked.update(_pair(a, 0) for a in numbers.of(x))
                        asked.update(_pair(a, b) for a in numbers.of(x) for b in numbers.of(y))
            out += [(row.at, h) for h in asked]
        yield pd.DataFrame(out, columns=["at", "h"])


class Decoder:
    """Viterbi over the candidates of each line of one text."""

    def __init__(self, spelling: Spelling, cost: dict[str, list[float]], total: int):
        self.spelling, self.cost, self.total, self.numbers, self.memo = spelling, cost, total, Numbers(), {}

    def read(self, row):
        self.known = {o["word"]: (o["n"], o["options"]) for o in row.options} if row.options is not None else {}
        self.pairs = {x["h"]: x["n"] for x in row.pairs} if row.pairs is not None else {}

    def _after(self, a: str, b: str, alone: float, doubted: bool) -> float:
        """Log likelihood of b after a; what is doubted has only its own likelihood there."""
        x, y = self.numbers[a], self.numbers[b]
        both = 0 if doubted else self.pairs.get(_pair(x, y), 0)
        return math.log((both + ALONE * math.exp(alone)) / (max(self.pairs.get(_pair(x, 0), 0), both) + ALONE))

    def choices(self, form: str) -> tuple:
        """What a form may be: (word, log likelihood, confusions, whether its counts are doubted), itself first; the same in all texts."""
        if (found := self.memo.get(form)) is not None:
            return found
        if len(self.memo) > 300_000:
            self.memo.clear()
        n, options = self.known[form]
        left = genuine(n, options, self.cost[""])
        out = [(form, likelihood(form, left, self.total, self.spelling), (), not left or not _PURE.match(form))]
        for o in options:
            if _PURE.match(form) and self.spelling.of(o["c"]) < self.spelling.of(form) and o["cn"] <= n:
                continue
            out.append((o["c"], likelihood(o["c"], o["cn"], self.total, self.spelling), tuple(o["ops"]), False))
        self.memo[form] = out
        return out

    def line(self, words: list[tuple[str, int, str]], engines: list[str]) -> list[str | None]:
        """For each word the correction, or None where it stands."""
        if not any(f in self.known for f, _, _ in words):
            return [None] * len(words)
        paths: list[tuple[float, list[int]]] = []
        before: list = []
        every = []
        for f, i, _ in words:
            choice = self.choices(f) if f in self.known else [(f, 0.0, (), False)]
            cost = self.cost.get(engines[i], self.cost[""])
            step = []
            for k, (c, alone, ops, doubted) in enumerate(choice):
                channel = sum(cost[p] for p in ops) - MARGIN if ops else 0.0
                if not before:
                    step.append((alone + channel, [k]))
                    continue
                weigh = alone and (len(choice) > 1 or len(before) > 1)
                score, path = max(((s + (self._after(before[p[-1]][0], c, alone, doubted or before[p[-1]][3]) if weigh else alone), p) for s, p in paths), key=lambda x: x[0])
                step.append((score + channel, path + [k]))
            every.append(choice)
            before, paths = choice, step
        best = max(paths, key=lambda x: x[0])[1]
        return [every[i][k][0] if k else None for i, k in enumerate(best)]


def findings(row, decoder: Decoder) -> list[tuple[int, str]]:
    """(line_no, kind) of a text's noise."""
    kinds = [_KIND_OF[k] for k in row.kinds]
    out = [(i + 1, k) for i, k in enumerate(kinds) if k in ("running_header", "page_number")]
    lines = row.full_text.split("\n")
    for words, i, is_broken in _flow(row):
        if is_broken:
            out.append((i + 1, "broken_word"))
        for (form, at, _), better in zip(words, decoder.line(words, row.engines)):
            if better is None:
                continue
            if at == i:
                out.append((i + 1, "misread"))
            else:  # the word began on an earlier line: the misread part is on one of the two
                first = len(_TOKEN.findall(lines[at].strip(" \x0c\t"))[-1].rstrip(MARKS).rsplit("-", 1)[-1])
                where = next((n for n, (x, y) in enumerate(zip(form, better)) if x != y), len(form))
                out.append(((at if where < first else i) + 1, "misread"))
    return sorted(set(out))


def _in_case(word: str, like: str) -> str:
    return word.upper() if len(like) > 1 and like.isupper() else word.capitalize() if like[:1].isupper() else word


def clean(row, decoder: Decoder) -> str:
    """The text as continuous paragraphs."""
    lines, flow = row.full_text.split("\n"), _flow(row)
    width = np.percentile([len(lines[i]) for _, i, _ in flow], 75) if flow else 0
    paragraphs, now = [], ""
    for n, (words, i, is_broken) in enumerate(flow):
        line = lines[i].strip(" \x0c\t")
        for (form, at, written), better in zip(words, decoder.line(words, row.engines)):
            if better is not None and at == i:
                line = line.replace(written, _in_case(better, written), 1)
            elif better is not None:
                head, tail = re.split(r"(?<=[\s-])(?=[^\s-]*$)", now)[-1], re.match(r"[^\s,.։՝«»“”()\[\]—–;:?…/-]+", line)
                if tail and folded(head + tail[0]) == form:
                    now = now[: len(now) - len(head)] + _in_case(better, written)
                    line = line[tail.end() :]
        own_hyphen = len(now) > 1 and now[-1] in MARKS and now[-2].isalpha()
        now += ("" if n and flow[n - 1][2] or not now or own_hyphen else " ") + line
        if is_broken:
            now = now.rstrip(MARKS)
        elif _ENDS.search(line) and len(lines[i]) < 0.8 * width:
            paragraphs.append(now)
            now = ""
    return "\n\n".join([*paragraphs, *([now] if now else [])])


def _apply(model, total: int, what):
    def run(batches):
        table, cost = model.value
        decoder = Decoder(Spelling(table), cost, total)
        for pdf in batches:
            keys, values = [], []
            for row in pdf.itertuples():
                decoder.read(row)
                keys.append(row.text_id)
                values.append(what(row, decoder))
            if what is findings:
                rows = [(k, n, kind) for k, v in zip(keys, values) for n, kind in v]
                yield pd.DataFrame(rows, columns=["text_id", "line_no", "kind"])
            else:
                yield pd.DataFrame({"text_id": keys, "clean": values})

    return run


def _pages(metrics: DataFrame | None, spark) -> DataFrame:
    """(archive, pages): engine and characters of the pages of each scan in order; a page recorded again counts as recorded last."""
    if metrics is None:
        return spark.createDataFrame([], "archive string, pages array<struct<engine:string,n:bigint>>")
    last = metrics.where("pdf_name is not null and page_num is not null").groupBy("pdf_name", "page_num").agg(F.max_by(F.struct("engine", F.col("char_count").cast("bigint").alias("n")), "recorded_at").alias("x"))
    pages = last.groupBy("pdf_name").agg(F.array_sort(F.collect_list(F.struct("page_num", "x"))).alias("pages"))
    return pages.select(F.regexp_replace("pdf_name", r"\.pdf$", "").alias("archive"), F.transform("pages", lambda p: p["x"]).alias("pages"))


def _ready(df: DataFrame, metrics: DataFrame | None):
    """(texts with their candidates and counts, model, words of the corpus)."""
    spark = df.sparkSession
    archive = F.col("archive_id") if "archive_id" in df.columns else F.lit(None).cast("string")
    texts = df.where("text_id is not null and full_text is not null").select("text_id", "title", "author", "full_text", archive.alias("archive"))
    kind = "text_id string, full_text string, kinds string, engines array<string>"
    # one shuffle serves the removal of repeats and the even spread of the work
    texts = texts.repartition(2 * spark.sparkContext.defaultParallelism, "text_id").dropDuplicates(["text_id", "full_text"])
    texts = texts.join(broadcast_if_small(cut(_pages(metrics, spark)), BROADCAST_SCANS), "archive", "left")
    texts = cut(texts.mapInPandas(_structured, kind).withColumn("at", F.monotonically_increasing_id()))
    counted = cut(texts.mapInPandas(_count, "word string, engine string, n bigint, h bigint"))
    engines = counted.where("word is not null").groupBy("word", "engine").agg(F.sum("n").alias("n"))
    lexicon = cut(engines.groupBy("word").agg(F.sum("n").alias("n"), F.collect_list(F.struct("engine", "n")).alias("engines")))
    total = lexicon.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    grams = spark.sparkContext.broadcast(summed(lexicon.select("word", "n").mapInPandas(_gram_counts, summed.KIND), SLOTS, np.float32))
    framed = lexicon.select("word", "n", _frame("word").alias("frame")).where(_errs("word"))
    near = framed.join(framed.where(_pure("word")).select(F.col("word").alias("c"), F.col("n").alias("cn"), "frame"), "frame").where("word <> c and cn >= n")
    shape = "word string, n bigint, c string, cn bigint, ops array<int>"
    near = near.select("word", "n", "c", "cn").mapInPandas(_aligned, shape)
    alone = lexicon.select("word", "n").mapInPandas(_spelled(grams), shape)
    options = near.unionByName(alone).groupBy("word", "n", "c").agg(F.max_by("ops", "cn").alias("ops"), F.max("cn").alias("cn"))
    options = options.groupBy("word", "n").agg(F.array_sort(F.collect_list(F.struct("c", "cn", "ops"))).alias("options"))
    options = cut(options.join(lexicon.select("word", "engines"), "word"))
    cost = confusions(
        options.mapInPandas(_hits(grams, total), "engine string, op int, hits double"), lexicon.select("word", F.explode("engines").alias("e")).select("word", "e.*").mapInPandas(_uses, "engine string, op int, uses double")
    )
    bits = spark.sparkContext.broadcast(summed(options.select("word").mapInPandas(_bit_slots, summed.KIND), (1 << SET_BITS) // 8, np.uint8, np.bitwise_or))
    asked = texts.mapInPandas(_asked_forms(bits), "at bigint, word string").join(options.select("word", "n", "options"), "word")
    asked = cut(asked.groupBy("at").agg(F.collect_list(F.struct("word", "n", "options")).alias("options")))
    pairs = counted.where("word is null").groupBy("h").agg(F.sum("n").alias("n"))
    weighed = texts.select("at", "full_text", "kinds").join(asked, "at").mapInPandas(_asked_pairs, "at bigint, h bigint").join(pairs, "h")
    weighed = weighed.groupBy("at").agg(F.collect_list(F.struct("h", "n")).alias("pairs"))
    return texts.join(asked, "at", "left").join(weighed, "at", "left"), spark.sparkContext.broadcast((grams.value, cost)), total


@F.pandas_udf(T.StringType())
def _frame(words):
    return words.map(frame)


@F.pandas_udf(T.BooleanType())
def _errs(words):
    return words.map(may_err)


@F.pandas_udf(T.BooleanType())
def _pure(words):
    return words.map(lambda w: bool(_PURE.match(w)))


def noise(df: DataFrame, metrics: DataFrame | None = None) -> DataFrame:
    """(text_id, line_no, kind): running headers, page numbers, broken words and misread words of every text.

    metrics, if given, names the engine of each page (pdf_name, page_num, engine, char_count, recorded_at); a page without
    one counts for all engines together. Null texts and ids give no rows, an empty text has no noise, a text delivered
    twice counts once, title and author may be null.
    """
    texts, model, total = _ready(df, metrics)
    return texts.mapInPandas(_apply(model, total, findings), "text_id string, line_no int, kind string").distinct()


def repaired(df: DataFrame, metrics: DataFrame | None = None) -> DataFrame:
    """(text_id, clean): each text as clean continuous paragraphs."""
    texts, model, total = _ready(df, metrics)
    return texts.mapInPandas(_apply(model, total, clean), "text_id string, clean string")
