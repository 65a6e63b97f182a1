"""The language of each text and of each stretch of a mixed text, with a confidence.

Bayesian fusion of evidence: word and letter-sequence likelihoods counted over all texts by their declared language,
the language code declared beside the text, the suffix of its address, and a prior of the place the text comes from,
smoothed from the host of its address to its source, to the kind of source and on to the whole collection.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from corpuspark.llm.unicode_form import spelled, suspect
from corpuspark.llm.words import WORD, summed
from corpuspark.session import broadcast_if_small, cut

LANGUAGES = ("hye-w", "hye-e", "eng", "fra", "rus")
#: Declared code -> the languages it is right for.
CODES = {"hyw": ("hye-w",), "hye": ("hye-e",), "hy": ("hye-w", "hye-e"), "en": ("eng",), "fr": ("fra",), "ru": ("rus",)}
#: Slots of the feature table: a fixed size, so that it can be sent to every task.
SLOTS = 1 << 17
#: What a declared code and a source's habit can weigh, in nats.
CODE_RIGHT, CODE_WRONG = 0.9, 0.025
PRIOR_RECORDS = 20.0
#: Cost of a change of language between sentences, and least words of a stretch.
SWITCH = 9.0
LEAST_WORDS = 4
BROADCAST_SOURCES = 200_000
MEMO_WORDS = 300_000
_SENTENCE = re.compile(r"[.։!?…:][»”\")]*\s+|\n+|\s[/—–|]\s")


def sentences(text: str) -> list[list[str]]:
    """Words of each sentence, of the text in ordinary characters; digits alone are no words."""
    if suspect(text):
        text = spelled(text)
    text = text.replace("և", "\x01").casefold().replace("\x01", "և")
    out = [[w for w in WORD.findall(s) if not w.isdigit()] for s in _SENTENCE.split(text)]
    return [x for x in out if x]


def features(word: str) -> list[int]:
    """Slots of the word and of its letter sequences."""
    marked = f"<{word}>"
    parts = [word.encode("utf-8", "surrogatepass")] + [b"\x00" + marked[i : i + 3].encode("utf-8", "surrogatepass") for i in range(len(marked) - 2)]
    return [zlib.crc32(x) % SLOTS for x in parts]


def _count(batches):
    from pyspark import TaskContext

    table = np.zeros((SLOTS, len(LANGUAGES)), dtype=np.int64)
    some = False
    for pdf in batches:
        words: dict[tuple[str, int], int] = {}
        for text, label in zip(pdf["text"], pdf["internal_language_branch"]):
            k = LANGUAGES.index(label)
            for s in sentences(text):
                for w in s:
                    words[w, k] = words.get((w, k), 0) + 1
        for (w, k), n in words.items():
            for slot in features(w):
                table[slot, k] += n
        some |= bool(words)
    if some:
        yield summed.slices(table.reshape(-1), TaskContext.get().partitionId())


def likelihoods(texts: DataFrame) -> np.ndarray:
    """Log likelihood of each feature slot by language, from the texts whose declared language is one of LANGUAGES."""
    labelled = texts.where(F.col("internal_language_branch").isin(*LANGUAGES)).select("text", "internal_language_branch")
    table = summed(labelled.mapInPandas(_count, summed.KIND), SLOTS * len(LANGUAGES), np.int64).reshape(SLOTS, len(LANGUAGES)).astype(float)
    # a declared language is wrong now and then: what is rare under one label and common under another is put down to that
    table = np.maximum(table - 0.06 * table.sum(axis=1, keepdims=True), 0)
    table = np.log((table + 0.3) / (table.sum(axis=0) + 0.3 * SLOTS))
    return (table - table.max(axis=1, keepdims=True)).astype(np.float32)


class Scores:
    """Log likelihoods by language of words, remembered."""

    def __init__(self, table: np.ndarray):
        self.table, self.place, self.rows = table, {}, []

    def of(self, words: list[str]) -> list[int]:
        out = []
        for w in words:
            if (i := self.place.get(w)) is None:
                x = self.table[features(w)]
                i = self.place[w] = len(self.rows)
                self.rows.append(np.maximum(x[0] + 0.5 * x[1:].sum(axis=0), -12))
            out.append(i)
        return out

    def shrink(self):
        if len(self.rows) > MEMO_WORDS:
            self.place, self.rows = {}, []


def stretches(scores: np.ndarray, words: np.ndarray) -> list[tuple[int, int, int]]:
    """(language, first sentence, end) of each stretch: the best path over sentences with a cost for each change.

    A stretch of less than LEAST_WORDS words joins its neighbour.
    """
    n = len(scores)
    best, back = scores[0].copy(), np.zeros((n, scores.shape[1]), dtype=np.int64)
    for i in range(1, n):
        top = int(best.argmax())
        change = best[top] - SWITCH
        back[i] = np.where(best >= change, np.arange(len(best)), top)
        best = np.maximum(best, change) + scores[i]
    path = [int(best.argmax())]
    for i in range(n - 1, 0, -1):
        path.append(int(back[i][path[-1]]))
    path.reverse()
    out: list[list[int]] = []
    for i, k in enumerate(path):
        if out and out[-1][0] == k:
            out[-1][2] = i + 1
        else:
            out.append([k, i, i + 1])
    long = [x for x in out if words[x[1] : x[2]].sum() >= LEAST_WORDS] or out[:1]
    merged: list[list[int]] = []
    for k, a, b in long:
        if merged and merged[-1][0] == k:
            merged[-1][2] = b
        else:
            merged.append([k, a, b])
    return [tuple(x) for x in merged]


def _score(model):
    def run(batches):
        scores = Scores(model.value)
        for pdf in batches:
            index, lengths, per_doc = [], [], []
            scores.shrink()
            for text in pdf["text"]:
                parts = sentences(text)
                per_doc.append(len(parts))
                for p in parts:
                    index += scores.of(p)
                    lengths.append(len(p))
            lengths = np.array(lengths, dtype=np.int64)
            heads = np.concatenate(([0], np.cumsum(lengths)))[:-1]
            each = np.add.reduceat(np.array(scores.rows)[index], heads, axis=0) if index else np.zeros((0, len(LANGUAGES)))
            at, logs, parts, shares = 0, [], [], []
            for n in per_doc:
                s, w = each[at : at + n], lengths[at : at + n]
                at += n
                found = stretches(s, w) if n > 1 else [(int(s[0].argmax()), 0, 1)] if n else []
                total = np.zeros(len(LANGUAGES))
                for k, a, b in found:
                    total[k] += w[a:b].sum()
                # most of the text decides; one language only: its likelihoods do
                logs.append([float(x) for x in (s.sum(axis=0) if len(set(k for k, _, _ in found)) < 2 else np.where(total == total.max(), 0, -60))] if n else [0.0] * len(LANGUAGES))
                shares.append(int(w.sum()))
                parts.append(
                    [
                        {"lang": LANGUAGES[k], "confidence": _sure(s[a:b].sum(axis=0)), "words": int(w[a:b].sum())}
                        for k, a, b in found
                    ]
                )
            yield pd.DataFrame({"document_id": pdf["document_id"], "logs": logs, "words": shares, "parts": parts})

    return run


def _sure(logs: np.ndarray) -> float:
    first, second = np.sort(logs)[::-1][:2]
    return float(1 / (1 + np.exp(-np.clip((first - second) / 4, 0, 40))))


def host_of(url: Column) -> Column:
    """The host of an address in lower case without www, null if there is none."""
    return F.nullif(F.regexp_replace(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), r"^www\.", ""), F.lit(""))


#: The places a text comes from, the narrowest last; each is drawn towards the one before it.
LEVELS = ("kind", "source_family", "host")


def placed(rows: DataFrame) -> DataFrame:
    host = host_of(F.col("source_url"))
    return rows.withColumns({"kind": F.substring_index("source_family", ":", 1), "host": host, "suffix": F.substring_index(host, ".", -1)})


def _shares(rows: DataFrame, by: list[str]) -> DataFrame:
    labelled = rows.where(F.col("internal_language_branch").isin(*LANGUAGES))
    return labelled.groupBy(*by).agg(*[F.count_if(F.col("internal_language_branch") == x).cast("double").alias(f"n{i}") for i, x in enumerate(LANGUAGES)])


def _drawn(n: Column, base: Column) -> Column:
    """Shares of counts drawn towards base shares, as if PRIOR_RECORDS more had been seen."""
    total = F.aggregate(n, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(n, base, lambda x, b: (x + PRIOR_RECORDS * b) / (total + PRIOR_RECORDS))


def priors(rows: DataFrame) -> DataFrame:
    """(kind, source_family, host, prior): log shares of the declared languages, smoothed from host to source to kind to all."""
    names = [f"n{i}" for i in range(len(LANGUAGES))]
    counts = cut(_shares(rows, list(LEVELS)))
    total = counts.agg(*[F.coalesce(F.sum(x), F.lit(0.0)).alias(x) for x in names]).select(F.array(*names).alias("n"))
    all_of = F.aggregate("n", F.lit(0.0), lambda a, x: a + x)
    out = counts.select(*LEVELS).crossJoin(F.broadcast(total.select(F.transform("n", lambda x: (x + 1) / (all_of + len(names))).alias("prior"))))
    for k in range(len(LEVELS)):  # sums by wider places are made from the counted ones, not from the rows
        by = LEVELS[: k + 1]
        own = counts.groupBy(*by).agg(*[F.sum(x).alias(x) for x in names]).select(*[F.col(x).alias(f"__{x}") for x in by], F.array(*names).alias("n"))
        same = [F.col(x).eqNullSafe(F.col(f"__{x}")) for x in by]
        out = out.join(own, same, "left").select(*LEVELS, _drawn(F.col("n"), F.col("prior")).alias("prior"))
    return out.select(*LEVELS, F.transform("prior", lambda x: F.log(x)).alias("prior"))


def suffixes(rows: DataFrame) -> DataFrame:
    """(suffix, evidence): log likelihoods of an address suffix by language, up to a constant, from the declared languages."""
    names = [f"n{i}" for i in range(len(LANGUAGES))]
    counts = _shares(rows.where("suffix is not null"), ["suffix"])
    total = counts.agg(*[F.sum(x).alias(f"all{x}") for x in names], F.count(F.lit(1)).alias("kinds"))
    # a suffix counts as evidence only as far as hosts under it don't say the same already: its weight is halved
    each = [0.5 * F.log((F.col(x) + 1) / (F.col(f"all{x}") + F.col("kinds"))) for x in names]
    return counts.crossJoin(F.broadcast(total)).select("suffix", F.array(*each).alias("evidence"))


def _with(df: DataFrame, name: str) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast("string"))


def languages(records: DataFrame, metadata: DataFrame) -> DataFrame:
    """(document_id, branch, code, has_code, lang, confidence, parts): the language of every non-empty text.

    parts are the stretches of the text in order, each with lang, confidence and words. Null or empty texts and null
    ids give no rows; unknown declared labels count as missing; repeated rows count once; a text without words follows
    its declared code and source.
    """
    rows = records.where("document_id is not null and text is not null and text <> ''")
    rows = placed(_with(rows, "source_url")).select("document_id", "text", *LEVELS, "suffix", "internal_language_branch")
    model = records.sparkSession.sparkContext.broadcast(likelihoods(rows))
    kind = "document_id string, logs array<double>, words int, parts array<struct<lang:string,confidence:double,words:int>>"
    scored = cut(rows.select("document_id", "text").mapInPandas(_score(model), kind).dropDuplicates(["document_id"]))
    facts = rows.select("document_id", *LEVELS, "suffix", "internal_language_branch").dropDuplicates(["document_id"])
    codes = metadata.where("document_id is not null").select("document_id", F.col("source_language_code").alias("code"), F.lit(True).alias("has_code")).dropDuplicates(["document_id"])
    out = scored.join(facts, "document_id").join(codes, "document_id", "left")
    places = broadcast_if_small(cut(priors(rows)).select(*[F.col(x).alias(f"of_{x}") for x in LEVELS], "prior"), BROADCAST_SOURCES)
    out = out.join(places, [F.col(x).eqNullSafe(F.col(f"of_{x}")) for x in LEVELS], "left").join(broadcast_if_small(cut(suffixes(rows)), BROADCAST_SOURCES), "suffix", "left")
    posts = []
    for i, x in enumerate(LANGUAGES):
        right = [c for c, of in CODES.items() if x in of]
        declared = F.when(F.col("code").isin(*right), F.log(F.lit(CODE_RIGHT))).when(F.col("code").isin(*CODES), F.log(F.lit(CODE_WRONG))).otherwise(0.0)
        posts.append(F.col("logs")[i] + declared + F.coalesce(F.col("prior")[i], F.lit(0.0)) + F.coalesce(F.col("evidence")[i], F.lit(0.0)))
    out = out.withColumn("post", F.array(*posts)).withColumn("top", F.array_max("post"))
    second = F.element_at(F.sort_array("post", asc=False), 2)
    lang = F.element_at(F.array(*map(F.lit, LANGUAGES)), F.array_position("post", F.col("top")).cast("int"))
    sure = 1 / (1 + F.exp(-F.least((F.col("top") - second) / 4, F.lit(40.0))))
    return out.select("document_id", F.col("internal_language_branch").alias("branch"), "code", F.coalesce("has_code", F.lit(False)).alias("has_code"), lang.alias("lang"), sure.alias("confidence"), "parts")


def wrong_labels(records: DataFrame, metadata: DataFrame) -> DataFrame:
    """(document_id, field_name, segment_no, lang): missing and wrong labels, and the stretches of mixed texts."""
    found = cut(languages(records, metadata))
    branch = found.where("branch is null or branch <> lang").select("document_id", F.lit("internal_language_branch").alias("field_name"), F.lit(0).alias("segment_no"), "lang")
    fits = F.lit(False)
    for code, of in CODES.items():
        fits |= (F.col("code") == code) & F.col("lang").isin(*of)
    code = found.where(F.col("has_code") & ~F.coalesce(fits, F.lit(False))).select("document_id", F.lit("source_language_code").alias("field_name"), F.lit(0).alias("segment_no"), "lang")
    mixed = found.where(F.size(F.array_distinct(F.col("parts.lang"))) > 1).select("document_id", F.posexplode("parts").alias("at", "part"))
    parts = mixed.select("document_id", F.lit("text").alias("field_name"), (F.col("at") + 1).cast("int").alias("segment_no"), F.col("part.lang").alias("lang"))
    return branch.unionByName(code).unionByName(parts)
