"""The main body of web pages and articles.

Markup is rendered by a tree builder with implied tags and visibility rules that keeps block spacing, lists and
aligned cells. Text that comes rendered already has no tags, so what is left of its layout stands for them: the shape of
each line (a sentence, a label, a title), and how it recurs. A line that recurs among the documents of its site, or whose
form with names and numbers left out recurs over sites, is a block of the page and not of the text; whether such a block
heads a list of links is learned from what follows it throughout the corpus. Regions open and close by implication, and
only lines of the body region are visible. No words of any language are listed.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from corpuspark.llm.words import number
from corpuspark.session import broadcast_if_small, cut

#: Different documents in which a line recurs on its site, in all, and at least as a share of the documents of either.
ON_SITE, OVER_ALL, SHARE_ON_SITE, SHARE_OVER_ALL = 3, 5, 0.005, 0.0002
#: Words of a label at most: what stands before a colon at the start of a line.
LABEL_WORDS = 4
#: Share of a recurring line's occurrences that titles follow for it to head a list.
HEADS = 0.5
BROADCAST_FORMS = 1_000_000

_LEAD = re.compile(r"^[\s•*»›—–\-·|]+")
_TAIL = re.compile(r"(?:\s*[»›|]+|!|\.\.\.|…)\s*$")
_SEPARATED = re.compile(r"\S(?:\s*[|›·•]\s*|\s+[>/]\s+|\s{3,})\S")
_DATE = re.compile(r"^\d{1,2}[ ./-][^\W\d]+[ ./-]\d{4}\b|^\d{4}-\d\d-\d\d|^\d{1,2}[./]\d{1,2}[./]\d{4}")
_PAGES = re.compile(r"^[\d\s….»«|›‹-]+$")
_WORD = re.compile(r"[^\W\d_]+")
_TOKEN = re.compile(r"[^\W\d_]+(?:[՛՞՜’'][^\W\d_]+)*|\d+")
_MARKS = re.compile("[՛՞՜’՚']")
_BYLINE = re.compile(r"^[^\W\d_]+ [^\W\d_]+, [^\W\d_]+(?: [^\W\d_]+){0,2}$")
_NUMBERED = re.compile(r"^\s*\d{1,2}[.)]\s")
_LABEL = re.compile(r"^([^:՝]{2,60}?)\s*[:՝]")
_ENDED = re.compile(r"[.։?][»”\")]*$")
_QUOTED_END = re.compile(r"[.։?!…]\s*[»”\"]$")

#: Shapes of lines: a sentence, a label or piece of navigation, a title, a title like a byline, a numbered one, none.
SENTENCE, LABEL, TITLE, BYLINE, NUMBERED, EMPTY = "s", "l", "t", "b", "n", "e"


def shape_of(line: str) -> str:
    """What a line looks like, whatever it says."""
    core = _LEAD.sub("", line)
    bare = core
    while (less := _TAIL.sub("", bare)) != bare:
        bare = less
    words = _WORD.findall(bare)
    if not words:
        return LABEL if line.strip() else EMPTY
    if (_ENDED.search(core) and not core.endswith("...") or _QUOTED_END.search(core)) and len(words) >= 3:
        return SENTENCE
    if _NUMBERED.match(line):
        return NUMBERED
    if _DATE.match(bare) or _PAGES.match(bare) or _SEPARATED.search(bare) or len(words) <= 2:
        return LABEL
    if bare != core and not core.endswith("!"):
        return LABEL
    return BYLINE if _BYLINE.match(" ".join(core.split())) else TITLE


def forms_of(line: str, site: str) -> list[int]:
    """Numbers of a line's letters on its site, of its form with names and numbers left out, and of its label if it has one."""
    plain = _MARKS.sub("", line)
    tokens = _TOKEN.findall(plain)
    loud = plain.isupper()
    form = " ".join("0" if x.isdigit() else x.casefold() if loud or not n or not x[0].isupper() else "X" for n, x in enumerate(tokens))
    letters = "".join(x for x in tokens if not x.isdigit()).casefold().replace("և", "եւ")
    out = [_number(f"{site}\n{letters}"), _number("f" + form.replace("և", "եւ"))]
    label = _LABEL.match(_LEAD.sub("", plain))
    if label and 0 < len(words := _WORD.findall(label[1])) <= LABEL_WORDS:
        out.append(_number("l" + " ".join(words).casefold().replace("և", "եւ")))
    return out


def _number(text: str) -> int:
    return number(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def visible(shapes: str, recurring: dict[int, str]) -> list[bool]:
    """For each line, whether it belongs to the body; empty lines don't.

    recurring: by number of line, "h" for a recurring line that heads a list of links, "r" for any other.
    """
    kinds = list(shapes)
    order = [i for i, k in enumerate(kinds) if k != EMPTY]
    for i, k in recurring.items():
        kinds[i] = k
    out, listing, body = [False] * len(kinds), False, False
    for n, i in enumerate(order):
        kind = kinds[i]
        if kind == SENTENCE:
            out[i], listing, body = True, False, True
        elif kind in ("h", "r", LABEL):
            listing = kind == "h"
        elif kind in (TITLE, BYLINE) and not listing:
            after = kinds[order[n + 1]] if n + 1 < len(order) else None
            before = kinds[order[n - 1]] if n else None
            if after == SENTENCE and (before == SENTENCE and body or before not in (TITLE, BYLINE) and kind == TITLE):
                out[i] = True
    return out


class _Builder(HTMLParser):
    """Renders markup: (line, region) pairs; regions that are not of the body are named, hidden content is dropped."""

    HIDDEN = {"script", "style", "noscript", "template", "head", "svg", "iframe", "select", "object"}
    REGIONS = {"nav", "aside", "footer", "form", "menu", "dialog"}
    BLOCKS = {"p", "div", "section", "article", "main", "ul", "ol", "table", "blockquote", "pre", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "header", "dl"} | REGIONS
    ROWS = {"li", "tr", "dt", "dd", "br", "hr", "caption", "figcaption", "option"}
    VOID = {"br", "hr", "img", "input", "meta", "link", "wbr", "area", "base", "col", "embed", "source", "track"}
    CLOSES = {"li": {"li"}, "p": {"p"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, str | None]] = []
        self.out: list[tuple[str, str | None]] = []
        self.line, self.table = "", []

    def _state(self):
        return (any(h for _, h, _ in self.open), next((r for _, _, r in reversed(self.open) if r), None))

    def _break(self, blank: bool = False):
        hidden, region = self._state()
        if self.line.strip():
            self.out.append((self.line.rstrip(), region))
        self.line = ""
        if blank and self.out and self.out[-1][0]:
            self.out.append(("", region))

    def handle_starttag(self, tag, attrs):
        closes = self.CLOSES.get(tag, set()) | ({"p"} if tag in self.BLOCKS else set())
        while self.open and self.open[-1][0] in closes:
            self.handle_endtag(self.open[-1][0])
        a = dict(attrs)
        style = (a.get("style") or "").replace(" ", "").lower()
        hidden = tag in self.HIDDEN or "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style
        if tag in self.BLOCKS or tag in self.ROWS:
            self._break(tag in self.BLOCKS)
        if tag not in self.VOID:
            self.open.append((tag, hidden, tag if tag in self.REGIONS or a.get("role") in ("navigation", "contentinfo", "complementary") else None))
        if tag == "li":
            self.line = "  " * (max(1, sum(x in ("ul", "ol") for x, _, _ in self.open)) - 1) + "- "
        if tag == "table":
            self.table.append(len(self.out))
        if tag in ("td", "th") and self.line:
            self.line += "\t"

    def handle_endtag(self, tag):
        if tag not in [x for x, _, _ in self.open]:
            return
        if tag in self.BLOCKS or tag in self.ROWS:
            self._break(tag in self.BLOCKS)
        while self.open.pop()[0] != tag:
            pass
        if tag == "table" and self.table:
            start = self.table.pop()
            rows = [x.split("\t") for x, _ in self.out[start:]]
            width = [max((len(r[c].strip()) for r in rows if c < len(r)), default=0) for c in range(max(map(len, rows), default=0))]
            for i, r in enumerate(rows):
                self.out[start + i] = ("  ".join(x.strip().ljust(width[c]) for c, x in enumerate(r)).rstrip(), self.out[start + i][1])

    def handle_data(self, data):
        if self._state()[0]:
            return
        if any(x == "pre" for x, _, _ in self.open):
            *whole, last = data.split("\n")
            for x in whole:
                self.line += x
                self._break()
            self.line += last
            return
        data = re.sub(r"\s+", " ", data)
        self.line += data.lstrip() if not self.line or self.line[-1] in " \t" else data


def render(markup: str) -> list[tuple[str, str | None]]:
    """Visible lines of a page with the region each stands in, None for the body."""
    builder = _Builder()
    builder.feed(markup)
    builder.close()
    builder._break()
    while builder.out and not builder.out[-1][0]:
        builder.out.pop()
    return builder.out


_MARKUP = re.compile(r"<(?:html|body|div|p|article|table|ul)\b[^>]*>", re.I)


def rendered(text: str) -> tuple[str, list[str | None]]:
    """(text, region of each line): markup is rendered and from then on known by its rendered lines; other text stays."""
    if not _MARKUP.search(text):
        return text, [None] * (text.count("\n") + 1)
    lines = render(text)
    return "\n".join(x for x, _ in lines), [r for _, r in lines] or [None]


#: Forms of a line: on its site, with names and numbers left out, its label.
FORMS = 3


def _lines(batches):
    """What the lines of texts are like: shapes, regions of markup, forms by kind (0 for none) and flags.

    own stands for a text's longest line. Flags tell which forms are new in the text and whether a list may follow. A line whose label has a title behind it is a list by itself: none follows.
    """
    for pdf in batches:
        out = []
        for doc, key, site, text in zip(pdf["doc"], pdf["key"], pdf["site"], pdf["text"]):
            text, regions = rendered(text)
            lines = text.split("\n")
            shapes = [shape_of(x) for x in lines]
            order = [i for i, k in enumerate(shapes) if k != EMPTY]
            follows = {i: shapes[j] for i, j in zip(order, order[1:])}
            after = {i: shapes[j] for i, j in zip(order, order[2:])}
            titles = (TITLE, BYLINE, NUMBERED)
            lists = [shapes[i] != SENTENCE and not _LISTED.search(lines[i]) and follows.get(i) in titles and after.get(i) != SENTENCE for i in order]
            forms = [[*forms_of(lines[i], site or ""), 0][:FORMS] for i in order]
            seen: set[int] = set()
            flags = []
            for ok, hs in zip(lists, forms):  # a bit for a list behind, and one for each form that the text has not had yet
                flags.append(ok + sum(2 << k for k, h in enumerate(hs) if h not in seen))
                seen.update(hs)
            outside = "".join("o" if r else "i" for r in regions) if any(regions) else ""
            out.append((doc, key, _number("s" + (site or "")), "".join(shapes), outside, order, *([f[k] for f in forms] for k in range(FORMS)), flags, _number(max(lines, key=len))))
        yield pd.DataFrame(out, columns=["doc", "key", "site", "shapes", "outside", "line", "f0", "f1", "f2", "flags", "own"])


_LISTED = re.compile(r"\S\s*[:՝]\s*\S")
_KIND = "doc bigint, key string, site bigint, shapes string, outside string, line array<int>, f0 array<bigint>, f1 array<bigint>, f2 array<bigint>, flags array<int>, own bigint"


def _around(batches):
    for pdf in batches:
        out = []
        for doc, key, shapes, outside, hits in zip(pdf["doc"], pdf["key"], pdf["shapes"], pdf["outside"], pdf["hits"]):
            recurring: dict[int, str] = {}
            for h in hits if hits is not None else ():
                i, which, heads = int(h) >> 3, int(h) >> 1 & 3, int(h) & 1
                # a label counts only where the line is no sentence
                if which < 2 or shapes[i] != SENTENCE:
                    recurring[i] = "h" if heads and shapes[i] != SENTENCE or recurring.get(i) == "h" else "r"
            seen = visible(shapes, recurring)
            if outside:
                seen = [v and o == "i" for v, o in zip(seen, outside)]
            out.append((doc, key, [i for i, (k, ok) in enumerate(zip(shapes, seen), 1) if k != EMPTY and not ok]))
        yield pd.DataFrame(out, columns=["doc", "key", "around"])


def _exploded(lines: DataFrame, *others: str) -> DataFrame:
    """A row (others..., line, flags, which, h) for each form of each line."""
    one = lines.select(*others, F.explode(F.arrays_zip("line", "f0", "f1", "f2", "flags")).alias("x"))
    rows = one.select(*others, "x.line", "x.flags", F.posexplode(F.array("x.f0", "x.f1", "x.f2")).alias("which", "h"))
    return rows.where("h <> 0")


def recurring_forms(lines: DataFrame) -> DataFrame:
    """(h, heads): the forms that recur, and whether they head lists. Of documents with the same longest line one counts."""
    firsts = cut(lines.groupBy("own").agg(F.min("doc").alias("doc")).select("doc"))
    first = lines.join(broadcast_if_small(firsts, BROADCAST_FORMS), "doc", "left_semi").dropDuplicates(["doc"])
    first = cut(first.select("site", "line", "f0", "f1", "f2", "flags"))
    sites = cut(first.groupBy(F.col("site").alias("of")).agg(F.count(F.lit(1)).alias("docs")))
    # only the forms' numbers are counted first, so that the many that don't recur weigh little
    new = F.getbit("flags", F.col("which") + 1) == 1
    often = cut(_exploded(first).where(new).groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min(ON_SITE, OVER_ALL)).select("h"))
    rows = _exploded(first, "site").where(new).join(broadcast_if_small(often, BROADCAST_FORMS), "h")
    counts = rows.groupBy("h").agg(F.min("which").alias("which"), F.first("site").alias("site"), F.count(F.lit(1)).alias("n"), F.count_if(F.getbit("flags", F.lit(0)) == 1).alias("lists"))
    every = sites.agg(F.sum("docs").alias("every"))
    counts = counts.join(broadcast_if_small(sites, BROADCAST_FORMS), F.col("site") == F.col("of")).crossJoin(F.broadcast(every))
    on_site = (F.col("n") >= ON_SITE) & (F.col("n") >= SHARE_ON_SITE * F.col("docs"))
    over_all = (F.col("n") >= OVER_ALL) & (F.col("n") >= SHARE_OVER_ALL * F.col("every"))
    return counts.where(F.when(F.col("which") == 0, on_site).otherwise(over_all)).select("h", (F.col("lists") >= HEADS * F.col("n")).alias("heads"))


def around(df: DataFrame, key: str, text: str, site: str | None = None) -> DataFrame:
    """(doc, key, around): the numbers of the lines that are not of the body; doc numbers the (key, text). Null texts give no rows."""
    own_site = F.col(site) if site else F.lit(None).cast("string")
    rows = df.where(F.col(text).isNotNull()).select(_doc(key, text), F.col(key).alias("key"), own_site.alias("site"), F.col(text).alias("text"))
    lines = cut(rows.mapInPandas(_lines, _KIND))
    often = cut(recurring_forms(lines))
    at = _exploded(lines, "doc").join(broadcast_if_small(often, BROADCAST_FORMS), "h")
    hit = F.col("line") * 8 + F.col("which") * 2 + F.col("heads").cast("int")
    hits = at.select("doc", hit.alias("hit")).groupBy("doc").agg(F.collect_set("hit").alias("hits"))
    done = lines.select("doc", "key", "shapes", "outside").join(hits, "doc", "left")
    return done.mapInPandas(_around, "doc bigint, key string, around array<int>")


def _doc(key: str, text: str):
    return F.xxhash64(F.col(key), F.col(text)).alias("doc")


@F.pandas_udf(T.StringType())
def _body(texts, around):
    out = []
    for text, gone in zip(texts, around):
        gone, body = set(gone), []
        for i, line in enumerate(rendered(text)[0].split("\n"), 1):
            if line.strip() and i not in gone:
                body.append(line)
            elif not line.strip() and body and body[-1]:
                body.append("")
        out.append("\n".join(body).strip("\n"))
    return pd.Series(out, dtype=object)


def bodies(df: DataFrame, key: str, text: str, site: str | None = None) -> DataFrame:
    """(key, body, around): each distinct (key, text) with its body and the numbers of its lines that are not of the body.

    site names the column of the web site or paper; without one, and for nulls, lines recur only over all documents and
    among those without a site. A null text has a null body and no lines; an empty text an empty body. Null keys are kept.
    Repeated rows count once. Markup is rendered first and numbered by rendered lines.
    """
    found = around(df, key, text, site).select("doc", "around").dropDuplicates(["doc"])
    rows = df.select(_doc(key, text), F.col(key).alias("key"), F.col(text).alias("text")).dropDuplicates(["doc"])
    done = rows.where("text is not null").join(found, "doc").select("key", _body("text", "around").alias("body"), "around")
    return done.unionByName(rows.where("text is null").select("key", F.col("text").alias("body"), F.array().cast("array<int>").alias("around")))
