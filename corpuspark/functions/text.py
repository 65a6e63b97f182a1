"""Text functions as column expressions; they stay inside the JVM unless they say otherwise."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

#: Word patterns by profile; a new script is one more entry.
PROFILES = {"armenian": "[Ա-Ֆա-և]+", "frequency": "[Ա-Ֆա-ֆ]+", "latin": "[A-Za-zÀ-ÖØ-öø-ÿ]+", "cyrillic": "[А-яЁё]+", "any": r"[\p{L}]+"}
# Letter pairs swapped between the two branches, and classical spellings with their reformed ones.
SWAPPED = ("բպգկդտձծջճվւ", "պբկգտդծձճջւվ")
REFORMED = (("ութիւն", "ություն"), ("եւ", "և"), ("ւ", "վ"))
LIGATURES = (("ﬓ", "մն"), ("ﬔ", "մե"), ("ﬕ", "մի"), ("ﬖ", "վն"), ("ﬗ", "մխ"))
TRACKING = "utm_[a-z]+|fbclid|gclid|mc_cid|mc_eid|ref"


def words(text: Column, profile: str = "armenian", least: int = 2) -> Column:
    """Lower-case words of a script with at least `least` letters; null for null."""
    return F.filter(F.regexp_extract_all(F.lower(text), F.lit(PROFILES[profile]), F.lit(0)), lambda w: F.length(w) >= least)


def collapsed(text: Column) -> Column:
    """Runs of white space as one space, ends trimmed."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def unligatured(text: Column) -> Column:
    for a, b in LIGATURES:
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def casefolded(text: Column) -> Column:
    """Lower case with what folding takes apart: the letter ech-yiwn, the Armenian ligatures and the sharp s as two letters each."""
    out = F.lower(text)
    for a, b in (("և", "եւ"), ("ß", "ss"), *LIGATURES):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def tidy_lines(text: Column) -> Column:
    """Horizontal white space collapsed, line ends stripped, newlines kept."""
    return F.regexp_replace(F.regexp_replace(text, r"(?U)[^\S\n]+", " "), r"(?m) +$", "")


def without_junk_lines(text: Column) -> Column:
    """Lines without a letter or digit go, empty lines stay."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: (F.trim(x) == "") | x.rlike(r"[\p{L}\p{N}_]")), "\n")


def without_foreign(text: Column) -> Column:
    """Latin and Arabic fragments go: in brackets, in guillemets, then letter by letter; emptied brackets go too."""
    foreign = r"A-Za-zÀ-ɏ؀-ۿ"
    out = F.regexp_replace(text, rf"\([^()]*[{foreign}][^()]*\)", "")
    out = F.regexp_replace(out, rf"«[^«»]*[{foreign}][^«»]*»", "")
    out = F.regexp_replace(out, rf"[{foreign}]+", "")
    return F.regexp_replace(F.regexp_replace(out, r"\(\s*\)", ""), r"«\s*»", "")


def normalized(text: Column) -> Column:
    return F.trim(without_junk_lines(tidy_lines(without_foreign(nfc(text)))))


def _normalizer(form: str):
    @F.pandas_udf(T.StringType())
    def run(texts):
        return texts.str.normalize(form)

    return run


def nfc(text: Column) -> Column:
    """Canonical composition; only texts that hold combining or decomposable characters travel to Python."""
    odd = text.rlike(r"[\p{M}̀-̈́ΩKÅ豈-﫿יִ-פֿ]")
    return F.coalesce(_normalizer("NFC")(F.when(odd, text)), text)


def nfkc(text: Column) -> Column:
    """Compatibility composition; only texts with characters outside plain letters, digits and punctuation travel to Python."""
    odd = text.rlike("[^\\x00-\\x7FÀ-žԱ-ֆ։֊А-яЁё«»“”‘’–—]")
    return F.coalesce(_normalizer("NFKC")(F.when(odd, text)), text)


def content_hash(text: Column) -> Column:
    """SHA-256 of the NFKC text with white space collapsed and trimmed."""
    return F.sha2(collapsed(nfkc(text)), 256)


def count_of(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def character_classes(text: Column) -> Column:
    """Counts of letters and signs by class, white space left out; each character counts in the first class that has it."""
    armenian, marks = r"Ա-և", r"։֊"
    latin, digits, common = r"A-Za-zÀ-ɏ", r"\p{Nd}", r"""\.,;:!?\-"'()\[\]{}/@#$%^&*+=~`|\\_<>"""
    seen, out = "", []
    for name, chars in (("armenian_letters", armenian), ("armenian_punct", marks), ("latin", latin), ("digits", digits), ("common_punct", common)):
        out.append(count_of(text, f"[{chars}]").alias(name))
        seen += chars
    return F.struct(*out, F.regexp_count(text, F.lit(rf"[^\s{seen}]")).alias("other"))


def share(part: Column, whole: Column) -> Column:
    """part / whole, 0 where whole is 0."""
    return F.when(whole > 0, part / whole).otherwise(0.0)


def sentences(text: Column, variant: str = "marks") -> Column:
    """Sentences by one of four rules: marks, spaced, scan, lines."""
    pattern = {"marks": "[։?!:]+", "spaced": r"(?<=[։.!?])\s+", "scan": r"(?<=[.!?։])", "lines": r"[։?!:\n]+"}[variant]
    return F.filter(F.transform(F.split(text, pattern), lambda x: F.trim(x)), lambda x: x != "")


def bound(value: Column, use) -> Column:
    """use(value), with the value made once however often it is used, also within lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def shingles(text: Column, k: int = 5) -> Column:
    """Distinct runs of k characters; a shorter text is its own, an empty one has none. The characters are cut once, so long texts cost no more a run."""
    runs = bound(F.split(text, ""), lambda c: F.transform(F.sequence(F.lit(1), F.greatest(F.size(c) - k + 1, F.lit(1))), lambda i: F.array_join(F.slice(c, i, k), "")))
    return F.when(text == "", F.array().cast("array<string>")).when(F.length(text) < k, F.array(text)).otherwise(F.array_distinct(runs))


def word_shingles(tokens: Column, k: int = 5) -> Column:
    """Distinct 64-bit hashes of runs of k words; a shorter text is its own."""
    n = F.size(tokens)
    runs = F.transform(F.sequence(F.lit(1), F.greatest(n - k + 1, F.lit(1))), lambda i: F.xxhash64(F.array_join(F.slice(tokens, i, F.lit(k)), " ")))
    return F.when(n > 0, F.array_distinct(runs)).otherwise(F.array().cast("array<bigint>"))


def other_branch(text: Column) -> Column:
    """Letter pairs of the branches swapped; doing it twice gives the text back."""
    return F.translate(text, *SWAPPED)


def reformed(text: Column) -> Column:
    for a, b in REFORMED:
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def classical(text: Column) -> Column:
    for a, b in REFORMED:
        text = F.replace(text, F.lit(b), F.lit(a))
    return text


def plain_url(url: Column) -> Column:
    """Scheme and host in lower case, no fragment, no tracking parameters, no slash at the end."""
    out = F.regexp_replace(F.trim(url), "#.*$", "")
    out = F.regexp_replace(F.regexp_replace(out, f"(?i)(?<=[?&])(?:{TRACKING})=[^&]*(?:&|$)", ""), "[?&]+$", "")
    head = F.regexp_extract(out, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", 0)
    return F.regexp_replace(F.concat(F.lower(head), F.substring(out, F.length(head) + 1, F.length(out))), "/+$", "")


def host(url: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1)), r"^www\.", "")


def article_like(url: Column) -> Column:
    """Whether a URL looks like an article: four slashes and no listing segment."""
    banned = r"/(?:tag|tags|category|author|page|search|login|feed|wp-admin|about|contact)(?:/|$)"
    return (F.length(url) - F.length(F.replace(url, F.lit("/"))) >= 4) & ~url.rlike(banned)


def without_tags(markup: Column) -> Column:
    return collapsed(F.regexp_replace(markup, r"(?is)<(script|style)\b.*?</\1>|<[^>]+>", " "))


def wikitext(raw: Column, depth: int = 4) -> Column:
    """Prose of wiki markup: comments, references, tables, templates nested up to `depth`, links, headings and tags go."""
    out = F.regexp_replace(raw, r"(?s)<!--.*?-->|<ref[^>]*/>|<ref.*?</ref>|\{\|.*?\|\}", "")
    for _ in range(depth):
        out = F.regexp_replace(out, r"\{\{[^{}]*\}\}", "")
    out = F.regexp_replace(out, r"(?i)\[\[(?:file|image|category|Պատկեր|Կատեգորիա)[^\[\]]*(?:\[\[[^\]]*\]\][^\[\]]*)*\]\]", "")
    out = F.regexp_replace(out, r"\[\[(?:[^|\]]*\|)?([^\]]*)\]\]", "$1")
    out = F.regexp_replace(out, r"\[https?://\S+\s?([^\]]*)\]", "$1")
    out = F.regexp_replace(out, r"(?m)^=+\s*(.*?)\s*=+\s*$", "$1")
    out = F.regexp_replace(F.regexp_replace(out, r"'{2,}", ""), r"<[^>]+>", "")
    for name, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        out = F.replace(out, F.lit(name), F.lit(sign))
    return F.trim(F.regexp_replace(out, r"\n{3,}", "\n\n"))


def redirects(raw: Column) -> Column:
    return raw.rlike(r"(?iu)^\s*#(?:redirect|վերաուղղում)(?![\p{L}])")


def scan_cleaned(raw: Column) -> Column:
    """Page markers, control characters and repeated empty lines of scanned text go."""
    out = F.regexp_replace(raw, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")
    out = F.regexp_replace(out, r"(?m)^[ \t]*[-—–\[(]*[ \t]*\d{1,4}[ \t]*[-—–\])]*[ \t]*$\n?", "")
    return F.trim(F.regexp_replace(out, r"\n{3,}", "\n\n"))


def name_key(name: Column) -> Column:
    """A person's name without marks, in lower case, single-spaced."""
    return F.lower(collapsed(F.regexp_replace(name, r"[^\p{L}\s.-]", "")))


def title_issues(title: Column, least: int = 3, most: int = 160, ratio: float = 0.6) -> Column:
    """Reasons that speak against a title; an empty array for a plausible one."""
    text = F.coalesce(F.trim(title), F.lit(""))
    letters = count_of(text, r"\p{L}")
    checks = [
        (F.length(text) < least, "too_short"),
        (F.length(text) > most, "too_long"),
        (share(count_of(text, "[Ա-և]"), letters) < ratio, "low_script_ratio"),
        (count_of(text, r"\d") > F.length(text) / 2, "mostly_digits"),
        (text.rlike(r"https?://|www\."), "has_url"),
    ]
    return F.filter(F.array(*[F.when(c, F.lit(x)) for c, x in checks]), lambda x: x.isNotNull())


def _line_ratio(line: Column) -> Column:
    return share(count_of(line, "[Ա-և]"), count_of(line, r"\p{L}"))


def armenian_part(text: Column) -> Column:
    """One half of a text's lines if only that is Armenian, else the lines that are."""
    lines = F.split(text, "\n")
    half = F.greatest(F.floor(F.size(lines) / 2).cast("int"), F.lit(1))
    first = F.array_join(F.slice(lines, F.lit(1), half), "\n")
    second = F.array_join(F.slice(lines, half + 1, F.size(lines)), "\n")
    kept = F.array_join(F.filter(lines, lambda x: (F.trim(x) == "") | (_line_ratio(x) >= 0.5)), "\n")
    a, b = _line_ratio(first), _line_ratio(second)
    return F.when((a >= 0.5) & (b < 0.2), first).when((b >= 0.5) & (a < 0.2), second).otherwise(kept)


def enough_armenian(part: Column, least: int = 100, ratio: float = 0.35) -> Column:
    """The part trimmed, null if it is too short or too mixed."""
    return F.when((F.length(part) >= least) & (_line_ratio(part) >= ratio), F.trim(part))


def armenian_content(text: Column, least: int = 100, ratio: float = 0.35) -> Column:
    """The Armenian part of a text, null if too short or too mixed. Over many texts take the two steps apart, so that the first runs once."""
    return enough_armenian(armenian_part(text), least, ratio)


def bilingual(text: Column, least: int = 100) -> Column:
    """Struct of both sides of a text in two scripts, by lines; empty lines go to both. linking_id is the first 16 hex of the text's SHA-256."""
    lines = F.split(text, "\n")
    own = F.array_join(F.filter(lines, lambda x: (F.trim(x) == "") | (_line_ratio(x) >= 0.5)), "\n")
    other = F.array_join(F.filter(lines, lambda x: (F.trim(x) == "") | (_line_ratio(x) < 0.5)), "\n")
    both = (F.length(F.trim(own)) >= least) & (F.length(F.trim(other)) >= least)
    return F.struct(both.alias("is_bilingual"), own.alias("own"), other.alias("other"), F.round(_line_ratio(text), 4).alias("ratio"), F.substring(F.sha2(text, 256), 1, 16).alias("linking_id"))


def tri_state(text: Column, score: Column, western: float = 5.0) -> Column:
    """Whether a text is Western: true or false with enough Armenian script, null without."""
    return F.when(_line_ratio(text) < 0.35, F.lit(None).cast("boolean")).otherwise(score >= western)


def acceptable_layer(text: Column, chars: int = 80, ratio: float = 0.15, newlines: int = 1) -> Column:
    """Whether a page's own text layer will do instead of recognition."""
    enough = (F.length(F.trim(text)) >= chars) & (_line_ratio(text) >= ratio) & (count_of(text, "\n") >= newlines)
    return F.coalesce(enough, F.lit(False))


def scan_punctuation(text: Column) -> Column:
    """Spaces before signs go, runs of signs shrink, a colon after an Armenian letter becomes the full stop."""
    out = F.regexp_replace(text, r"[ \t]+([,.։՝;!?])", "$1")
    out = F.regexp_replace(out, r"([,։՝;])\1+", "$1")
    return F.regexp_replace(out, r"(?<=[Ա-և]):(?=\s|$)", "։")


def scan_quality(text: Column) -> Column:
    """Share of letters in words of two letters and more among the characters that aren't white space."""
    inside = F.length(F.regexp_replace(text, r"(?<!\p{L})\p{L}(?!\p{L})|[^\p{L}]", ""))
    return F.round(share(inside, count_of(text, r"\S")), 4)


def page_title(markup: Column, url: Column) -> Column:
    """First level-one heading, else the title, else the URL."""
    inner = lambda tag: F.nullif(without_tags(F.regexp_extract(markup, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>", 1)), F.lit(""))
    return F.coalesce(inner("h1"), inner("title"), url)


def page_links(markup: Column) -> Column:
    """Different link targets of a page, in plain form, in order."""
    found = F.regexp_extract_all(markup, F.lit(r"""(?i)<a\b[^>]*\bhref\s*=\s*["']([^"'#\s]+)"""), F.lit(1))
    return F.array_distinct(F.transform(found, lambda x: plain_url(x)))


def in_domains(name: Column, domains: list[str]) -> Column:
    out = F.lit(False)
    for d in domains:
        out |= (name == d) | name.endswith("." + d)
    return out


def stated_authors(text: Column) -> Column:
    """Names that a text states as its author's."""
    name = r"((?:[Ա-ՖA-Z][ա-ևa-z.]*\.?\s+){1,2}[Ա-ՖA-Z][ա-ևa-z]+)"
    found = [F.regexp_extract_all(text, F.lit(p + name), F.lit(1)) for p in (r"Հեղինակ[՝:]\s*", r"Գր(?:ած|եց)[՝:]\s*", r"(?i:author|by)[: ]\s*")]
    return F.array_distinct(F.concat(*found))


def author_id(name: Column) -> Column:
    """First four letters of the last name and eight hex of the whole name's MD5."""
    key = name_key(name)
    return F.concat(F.substring(F.element_at(F.split(key, " "), -1), 1, 4), F.lit("_"), F.substring(F.md5(key), 1, 8))


def first_tokens(text: Column, n: int) -> Column:
    """Whole sentences from the start with at most n words together; the first n words where the first sentence has more."""
    parts = F.split(text, r"(?<=[։.!?])\s+")
    count = lambda x: F.size(F.split(F.trim(x), r"\s+"))
    sums = F.aggregate(
        parts,
        F.struct(F.lit(0).alias("n"), F.array().cast("array<string>").alias("out"), F.lit(False).alias("full")),
        lambda a, x: F.when(~a["full"] & (a["n"] + count(x) <= n), F.struct((a["n"] + count(x)).alias("n"), F.concat(a["out"], F.array(x)).alias("out"), F.lit(False).alias("full"))).otherwise(
            F.struct(a["n"].alias("n"), a["out"].alias("out"), F.lit(True).alias("full"))
        ),
        lambda a: a["out"],
    )
    return F.when(F.size(sums) > 0, F.array_join(sums, " ")).otherwise(F.array_join(F.slice(F.split(F.trim(text), r"\s+"), 1, n), " "))


# Titles before a name, and words that no name has.
HONORIFICS = ("տէր", "տեր", "դոկտ", "տքթ", "դոկտոր", "վրդ", "mr", "mrs", "ms", "dr")
NOT_NAMES = (
    "այս", "այն", "այդ", "ասիկա", "անիկա", "ադիկա", "ամէն", "ամեն", "բոլոր", "շատ", "մէկ", "մեկ", "տղան", "տղաս", "հայրը", "մայրը", "եկեղեցին", "գիրքը", "վէպը", "վեպը", "պատմուածքը", "պատմվածքը", "բանաստեղծութիւնը", "բանաստեղծությունը",
    "ուսուցիչը", "ուսուցիչներուն", "ժողովուրդը", "քաղաքը", "գիւղը", "գյուղը", "աշխարհը", "կեանքը", "կյանքը", "ժամանակը", "տունը", "կինը", "մարդը", "դուստրը", "որդին", "եղբայրը", "քոյրը", "քույրը", "մեր", "ձեր", "անոր", "անոնք", "մենք", "դուք", "ինք", "ինքն", "որոնք", "որոնց",
)
AROUND_NAMES = " \"'«»“”[]{}()<>.,;:!?։՝-"


def plausible_name(name: Column) -> Column:
    """Whether a text can be a person's name: up to four capitalised words of one script, titles aside, and at least two of them."""
    clean = F.trim(F.regexp_replace(F.trim(F.regexp_replace(F.coalesce(name, F.lit("")), r"[\r\n\t]+", " "), F.lit(AROUND_NAMES)), r"\s+", " "))

    def kinds(parts: Column) -> Column:
        def kind(token: Column) -> Column:
            bare = F.lower(F.regexp_replace(token, r"[^\p{L}\p{N}]+", ""))
            own = F.trim(token, F.lit(AROUND_NAMES))
            word = own.rlike(r"^(?:[Ա-Ֆ][^A-Za-z\d]*|[A-Z][^Ա-Ֆա-ֆ\d]*)$") & ~F.regexp_replace(own, "[A-Za-zԱ-Ֆա-ֆ]", "").rlike(r"\p{L}") & (F.length(own) > 1)
            return (
                F.when(bare == "", "bad").when(bare.isin(*HONORIFICS), "title").when(bare.isin(*NOT_NAMES), "bad")
                .when(F.length(bare) == 1, F.when(token.endswith("."), "initial").otherwise("bad")).when(word, "word").otherwise("bad")
            )

        return F.transform(parts, kind)

    found = kinds(F.split(clean, " "))
    many = lambda k: F.size(F.filter(found, lambda x: x == k))
    return F.length(clean).between(3, 40) & (F.size(found) <= 4) & (many("bad") == 0) & (many("word") >= 2)


def page_language(armenian: Column, latin: Column, strict: float = 0.9, least: float = 0.35) -> Column:
    """The recognition language of a page by its shares of two scripts: one that dominates, else the greater if it is enough, else both."""
    return (
        F.when(armenian >= strict, "hye").when(latin >= strict, "eng").when((latin > armenian) & (latin >= least), "eng").when((armenian > latin) & (armenian >= least), "hye").otherwise("hye+eng")
    )
