"""Per-document linguistic metrics over an array of words."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Word endings and separate words that tell the branches apart.
SUFFIXES = {"em": "եմ", "im": "իմ", "um": "ում", "ean": "եան", "aran": "արան", "akan": "ական", "utyun": "ութիւն", "el": "ել", "il": "իլ"}
PARTICLES = {"gu": "կը", "bidi": "պիտի"}
CLASSICAL = ("ո", "իւ", "եա", "եօ", "էա", "էյ", "իա", "ոյ", "այ", "աւ")
NOT_LETTER = r"(?![԰-֏])"
REFORMED = ("ա" + NOT_LETTER, "թյուն" + NOT_LETTER, "յան" + NOT_LETTER, "ե")
VOWELS = "աեէըիոօ"


def ratio(a: Column, b: Column, digits: int) -> Column:
    return F.round(F.when(b > 0, a / b).otherwise(0.0), digits)


def mean(x: Column, digits: int) -> Column:
    """Rounded mean of a group, the same for any order and split of its rows.

    Values below 2^22 are summed as whole numbers in two parts, each exact to 2^-83; a group with other values has a plain average.
    Rounding is DuckDB's, of the double times 10^digits: F.round takes the digits as printed, so 0.00015 up, where the double is less.
    """
    y = F.when(F.abs(x) < 2.0**22, x * 2.0**30)
    high, low = F.rint(y), F.rint((y - F.rint(y)) * 2.0**53)
    total = lambda part: F.sum(part.cast("decimal(16,0)")).cast("double")
    exact = (total(high) + total(low) / 2.0**53) / 2.0**30 / F.count(x)
    m = F.when(F.max(F.abs(x)) < 2.0**22, exact).otherwise(F.avg(x))
    rounded = F.round(m * 10.0**digits) / 10.0**digits
    return F.when(F.abs(rounded) < float("inf"), rounded).otherwise(m)


def how_many(words: Column, test) -> Column:
    return F.size(F.filter(words, test))


def _ends(suffix: str):
    return lambda w: F.endswith(w, F.lit(suffix))


def _is(word: str):
    return lambda w: w == F.lit(word)


def ttr(words: Column) -> Column:
    """Different words per word."""
    return ratio(F.size(F.array_distinct(words)), F.size(words), 4)


def sttr(words: Column, window: int = 100) -> Column:
    """Mean share of different words over whole windows; that of all words where there is no whole window."""
    n = F.size(words)
    whole = F.floor(n / window).cast("int")
    parts = F.transform(F.sequence(F.lit(0), F.greatest(whole - 1, F.lit(0))), lambda i: F.size(F.array_distinct(F.slice(words, (i * window + 1).cast("int"), window))) / F.lit(float(window)))
    total = F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)
    return F.round(F.when(whole > 0, total / whole).when(n > 0, F.size(F.array_distinct(words)) / n).otherwise(0.0), 4)


def counts(words: Column) -> Column:
    """Occurrences of each different word, as an array."""
    runs = F.aggregate(
        F.sort_array(words),
        F.struct(F.lit(None).cast("string").alias("w"), F.lit(0).alias("n"), F.array().cast("array<int>").alias("out")),
        lambda a, x: F.when(a["w"] == x, F.struct(x.alias("w"), (a["n"] + 1).alias("n"), a["out"].alias("out"))).otherwise(
            F.struct(x.alias("w"), F.lit(1).alias("n"), F.when(a["n"] > 0, F.concat(a["out"], F.array(a["n"]))).otherwise(a["out"]).alias("out"))
        ),
        lambda a: F.when(a["n"] > 0, F.concat(a["out"], F.array(a["n"]))).otherwise(a["out"]),
    )
    return runs


def yule(words: Column) -> Column:
    """Yule's K over squared counts less the number of different words, at least 0."""
    c = counts(words)
    squares = F.aggregate(c, F.lit(0.0), lambda a, x: a + x * x)
    n = F.size(words)
    return F.round(F.when(n > 0, F.greatest(F.lit(0.0), 10000.0 * (squares - F.size(c)) / (n * n))).otherwise(0.0), 2)


def entropy(words: Column) -> Column:
    """Shannon entropy of the word distribution in bits."""
    n = F.size(words)
    return F.round(F.aggregate(counts(words), F.lit(0.0), lambda a, x: a - (x / n) * F.log2(x / n)), 4)


def syllables(word: Column) -> Column:
    """Vowel nuclei, the digraph counting once, at least one."""
    return F.greatest(F.lit(1), F.regexp_count(word, F.lit(f"ու|[{VOWELS}]")))


def suffix_counts(words: Column) -> list[Column]:
    out = [how_many(words, _ends(s)).alias(f"suffix_{k}") for k, s in SUFFIXES.items()]
    out.append(how_many(words, lambda w: F.endswith(w, F.lit("ան")) & ~F.endswith(w, F.lit("եան"))).alias("suffix_an"))
    out += [how_many(words, _is(s)).alias(f"prefix_{k}") for k, s in PARTICLES.items()]
    out.append(how_many(words, lambda w: F.startswith(w, F.lit("չ")) & (F.length(w) > 1)).alias("prefix_ch"))
    return out


def orthography(text: Column, digits: int = 2) -> list[Column]:
    """Marker counts of the classical and the reformed spelling, and their ratio."""
    count = lambda ps: sum((F.regexp_count(text, F.lit(p)) for p in ps), F.lit(0))
    c, r = count(CLASSICAL), count(REFORMED)
    return [c.alias("classical"), r.alias("reformed"), F.round(c / F.greatest(r, F.lit(1)), digits).alias("ratio")]


def contamination(words: Column) -> Column:
    """Share of -um among -em and -um forms."""
    em, um = (how_many(words, _ends(s)) for s in ("եմ", "ում"))
    return ratio(um, em + um, 4)


# Words that open a clause, pronouns, and the marks of the two spellings that a plain score compares.
SUBORDINATORS = ("որ", "ինչ", "եթե", "եթէ", "երբ", "ուր", "մինչ", "թէ", "թե", "ուստի")
PRONOUNS = ("ես", "դու", "նա", "ան", "ինք", "մենք", "դուք", "նրանք", "այն", "սա")
SPELLING_CLASSICAL = ("իւ", "եան", "ուտյուն", "եւ", "ւ")
SPELLING_REFORMED = ("յու", "յան", "ություն", "և", "վ")
STAGING_CLASSICAL = ("իւ", "եա", "եօ")
STAGING_REFORMED = ("ություն",)


def occurrences(text: Column, patterns) -> Column:
    return sum((F.regexp_count(text, F.lit(p)) for p in patterns), F.lit(0))


def syntax(text: Column, words: Column) -> list[Column]:
    """Words a sentence, clauses a sentence and the Flesch-Kincaid grade by vowel nuclei; a text without sentences counts as one."""
    sentences = F.greatest(F.lit(1), F.size(F.filter(F.split(text, "[։?!:]+"), lambda x: x.rlike("[Ա-Ֆա-և]{2,}"))))
    n = F.size(words)
    openers = how_many(F.regexp_extract_all(text, F.lit("[\u0531-\u0587]+"), F.lit(0)), lambda w: w.isin(*SUBORDINATORS))
    nuclei = F.aggregate(words, F.lit(0), lambda a, w: a + syllables(w))
    a_word = F.when(n > 0, nuclei / n).otherwise(2.0)
    return [
        F.round(n / sentences, 2).alias("sentence_length"),
        F.round(1 + openers / sentences, 2).alias("clauses"),
        F.round(0.39 * n / sentences + 11.8 * a_word - 15.59 + 1e-9, 2).alias("grade"),
    ]


def suffix_shares(words: Column) -> list[Column]:
    """The suffix and prefix counters as shares of the words; the elided particle never stands as a word of its own."""
    n = F.size(words)
    elided = how_many(words, lambda w: F.startswith(w, F.lit("կ՚"))).alias("prefix_g_elided")
    return [ratio(c, n, 6).alias(name) for c, name in zip([*suffix_counts(words), elided], [*(f"suffix_{k}" for k in SUFFIXES), "suffix_an", *(f"prefix_{k}" for k in PARTICLES), "prefix_ch", "prefix_g_elided"])]


def suffix_words(words: Column) -> list[Column]:
    """The words that the branch suffixes are counted in, in order."""
    ends = lambda s: F.filter(words, _ends(s))
    an = F.filter(words, lambda w: F.endswith(w, F.lit("ան")) & ~F.endswith(w, F.lit("եան")))
    return [ends("եան").alias("ean"), an.alias("an"), ends("արան").alias("aran"), ends("ական").alias("akan"), ends("ութիւն").alias("utyun")]


def purity(words: Column) -> Column:
    """Struct of a purity between 0 and 1 and what lowers it: many -um forms, mixed forms, few different words."""
    em, um = (how_many(words, _ends(s)) for s in ("եմ", "ում"))
    mixed, variety = ratio(um, em + um, 4), ttr(words)
    many = F.when(um > 2, 0.1 * F.least(F.lit(1.0), um / 10)).otherwise(0.0)
    score = 1.0 - many - F.when(mixed > 0.05, 0.05).otherwise(0.0) - F.when(variety < 0.5, 0.05).otherwise(0.0)
    issues = [F.when(um > 2, F.lit("um_forms")), F.when(mixed > 0.05, F.lit("code_switching")), F.when(variety < 0.5, F.lit("low_diversity"))]
    return F.struct(F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), 4).alias("purity"), F.array_join(F.filter(F.array(*issues), lambda x: x.isNotNull()), ",").alias("issues"))


def staging(text: Column, words: Column) -> list[Column]:
    """The staging variants: Yule's K over squared counts less words, vowels a word, and three marks against one."""
    c = counts(words)
    squares, n = F.aggregate(c, F.lit(0.0), lambda a, x: a + x * x), F.size(words)
    vowels = F.aggregate(words, F.lit(0), lambda a, w: a + F.greatest(F.lit(1), F.regexp_count(w, F.lit(f"[{VOWELS}]"))))
    classical, reformed = occurrences(text, STAGING_CLASSICAL), occurrences(text, STAGING_REFORMED)
    return [
        F.round(F.when(n > 0, 10000.0 * (squares - n) / (F.lit(1.0) * n * n)).otherwise(0.0), 2).alias("yule_staging"),
        F.round(F.when(n > 0, vowels / n).otherwise(1.0), 6).alias("vowels_a_word"),
        F.round(F.when(reformed > 0, classical / reformed).otherwise(classical.cast("double")), 4).alias("ratio_staging"),
    ]


def spelling_score(text: Column) -> Column:
    """Share of classical marks among those of both spellings, a half where there are none."""
    c, r = occurrences(text, SPELLING_CLASSICAL), occurrences(text, SPELLING_REFORMED)
    return F.round(F.when(c + r > 0, c / (c + r)).otherwise(0.5), 6)
