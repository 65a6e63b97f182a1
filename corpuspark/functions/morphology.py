"""Armenian word forms, transliteration and letters, table-driven so that a language is data."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

# Letters in alphabet order with their Western and Eastern sounds in Latin.
LETTERS = "աբգդեզէըթժիլխծկհձղճմյնշոչպջռսվտրցւփքօֆև"
WESTERN = ("a", "p", "k", "t", "e", "z", "e", "ë", "t", "zh", "i", "l", "kh", "dz", "g", "h", "ts", "gh", "j", "m", "y", "n", "sh", "o", "ch", "b", "ch", "r", "s", "v", "d", "r", "ts", "v", "p", "k", "o", "f", "ev")
EASTERN = ("a", "b", "g", "d", "e", "z", "e", "ë", "t", "zh", "i", "l", "kh", "ts", "k", "h", "dz", "gh", "ch", "m", "y", "n", "sh", "o", "ch", "p", "j", "r", "s", "v", "t", "r", "ts", "v", "p", "k", "o", "f", "ev")
VOWELS = "աեէըիոօ"
HARD = "ղխծձճջչցռքփթ"
# Singular endings of the noun classes by case, endings after the plural's -ներ, and verb endings by class, tense and person.
CASES = ("nominative", "accusative", "genitive_dative", "ablative", "instrumental")
NOUN_CLASSES = {
    "i_class": ("", "", "ի", "է", "ով"),
    "u_class": ("", "", "ի", "է", "ով"),
    "a_class": ("", "", "ան", "անէ", "անով"),
    "o_class": ("", "", "որ", "որէ", "ով"),
}
PLURAL_ENDINGS = ("ներ", "ներ", "ների", "ներէ", "ներով")
PERSONS = ("1sg", "2sg", "3sg", "1pl", "2pl", "3pl")
VERB_CLASSES = {
    "e_class": {"infinitive": "ել", "subjunctive": ("եմ", "ես", "է", "ենք", "եք", "են"), "past_aorist": ("եցի", "եցիր", "եց", "եցինք", "եցիք", "եցին"), "imperfect": ("եի", "եիր", "էր", "եինք", "եիք", "եին"), "imperative_sg": "է", "imperative_pl": "եք", "past_participle": "ել", "present_participle": "ուղ"},
    "a_class": {"infinitive": "ալ", "subjunctive": ("ամ", "աս", "ա", "անք", "աք", "ան"), "past_aorist": ("ացի", "ացիր", "աց", "ացինք", "ացիք", "ացին"), "imperfect": ("աի", "աիր", "ար", "աինք", "աիք", "աին"), "imperative_sg": "ա", "imperative_pl": "աք", "past_participle": "ալ", "present_participle": "ացուղ"},
}
PARTICLES = {"present": "կը", "future": "պիտի", "conditional": "գա"}


def _mapped(word: Column, table: dict[str, str]) -> Column:
    pairs = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in table.items()))
    return F.array_join(F.transform(F.split(word, ""), lambda c: F.coalesce(F.try_element_at(pairs, c), c)), "")


def romanized(word: Column, branch: str = "western") -> Column:
    """Latin letters for Armenian ones; the digraph ու is one sound. Other characters stay."""
    table = dict(zip(LETTERS, WESTERN if branch == "western" else EASTERN))
    return _mapped(F.replace(F.lower(word), F.lit("ու"), F.lit("u")), table)


def difficulty(word: Column, base: float = 1.0, step: float = 0.3) -> Column:
    """Phonetic difficulty between 1 and 5: a base and a step for each hard letter."""
    return F.least(F.lit(5.0), F.greatest(F.lit(1.0), F.lit(base) + F.lit(step) * F.regexp_count(word, F.lit(f"[{HARD}]"))))


def ends_in_vowel(word: Column) -> Column:
    return word.rlike(f"[{VOWELS}]$|ու$")


def definite(word: Column) -> Column:
    """The definite article: ն after a vowel, ը after a consonant."""
    return F.concat(word, F.when(ends_in_vowel(word), F.lit("ն")).otherwise(F.lit("ը")))


def indefinite(word: Column) -> Column:
    return F.concat(word, F.lit(" մը"))


def without_definite(word: Column) -> Column:
    return F.when((F.length(word) > 2) & word.rlike("[նը]$"), F.substring(word, F.lit(1), F.length(word) - 1)).otherwise(word)


def plural(word: Column) -> Column:
    """-եր after one syllable, -ներ after more."""
    one = F.regexp_count(word, F.lit(f"ու|[{VOWELS}]")) <= 1
    return F.concat(word, F.when(one, F.lit("եր")).otherwise(F.lit("ներ")))


def declined(word: Column, noun_class: str = "i_class") -> Column:
    """Array of (number, case, definite, form) of a noun of a class; the nominative has an indefinite form besides."""
    cells = []
    for number, endings in (("singular", NOUN_CLASSES[noun_class]), ("plural", PLURAL_ENDINGS)):
        for case, ending in zip(CASES, endings):
            form = F.concat(word, F.lit(ending))
            kinds = [("bare", form), ("definite", definite(form))] + ([("indefinite", indefinite(form))] if number == "singular" and case == "nominative" else [])
            cells += [F.struct(F.lit(number).alias("number"), F.lit(case).alias("case"), F.lit(kind).alias("kind"), x.alias("form")) for kind, x in kinds]
    return F.array(*cells)


def verb_class(infinitive: Column) -> Column:
    """e, i or a class by the infinitive's ending, null for other words."""
    return F.when(infinitive.endswith("ել"), "e").when(infinitive.endswith("իլ"), "i").when(infinitive.endswith("ալ"), "a")


def conjugated(infinitive: Column, name: str = "e_class", overrides: dict | None = None) -> Column:
    """Array of (tense, person, form) of a verb of a class; person is null for imperatives and participles.

    overrides, by infinitive, tense and person, holds the forms of irregular verbs.
    """
    table, cells = VERB_CLASSES[name], []
    root = F.when(infinitive.endswith(table["infinitive"]), F.substring(infinitive, F.lit(1), F.length(infinitive) - 2)).otherwise(infinitive)

    def cell(tense, person, form):
        for verb, forms in (overrides or {}).items():
            if own := forms.get(tense, {}).get(person):
                form = F.when(infinitive == verb, own).otherwise(form)
        cells.append(F.struct(F.lit(tense).alias("tense"), F.lit(person).cast("string").alias("person"), form.alias("form")))

    for tense in ("subjunctive", "present", "future", "conditional", "past_aorist", "imperfect"):
        for person, ending in zip(PERSONS, table["subjunctive" if tense in PARTICLES else tense]):
            form = F.concat(root, F.lit(ending))
            cell(tense, person, F.concat(F.lit(PARTICLES[tense] + " "), form) if tense in PARTICLES else form)
    for tense in ("imperative_sg", "imperative_pl", "past_participle", "present_participle"):
        cell(tense, None, F.concat(root, F.lit(table[tense])))
    return F.array(*cells)


def stems(word: Column) -> Column:
    """Different stems a word form may have: itself and itself without each case, plural or article ending."""
    endings = ("ներով", "ներէն", "ներուն", "ները", "ներ", "երով", "երէն", "երը", "եր", "ով", "էն", "ին", "ի", "ը", "ն")
    cut = [F.when(word.endswith(e) & (F.length(word) > len(e) + 1), F.substring(word, F.lit(1), F.length(word) - len(e))) for e in endings]
    return F.array_distinct(F.filter(F.array(word, *cut), lambda x: x.isNotNull()))


def word_class(word: Column) -> Column:
    return F.when(verb_class(word).isNotNull(), "verb").when(word.rlike("ութիւն$|ություն$|ութեան$"), "noun").when(word.rlike("ական$|ային$|եղէն$"), "adjective").otherwise("noun")


# What makes a word hard to say, endings that count as affixes, and letters no vowel is written between.
RARE_SOUNDS = {"ժ": 0.3, "ծ": 0.2, "ձ": 0.2, "ց": 0.2, "չ": 0.15, "թ": 0.15, "փ": 0.15, "ք": 0.15}
AFFIXES = ("ագան", "ի", "է", "ներ")
CONSONANTS = "բգդզթժլխծկհձղճմնշչպջռսվտրցւփքֆ"


def noun_difficulty(word: Column, noun_class: str | None = None) -> Column:
    """Difficulty of a noun: a base, its vowel nuclei, its class, and half of its rare sounds and its runs of consonants before a vowel."""
    nuclei = F.greatest(F.lit(1), F.regexp_count(word, F.lit(f"ու|[{VOWELS}]")))
    rare = F.least(F.lit(2.0), sum((w * F.regexp_count(word, F.lit(c)) for c, w in RARE_SOUNDS.items()), F.lit(0.0)))
    runs = F.regexp_extract_all(word, F.lit(f"([{CONSONANTS}յ]{{2,}}+)(?=.)"), F.lit(1))
    clusters = F.least(F.lit(1.5), F.aggregate(runs, F.lit(0.0), lambda a, x: a + 0.1 * F.length(x)))
    return 1.0 + F.least(0.8 * nuclei, F.lit(3.0)) + (0.0 if noun_class in (None, "i_class") else 1.0) + 0.5 * rare + 0.5 * clusters


def affix_score(word: Column) -> Column:
    return sum((F.when(word.endswith(a) & (F.length(word) > len(a)), 0.3).otherwise(0.0) for a in AFFIXES), F.lit(0.0))


def with_schwa(word: Column) -> Column:
    """The unwritten vowel put in: before a leading ս with a stop, and between two consonants that no digraph ends."""
    between = lambda x: F.regexp_replace(x, f"(?<=[{CONSONANTS}])(?<!ու)(?<!իւ)(?=[{CONSONANTS}])", "ը")
    rest = between(F.substring(word, F.lit(3), F.length(word)))
    return F.when(word.rlike("^ս[կպտք]"), F.concat(F.lit("ը"), F.substring(word, 1, 2), rest)).otherwise(between(word))
