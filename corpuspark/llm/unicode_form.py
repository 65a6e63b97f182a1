"""One form for text that looks the same.

Compatibility normalisation and composition, full case folding, plain spaces, and removal of default-ignorable
characters; letters of another script inside a word go back to the word's own script, and a colon that stands as
the Armenian full stop becomes one. Signs that look different from their plain spelling keep their look.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import DataFrame, functions as F, types as T

# Unicode's default-ignorable code points, spaces other than the plain one, combining diacritics,
# width and presentation forms.
INVISIBLE = "­͏؜ᅟᅠ឴឵᠋-᠏​-‏‪-‮⁠-⁯ㅤ︀-️﻿ﾠ￰-￸"
SPACES = "   -   　"
ACCENTS = "̀-ͯ"
FORMS = "ﬀ-ﬆﬓ-ﬗיִ-﷿ﹰ-ﻼ！-ﾟﾡ-￮"
# Letters that look alike, by Latin, Cyrillic, Greek and Armenian; "-" where a script has none.
ALIKE = """
a а α -  c с ϲ -  d ԁ - -  e е - -  g - - ց  h һ - հ  i і ι -  j ј ϳ յ  k к κ -  n - - ո  o о ο օ  p р ρ -
q ԛ - զ  s ѕ - -  u - υ ս  v ѵ ν -  w ԝ ω -  x х χ -  y у γ -
A А Α -  B В Β -  C С Ϲ -  E Е Ε -  H Н Η -  I І Ι -  J Ј Ϳ -  K К Κ -  L - - Լ  M М Μ -  N - Ν -  O О Ο Օ
P Р Ρ -  S Ѕ - Տ  T Т Τ -  U - - Ս  V Ѵ - -  X Х Χ -  Y У Υ -  Z - Ζ -
"""
SCRIPTS = ("Latin", "Cyrillic", "Greek", "Armenian")
LETTERS = {"Latin": "A-Za-zÀ-ÖØ-öø-ɏ", "Cyrillic": "Ѐ-ԯ", "Greek": "Ͱ-Ͽ", "Armenian": "Ա-Ֆա-և"}

_EMOJI = "[☀-➿⬀-⯿\U0001f000-\U0001faff⃣️]"
_KEPT = re.compile(f"(?<={_EMOJI})[‍️](?={_EMOJI}|\\W|$)|(?<=[0-9#*])️(?=⃣)")
_INVISIBLE = re.compile(f"[{INVISIBLE}\U000e0000-\U000e0fff]+")
_SPACES = re.compile(f"[{SPACES}]")
_ACCENTED = re.compile(f".[{ACCENTS}]+", re.S)
_FORMS = re.compile(f"[{FORMS}\U0001d400-\U0001d7ff]+")
_COLON = re.compile(r"(?<=[Ա-և\d»)’”]):(?=\s|$)")
_LETTER = re.compile(r"[^\W\d_]")


def _mixture() -> str:
    """A pattern of two adjacent letters of different scripts."""
    every = "".join(LETTERS.values())
    return "|".join(f"[{own}](?=[{every}])(?![{own}])" for own in LETTERS.values())


_MIXED = _mixture()
_WORD = re.compile("[" + "".join(LETTERS.values()) + "]+")
_MIXED_RE = re.compile(_MIXED)
_ODD = re.compile(f"[{INVISIBLE}{SPACES}{ACCENTS}{FORMS}ßŉſǰςİ\U0001d400-\U0001d7ff\U000e0000-\U000e0fff]")
_NOT_OF = {s: re.compile("[" + "".join(x for t, x in LETTERS.items() if t != s) + "]") for s in LETTERS}


def suspect(text: str) -> bool:
    """Whether a text may need more than case folding: an odd character, a word of two scripts, or a colon as full stop."""
    if _ODD.search(text) or ":" in text and _COLON.search(text):
        return True
    first = _WORD.search(text)
    return bool(first) and bool(_NOT_OF[script_of(first[0][0]) or "Latin"].search(text)) and bool(_MIXED_RE.search(text))


def _alike() -> dict[str, dict[str, str]]:
    """Letter -> the letter that looks like it in each script."""
    out: dict[str, dict[str, str]] = {}
    cells = ALIKE.split()
    for i in range(0, len(cells), 4):
        row = {script: x for script, x in zip(SCRIPTS, cells[i : i + 4]) if x != "-"}
        for x in row.values():
            out[x] = row
    return out


_ALIKE = _alike()


def script_of(letter: str) -> str | None:
    """One of SCRIPTS, or None for other characters."""
    o = ord(letter)
    if 0x531 <= o <= 0x587:
        return "Armenian"
    if 0x400 <= o <= 0x52F:
        return "Cyrillic"
    if 0x370 <= o <= 0x3FF:
        return "Greek"
    if o < 0x250 and letter.isalpha():
        return "Latin"
    return None


def _own_script(word: str, around: str) -> str:
    """The word with each stray letter in the script that most of the word has no substitute in, or that stands around it."""
    scripts = [script_of(x) for x in word]
    if len(set(scripts)) < 2:
        return word
    fixed, total = dict.fromkeys(SCRIPTS, 0), dict.fromkeys(SCRIPTS, 0)
    for letter, script in zip(word, scripts):
        total[script] += 1
        fixed[script] += letter not in _ALIKE
    target = max((s for s in SCRIPTS if total[s]), key=lambda s: (fixed[s], total[s], s == around))
    return "".join(x if s == target else _ALIKE.get(x, {}).get(target, x) for x, s in zip(word, scripts))


_BY_SCRIPT = {s: re.compile(f"[{x}]") for s, x in LETTERS.items()}


def _main_script(text: str) -> str:
    """The script that most letters of the whole text are in."""
    return max(SCRIPTS, key=lambda s: len(_BY_SCRIPT[s].findall(text)))


def spelled(text: str) -> str:
    """The text in ordinary characters, its case and look kept; equal to the argument if nothing is out of the ordinary."""
    if not suspect(text):
        return text
    kept = {m.start() for m in _KEPT.finditer(text)} if "‍" in text or "️" in text else ()
    if kept:
        text = "".join(x if i in kept or not _INVISIBLE.match(x) else "" for i, x in enumerate(text))
    else:
        text = _INVISIBLE.sub("", text)
    text = _SPACES.sub(" ", text)
    text = _FORMS.sub(lambda m: unicodedata.normalize("NFKC", m[0]), text)
    main = _main_script(text)
    # the base letter under an accent goes to its word's script before the two are composed
    bare = _WORD.sub(lambda m: _own_script(m[0], main), text)
    if re.search(f"[{ACCENTS}]", bare):
        bare = _ACCENTED.sub(lambda m: unicodedata.normalize("NFC", m[0]), bare)
        bare = _WORD.sub(lambda m: _own_script(m[0], main), bare)
    if ":" in bare:
        bare = _COLON.sub(lambda m: "։" if _armenian_before(bare, m.start()) else ":", bare)
    return bare


def _armenian_before(text: str, end: int) -> bool:
    """Whether the last letter before a place is Armenian, however far back it stands."""
    i = end - 1
    while i >= 0 and not _LETTER.match(text[i]):
        i -= 1
    return i >= 0 and script_of(text[i]) == "Armenian"


def form(text: str) -> str:
    """The form in which equal-looking values are equal: ordinary characters with full case folding."""
    return spelled(text).casefold()


@F.pandas_udf(T.StructType([T.StructField("form", T.StringType()), T.StructField("odd", T.BooleanType())]))
def _by_value(texts):
    import pandas as pd

    codes, values = pd.factorize(texts)
    plain = [spelled(x) for x in values]
    forms = [x.casefold() for x in plain] + [None]
    odd = [a != b for a, b in zip(plain, values)] + [None]
    return pd.DataFrame({"form": [forms[i] for i in codes], "odd": pd.array([odd[i] for i in codes], dtype="boolean")})


def unified(df: DataFrame, text: str, form_name: str = "form", odd_name: str = "odd") -> DataFrame:
    """Adds the one form of a text column and whether the text has characters that only look ordinary.

    Each batch is handled once per distinct value; a text without a suspect character is only case-folded. Null stays null
    with a null flag, an empty text stays empty, other columns are kept as they are.
    """
    rows = df.withColumn("__seen", _by_value(F.col(f"`{text}`")))
    return rows.withColumn(form_name, F.col("__seen.form")).withColumn(odd_name, F.col("__seen.odd")).drop("__seen")
