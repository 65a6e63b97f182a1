"""Each operator against brute force or a round trip, and on nulls, empty texts, repeats, empty tables and clashing names."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("corpuspark.llm")
from corpuspark.llm import encoding_repair, language, leakage, main_content, mixing, scan_repair, site_lines, split_overlap, unicode_form, words  # noqa: E402


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# p1 ---------------------------------------------------------------------------------------------------------------


def articles(spark, data):
    return spark.createDataFrame(data, "article_id string, source_name string, content string, line_no int, key string")


def test_site_lines_against_counting(spark):
    notice, share = "© Կայք․ Բոլոր իրաւունքները", "Բաժնեկցեցէ՛ք այս գրութիւնը"
    data = [(f"a{i}", "s", f"{share}\n\nպարբերութիւն {chr(0x561 + i)}\n{notice if i % 2 else notice.upper()}!", 9, "k") for i in range(6)]
    data += data[:2] + [("b", "s", None, 1, "k"), (None, "s", share, 1, "k"), ("c", None, share, 1, "k"), ("e", "s", "", 1, "k"), ("d", "t", share, 1, None)]
    found, blocks = site_lines.boilerplate(articles(spark, data))
    want = sorted((f"a{i}", n) for i in range(6) for n in (1, 4))
    assert rows(found.select("key", "line_no")) == want
    assert blocks.count() == 2
    clean = dict(rows(site_lines.without_lines(articles(spark, data), found, "article_id", "content").select("key", "text").where("key is not null")))
    assert clean["a0"] == "պարբերութիւն ա" and clean["b"] is None and clean["e"] == "" and clean["d"] == share


def test_site_lines_join_consecutive_lines_to_blocks(spark):
    data = [(f"a{i}", "s", f"ա\nբ\nգ\nտարբեր{'ա' * i}", 0, "") for i in range(5)]
    found, blocks = site_lines.boilerplate(articles(spark, data))
    assert [(x.lines, x.documents, x.edges) for x in blocks.collect()] == [(3, 5, 2)]
    assert found.select("block").distinct().count() == 1


def test_site_lines_of_an_empty_table(spark):
    found, blocks = site_lines.boilerplate(articles(spark, []))
    assert found.count() == 0 and blocks.count() == 0


# p2 ---------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "text, plain",
    [
        ("որ​ովհետեւ", "որովհետեւ"), ("nր", "որ"), ("ﬔնք", "մենք"), ("ｓｃｈｏｏｌ", "school"), ("étude", "étude"), ("մէջ մեծ", "մէջ մեծ"),
        ("tһe сhοir", "the choir"), ("մը: Ան", "մը։ Ան"), ("Օգոստոս 20:", "Օգոստոս 20։"), ("горoд", "город"),
    ],
)
def test_odd_spellings_become_plain(text, plain):
    assert unicode_form.spelled(text) == plain


@pytest.mark.parametrize("text", ["և", "25 m²", "№ 7", "½ ™ ³", "12:30", "ժամը 12:30", "“Ararat” — ’", "👨‍👩‍👧", "α β γ", "«Vahan»", "a\tb\nc", "note: yes", ""])
def test_what_looks_different_stays(text):
    assert unicode_form.spelled(text) == text


def test_unified_keeps_nulls_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "nր", "x"), (2, None, "y"), (3, "", "z"), (4, "Որ", None), (4, "Որ", None)], "id int, text string, `__seen2` string")
    out = {x.id: (x.form, x.odd) for x in unicode_form.unified(df, "text").collect()}
    assert out == {1: ("որ", True), 2: (None, None), 3: ("", False), 4: ("որ", False)}
    assert unicode_form.unified(df.limit(0), "text").count() == 0


# p3 ---------------------------------------------------------------------------------------------------------------


def vocabulary(n, seed=1):
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(n)]


def records(spark, data):
    return spark.createDataFrame(data, "document_id string, split string, text string, content_hash string, source_family string, class long, a string, hash string")


def test_split_overlap_against_all_pairs(spark):
    r, v = random.Random(4), vocabulary(400)
    texts = [[r.choice(v) for _ in range(r.randint(8, 60))] for _ in range(120)]
    data = []
    for i, t in enumerate(texts):
        data.append((f"t{i}", "train", " ".join(t)))
        if i % 3 == 0:
            u = list(t)
            for _ in range(r.randint(0, len(u) // 6)):
                u[r.randrange(len(u))] = r.choice(v)
            data.append((f"e{i}", r.choice(["test", "validation"]), " ".join(u).upper() + " !"))
    import hashlib

    data = [(a, b, c, None, "f", 1, "x", "y") for a, b, c in data]
    h = hashlib.sha256(" ".join(texts[5]).encode()).hexdigest()
    data += [("empty", "test", "", h, "f", 1, "x", "y"), ("null", "test", None, h, "f", 1, "x", "y"), ("same-split", "train", None, h, "f", 1, "x", "y"), data[0]]
    data += [(None, "test", "abc", None, "f", 1, "x", "y"), ("no-split", None, data[0][2], None, "f", 1, "x", "y"), ("stale", "test", "other words entirely here now", h, "f", 1, "x", "y")]
    got = {(a, b) for a, b, _ in rows(split_overlap.overlaps(records(spark, data)))}
    live = [x for x in data if x[0] and x[1] and x[2]]
    want = set()
    for x, y in itertools.combinations(sorted(set(live)), 2):
        if (x[1] == "train") != (y[1] == "train") and words.agreement(words.words_of(x[2]), words.words_of(y[2]), 0.8) >= 0.8:
            want.add(tuple(sorted((x[0], y[0]))))
    want |= {("empty", "t5"), ("null", "t5")}
    assert got == want
    counted = split_overlap.counts(records(spark, data), split_overlap.overlaps(records(spark, data)))
    assert sum(x.pairs for x in counted.collect()) == len(want)


def slipped(word, r):
    i = r.randrange(len(word))
    return r.choice([word[:i] + word[i + 1 :], word[:i] + "q" + word[i:], word[:i] + "q" + word[i + 1 :]])


def test_split_overlap_of_short_and_noisy_texts(spark):
    r, v, data = random.Random(6), vocabulary(3000, 9), []

    def add(words_a, words_b):
        data.append((f"t{len(data)}", "train", " ".join(words_a)))
        data.append((f"e{len(data)}", "test", " ".join(words_b)))

    for n in (5, 6, 8, 10, 15, 20, 40, 100):  # a fifth of the words replaced, four or five apart
        for start in range(2):
            t = [r.choice(v) for _ in range(n)]
            u, left = list(t), n // 5
            for i in range(start, n, 4 if n < 20 else 5):
                if left:
                    u[i], left = r.choice(v), left - 1
            add(t, u)
    for n in (1, 2, 3, 4, 12, 100):  # slips in every word of short texts, in every fourth of long ones
        t = [r.choice(v) for _ in range(n)]
        add(t, [slipped(w, r) if n <= 4 or i % 4 == 3 else w for i, w in enumerate(t)])
    for n in (40, 120):  # words put in and left out at different places
        t = [r.choice(v) for _ in range(n)]
        u = [w for i, w in enumerate(t) if i % 10 != 3]
        for i in range(0, len(u), 10):
            u.insert(i, r.choice(v))
        add(t, u)
    for n in (20, 60):  # slips in three tenths of the words, anywhere
        t, at = [r.choice(v) for _ in range(n)], set(r.sample(range(n), 3 * n // 10))
        add(t, [slipped(w, r) if i in at else w for i, w in enumerate(t)])
    got = {(a, b) for a, b, _ in rows(split_overlap.overlaps(records(spark, [(a, b, c, None, "f", 1, "x", "y") for a, b, c in data])))}
    want = {
        tuple(sorted((x[0], y[0]))) for x, y in itertools.combinations(data, 2) if x[1] != y[1] and words.agreement(words.words_of(x[2]), words.words_of(y[2]), 0.8) >= 0.8
    }
    assert len(want) >= 26 and got == want


def test_hot_terms_are_split_without_loss(spark, monkeypatch):
    monkeypatch.setattr(split_overlap, "HOT", 7)
    stock, v = "each of these notes begins with the very same long sentence as all".split(), vocabulary(60, 12)
    data = [(f"{'e' if i % 4 else 't'}{i}", "test" if i % 4 else "train", " ".join([*stock, v[i]]), None, "f", 1, "x", "y") for i in range(60)]
    assert split_overlap.overlaps(records(spark, data)).count() == 45 * 15


def test_split_overlap_of_an_empty_table(spark):
    assert split_overlap.overlaps(records(spark, [])).count() == 0


def test_slips_agree():
    a = "one little sparrow hopped across the garden wall".split()
    assert words.agreement(a, "one litle sparrow hoppde across the garden wall".split(), 0.8) == 1.0
    assert words.agreement(a, "nothing of this is here at all today".split(), 0.8) < 0.5
    assert words.lcs("abcde", "xaxbxe") == 3


# p4 ---------------------------------------------------------------------------------------------------------------


def site_pages(spark, site="Aram", n=40):
    """Pages of made-up sites in a made-up language: what is furniture shows only by recurring."""
    r, v = random.Random(7), vocabulary(900, 21)
    sentence = lambda: " ".join([r.choice(v).capitalize(), *(r.choice(v) for _ in range(9))]) + "."
    title = lambda: " ".join([r.choice(v).capitalize(), *(r.choice(v) for _ in range(4))])
    data, want = [], {}
    for i in range(n):
        name = f"{site}{'abcdefgh'[i % 8]}"
        lines = [
            ("Hopa | Kuri | Bela", 0), (f"Zu {r.choice(v).capitalize()} {r.choice(v).capitalize()}", 0), (sentence(), 1), (title(), 1), (sentence(), 1), ("", 2), (f"We at {name} keep small files on your machine so that you feel at home.", 0),
            (sentence(), 1), ("Moka lepo suda tira", 0), (title(), 0), (title(), 0), (f"Tagu: {r.choice(v)}, {r.choice(v)}, {r.choice(v)}", 0), (f"Posted on {i} of {2000 + i} at {i}", 0),
        ]
        data.append((f"u{i}", name, "\n".join(x for x, _ in lines), 1))
        want[f"u{i}"] = [k for k, (_, kind) in enumerate(lines, 1) if kind == 0]
    return spark.createDataFrame(data, "url string, domain string, text string, body int"), want


def test_furniture_is_told_by_recurring(spark):
    df, want = site_pages(spark)
    got = {x.key: list(x.around) for x in main_content.around(df, "url", "text", "domain").collect()}
    assert got == want
    body = {x.key: x.body for x in main_content.bodies(df, "url", "text", "domain").collect()}
    assert all(len(x.split("\n")) in (5, 6) for x in body.values())
    again = {x.key: list(x.around) for x in main_content.bodies(df.union(df), "url", "text", "domain").collect()}
    assert again == want


def test_markup_far_into_a_page_is_rendered(spark):
    df = spark.createDataFrame([("u", "Plain words before the page. " * 400 + "<p>The first part of it.<nav>Home</nav><p>The end of it.", None)], "url string, text string, domain string")
    body = main_content.bodies(df, "url", "text", "domain").first().body
    assert "<p>" not in body and "Home" not in body and body.endswith("The end of it.")


def test_markup_is_rendered_with_implied_tags():
    html = "<html><body><nav><a>Home</a></nav><p>First part of it.<p>Second part of it.<ul><li>one<li>two</ul><script>x()</script><div style='display: none'>gone</div><table><tr><td>a<td>b<tr><td>long cell<td>c</table></body>"
    lines = main_content.render(html)
    assert [x for x, r in lines if r == "nav"] == ["Home"] or ("Home", "nav") in lines
    shown = [x for x, r in lines if x and not r]
    assert shown == ["First part of it.", "Second part of it.", "- one", "- two", "a          b", "long cell  c"]


def test_bodies_of_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([("u", None, 1), ("v", "", 2), ("w", "The end of the story came.\nHome | Terms of use", 3)], "url string, text string, body int")
    out = {k: (b, n) for k, b, n in rows(main_content.bodies(df, "url", "text"))}
    assert out == {"u": (None, []), "v": ("", []), "w": ("The end of the story came.", [2])}
    assert main_content.bodies(df.limit(0), "url", "text").count() == 0


# p5 ---------------------------------------------------------------------------------------------------------------

SAMPLES = {
    "hye-w": "Ան կը կարդայ գիրք մը տունին մէջ։ Մենք կը գրենք նամակ մը եւ կը խօսինք։",
    "hye-e": "Նա կարդում է մի գիրք տան մեջ։ Մենք գրում ենք նամակ և խոսում ենք։",
    "eng": "She reads a book in the house. We write a letter and talk with them.",
    "fra": "Elle lit un livre dans la maison. Nous écrivons une lettre avec eux.",
    "rus": "Она читает книгу в доме. Мы пишем письмо и говорим с ними.",
}


def labelled(spark, extra=()):
    data = [(f"{k}{i}", t, f"kind:{k}", k, 1) for k, t in SAMPLES.items() for i in range(12)]
    kind = "document_id string, text string, source_family string, internal_language_branch string, prior int"
    meta = spark.createDataFrame([("hye-w0", "hye", 0), ("hye-e0", "hy", 0), ("eng0", None, 0), ("gone", "en", 0)], "document_id string, source_language_code string, lang int")
    return spark.createDataFrame([*data, *extra], kind), meta


def test_languages_and_wrong_labels(spark):
    extra = [
        ("wrong", SAMPLES["hye-e"], "kind:hye-w", "hye-w", 1), ("none", SAMPLES["fra"], None, None, 1), ("mixed", SAMPLES["rus"] + " " + SAMPLES["eng"] + " " + SAMPLES["eng"], "x", "eng", 1),
        ("empty", "", "x", "eng", 1), ("null", None, "x", None, 1), ("digits", "12 34", "kind:rus", "rus", 1), ("wrong", SAMPLES["hye-e"], "kind:hye-w", "hye-w", 1),
    ]
    docs, meta = labelled(spark, extra)
    got = set(rows(language.wrong_labels(docs, meta)))
    assert got == {
        ("wrong", "internal_language_branch", 0, "hye-e"), ("none", "internal_language_branch", 0, "fra"), ("hye-w0", "source_language_code", 0, "hye-w"),
        ("eng0", "source_language_code", 0, "eng"), ("mixed", "text", 1, "rus"), ("mixed", "text", 2, "eng"),
    }


def test_addresses_are_evidence(spark):
    data = [(f"{k}{i}", t, "web", k, f"https://{k[:3]}{i % 3}.{k[:2]}/x", 1) for k, t in SAMPLES.items() for i in range(12)]
    data += [("short", "1990 12", "web", None, "https://fra1.fr/y", 1), ("other", "1990 12", "web", None, "http://www.new.ru:80/z", 1), ("bad", "1990 12", None, None, "no address", 1)]
    docs = spark.createDataFrame(data, "document_id string, text string, source_family string, internal_language_branch string, source_url string, suffix int")
    meta = spark.createDataFrame([], "document_id string, source_language_code string")
    got = {x.document_id: x.lang for x in language.languages(docs, meta).collect()}
    assert got["short"] == "fra" and got["other"] == "rus" and len(got) == len(data)


def test_the_main_script_is_that_of_the_whole_text():
    text = "Plain English words. " * 40 + "Потом идёт длинный русский текст. " * 60 + "Cop"
    assert unicode_form._main_script(text) == "Cyrillic"
    assert unicode_form.spelled("Օգոստոս 20" + " 1234" * 30 + ": ok").count("։") == 1


def test_languages_of_an_empty_table(spark):
    docs, meta = labelled(spark)
    assert language.wrong_labels(docs.limit(0), meta).count() == 0


# p6 ---------------------------------------------------------------------------------------------------------------


def test_scan_structure_and_joining():
    page = "The Long Title   11\nthe old har-\nbour of Abovyan-\nKentron lay still.\n12   Some Author\nnext line of it\nThe Long Title   13\nthe end of it.\n— 14 —"
    kinds = scan_repair.structure(page, "The long title", "Some Author")
    assert [i for i, k in enumerate(kinds, 1) if k == "running_header"] == [1, 5, 7]
    assert kinds[8] == "page_number"
    assert scan_repair.broken("the old har-", "bour of") and not scan_repair.broken("of Abovyan-", "Kentron lay")


def test_scans_are_joined_to_paragraphs(spark):
    page = "The Long Title   11\nthe old har-\nbour of Abovyan-\nKentron lay still.\n12   Some Author\nnext line of it\nThe Long Title   13\nthe end of it.\n— 14 —"
    df = spark.createDataFrame([("a", "The long title", "Some Author", page)], "text_id string, title string, author string, full_text string")
    assert rows(scan_repair.repaired(df)) == [("a", "the old harbour of Abovyan-Kentron lay still. next line of it the end of it.")]


def test_header_search_is_linear():
    lines = [f"{'The Long Title' if i % 2 else 'A Part of the Whole'}   {i}\n" + "\n".join(f"line {i} {j} of the body goes on here" for j in range(3)) for i in range(800)]
    import time

    began = time.time()
    kinds = scan_repair.structure("\n".join(lines[:400]))
    once = time.time() - began
    kinds = scan_repair.structure("\n".join(lines))
    assert sum(k == "running_header" for k in kinds) >= 800 and time.time() - began - once < 6 * once + 1


def test_misread_words(spark):
    base = "the small manuscript of the choir lay on the long table near the river and the printer saw it"
    data = [(f"t{i}", None, None, "\n".join([base] * 12)) for i in range(5)]
    data += [("bad", None, None, base.replace("choir", "ch0ir") + "\n" + base.replace("river", "r!ver") + "\n" + base), ("empty", None, None, ""), ("null", None, None, None), data[0]]
    df = spark.createDataFrame(data, "text_id string, title string, author string, full_text string")
    got = [x for x in rows(scan_repair.noise(df)) if x[2] == "misread"]
    assert got == [("bad", 1, "misread"), ("bad", 2, "misread")]
    metrics = spark.createDataFrame([("x.pdf", 1, "tesseract", 90, 1), ("x.pdf", 1, "surya", 90, 2), (None, 1, "surya", 1, 1)], "pdf_name string, page_num int, engine string, char_count int, recorded_at int")
    paged = df.withColumn("archive_id", F.lit("x"))
    assert [x for x in rows(scan_repair.noise(paged, metrics)) if x[2] == "misread"] == got
    assert scan_repair.noise(paged.limit(0), metrics).count() == 0
    assert dict(rows(scan_repair.repaired(df)))["bad"].count("choir") == 3
    assert scan_repair.noise(df.limit(0)).count() == 0


# p7 ---------------------------------------------------------------------------------------------------------------


def test_leaks_of_many_items_are_scored_in_full(spark):
    r, v = random.Random(3), vocabulary(6000, 5)
    items = [(i, " ".join(r.choice(v) for _ in range(40)) + ".") for i in range(500)]
    docs = []
    for i, text in items:
        filler = [[r.choice(v) for _ in range(r.randint(0, 11))] for _ in range(2)]
        docs.append((i, " ".join(filler[0] + text.rstrip(".").split()[: 40 if i % 2 else 20] + filler[1])))
    left = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {(a, b) for a, b, *_ in rows(leakage.leaks(left, spark.createDataFrame(items, "item_id bigint, text string")))}
    assert got == {(i, i) for i, _ in items}


def test_leaks_against_every_pair(spark):
    r, v = random.Random(8), vocabulary(3000, 2)
    stock = "read this passage and then answer all."
    items = [(i, (stock + " " if i % 4 == 0 else "") + " ".join(r.choice(v) for _ in range(34)) + ".") for i in range(12)]
    docs = []
    for i in range(60):
        filler = [r.choice(v) for _ in range(r.randint(20, 120))]
        docs.append((i, " ".join(filler)))
    passage = items[0][1].removeprefix(stock).strip().split()
    docs += [(100, " ".join(docs[0][1].split() + passage)), (101, " ".join(passage[:20] + docs[1][1].split())), (102, " ".join(passage[:12])), (103, stock)]
    docs += [(104, " ".join(passage[:17] + ["x", "y", "inserted", "line"] * 3 + passage[17:])), (105, None), (106, ""), (100, docs[-4][1])]
    left = spark.createDataFrame([(a, b, 0) for a, b in docs], "doc_id bigint, text string, item_id int")
    right = spark.createDataFrame([*items, (77, None)], "item_id bigint, text string")
    got = {(a, b) for a, b, *_ in rows(leakage.leaks(left, right))}
    every = [(i, list(w)) for i, w in rows(leakage.without_stock(right))]
    want = {(d, i) for d, t in docs if t for i, w in every if leakage.stretch(words.words_of(t), w) >= 0.5}
    assert got == want == {(100, 0), (101, 0), (104, 0)}
    assert leakage.leaks(left.limit(0), right).count() == 0 and leakage.leaks(left, right.limit(0)).count() == 0


# p8 ---------------------------------------------------------------------------------------------------------------


def test_flight_keeps_both_totals():
    r = np.random.default_rng(2)
    tokens = r.integers(1, 500, 400)
    p = np.full(400, 0.37)
    out = mixing.flight(p, tokens, 5)
    assert abs(out.sum() - p.sum()) < 1e-6 and abs((out * tokens).sum() - (p * tokens).sum()) < 1e-4
    assert ((out > 1e-9) & (out < 1 - 1e-9)).sum() <= 2
    landed = mixing.landing(out, tokens)
    assert set(landed) <= {0.0, 1.0} and abs((landed * tokens).sum() - (p * tokens).sum()) <= 500


def test_mix_shares_and_caps(spark):
    import os

    if not os.path.exists(mixing.TOKENIZER):
        pytest.skip("no tokenizer file")
    data = [(i, "big", f"word number {i} " * 20) for i in range(300)] + [(1000 + i, "small", "tiny text " * 10) for i in range(10)] + [(2000, "free", "no target"), (2001, "big", None), (2002, None, "x"), (0, "big", "word number 0 " * 20)]
    docs = spark.createDataFrame([(*x, 1) for x in data], "doc_id bigint, source string, text string, tokens int")
    targets = spark.createDataFrame([("big", 0.5, 2), ("small", 0.4, 3), ("absent", 0.1, 1)], "source string, target_share double, max_repeats int")
    chosen, shares = mixing.mix(docs, targets)
    assert chosen.where("repeats < 1").count() == 0 and chosen.groupBy("doc_id").count().where("count > 1").count() == 0
    assert {x.source: x.repeats for x in shares.collect()}["small"] == 3
    assert sum(x.share for x in shares.collect()) == pytest.approx(1)
    big = chosen.where("source = 'big'")
    want = 0.5 * sum(x.tokens for x in mixing.token_counts(docs).where("source in ('big', 'small')").collect())
    assert big.selectExpr("sum(tokens * repeats)").first()[0] == pytest.approx(want, abs=120)
    empty, none = mixing.mix(docs.limit(0), targets)
    assert empty.count() == 0 and none.count() == 3


def test_token_counts_equal_the_tokenizer():
    import os

    if not os.path.exists(mixing.TOKENIZER):
        pytest.skip("no tokenizer file")
    t = mixing.Tokens(mixing.vocabulary_of(mixing.TOKENIZER))
    for text in ("", "Ան կը կարդայ  գիրք մը։\n\n12 o'clock, it's late   ", " x" * 5):
        assert t.count(text) == len(t.encoding.encode_ordinary(text))


# p9 ---------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("codec", ["cp1252", "mac_roman", "cp1251", "cp437"])
@pytest.mark.parametrize("text", ["Ան կարդաց գիրքը", "été très léger où"])
def test_wrong_readings_are_undone(text, codec):
    read = {b: x for b, x in enumerate(encoding_repair._characters(codec))}
    bad = "".join(read[b] for b in text.encode())
    assert encoding_repair.repair(bad) == (text, True)


def test_other_wrong_readings():
    back = {v: k for k, v in encoding_repair._armscii().items()}
    armscii = "".join(chr(back[x]) if x in back and not x.isascii() else x for x in "Ան կարդաց գիրքը")
    assert encoding_repair.repair(armscii) == ("Ան կարդաց գիրքը", True)
    assert encoding_repair.repair("старая деревня".encode("cp1251").decode("latin-1")) == ("старая деревня", True)
    assert encoding_repair.repair("Вся Деревня".encode("koi8_r").decode("cp1251"))[1]
    assert encoding_repair.repair("tr�s")[1]


@pytest.mark.parametrize(
    "text", ["Þóra Ðalsdóttir has both Þ and Ð; Ç and Ü", "SÃO PAULO", "25 °C ± 2, £4 or €5", "l’Île-d’Äme, l’été", "ГРАЖДАНСТВО РФ", "«РФ» «Всё»", "À Paris, où déjà", "LE MONASTÈRE, THÉÂTRE", "Âge", ""]
)
def test_rare_but_right_characters_stay(text):
    assert encoding_repair.repair(text) == (text, False)


def test_garbled_documents(spark):
    good = "Ան կը կարդայ գիրք մը 1990 թուականին, տունին մէջ։"
    bad = "".join(encoding_repair._characters("cp1252")[b] for b in good.encode())
    lost = good.replace("գ", "�")
    data = [(1, good), (2, bad), (3, lost), (4, None), (5, ""), (6, "plain ascii"), (2, bad), (None, bad)]
    df = spark.createDataFrame([(*x, "k") for x in data], "doc_id bigint, text string, key string")
    assert rows(encoding_repair.garbled(df).select("doc_id", "restored", "whole")) == [(2, good, True), (3, good, True)]
    assert encoding_repair.garbled(df.limit(0)).count() == 0


def test_a_reading_that_is_not_in_the_stock_is_learned(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice("աբգդեզէըթժիլխծկհձղճմյնշոչպջռսվտրցւփքօֆ") for _ in range(r.randint(3, 9)))
    assert "cp775" not in encoding_repair.READINGS
    wrong = lambda text: "".join(encoding_repair._characters("cp775")[b] for b in text.encode())
    clean = [f"{' '.join(word() for _ in range(8))}, {1900 + i} {' '.join(word() for _ in range(9))}; {' '.join(word() for _ in range(7))} ({i})" for i in range(24)]
    # twelve have a near-twin whose last words differ, the others have none
    data = [(i, x) for i, x in enumerate(clean[:12])] + [(100 + i, wrong(x[:-4]) + " (other words)") for i, x in enumerate(clean[:12])] + [(200 + i, wrong(x)) for i, x in enumerate(clean[12:])]
    got = {a: b for a, b in rows(encoding_repair.garbled(spark.createDataFrame(data, "doc_id bigint, text string")).select("doc_id", "restored"))}
    assert {k for k in got} == {k for k, _ in data if k >= 100}
    assert all(got[200 + i] == x for i, x in enumerate(clean[12:]))
