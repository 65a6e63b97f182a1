"""Core functions and operators on small fixtures with values worked out by hand, and every query against its SQL."""

import json
import os

import pytest
from pyspark.sql import functions as F

from corpuspark.functions import metrics, morphology, text as X
from corpuspark.operators import clustering, correction, alignment, classify, coverage, dedup, distance, frequency, records, release, retrieval
from corpuspark.plans import audit
from corpuspark.sources import readers
from corpuspark.streaming import incremental

DATA = "/root/testdata/sf0.001"


def one(spark, text, *columns):
    return spark.createDataFrame([(text,)], "t string").select(*columns).first()


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_weighted_list_fixed_and_hybrid(spark):
    docs = spark.createDataFrame([("wikipedia_wa", "բառ բառ դար", 6.0), ("newspaper", "բառ համ համ", 4.0)], "source string, text string, wa_score double")
    counts = frequency.word_counts(docs, ["source"])
    got = {x.word: (x.rank, x.total) for x in frequency.weighted_list(counts).collect()}
    assert got == {"բառ": (1, 3.5), "համ": (2, 3.0)}
    weights = {x.source: x.weight for x in frequency.hybrid_weights(docs, 0.5).collect()}
    assert weights == {"newspaper": 1.35, "wikipedia_wa": 1.1}
    old = counts
    new = frequency.word_counts(docs.union(spark.createDataFrame([("wikipedia_wa", "համ", 6.0)], docs.schema)), ["source"])
    change = frequency.delta(old, new, ["source", "word"])
    assert rows(change) == [("wikipedia_wa", "համ", 1)]
    assert rows(frequency.merged(old, change, ["source", "word"])) == rows(new)
    assert frequency.weighted_list(counts.limit(0)).count() == 0


def test_source_weight_falls_back_to_the_kind(spark):
    df = spark.createDataFrame([("newspaper:x",), ("unknown",), (None,)], "source string")
    assert [x[0] for x in df.select(frequency.source_weight(F.col("source"))).collect()] == [1.5, 1.0, 1.0]


def test_text_functions(spark):
    t = F.col("t")
    assert one(spark, "Բառ (note) «text» ու latin ։ ", X.without_foreign(t))[0].split() == ["Բառ", "ու", "։"]
    assert one(spark, "ա\n***\n\nբ", X.without_junk_lines(t))[0] == "ա\n\nբ"
    assert one(spark, "abcdef", X.shingles(t))[0] == ["abcde", "bcdef"]
    assert one(spark, "abc", X.shingles(t))[0] == ["abc"]
    assert one(spark, "", X.shingles(t))[0] == []
    assert one(spark, "գիւղ", X.other_branch(X.other_branch(t)))[0] == "գիւղ"
    assert one(spark, "HTTP://Ex.org/A/?utm_source=x&b=1#f", X.plain_url(t))[0] == "http://ex.org/A/?b=1"
    assert one(spark, "{{a|{{b}}}}'''Text''' [[x|y]] <ref>z</ref>", X.wikitext(t))[0] == "Text y"
    assert one(spark, "#REDIRECT [[x]]", X.redirects(t))[0] is True
    assert one(spark, "Ab: c! d", X.sentences(t))[0] == ["Ab", "c", "d"]
    import hashlib

    assert one(spark, " ﬁ  x\n", X.content_hash(t))[0] == hashlib.sha256(b"fi x").hexdigest()
    assert one(spark, "é", X.nfc(t))[0] == "é"
    assert one(spark, None, X.words(t), X.content_hash(t)) == (None, None)


def test_metrics(spark):
    w = F.split(F.col("t"), " ")
    got = one(spark, "ա բ ա գ", metrics.ttr(w), metrics.sttr(w), metrics.yule(w), metrics.entropy(w))
    assert tuple(got) == (0.75, 0.75, 1875.0, 1.5)
    assert one(spark, "ուրախութիւն", metrics.syllables(F.col("t")))[0] == 4
    assert one(spark, "գրեմ կարդում", metrics.contamination(w))[0] == 0.5


def test_classification(spark):
    df = spark.createDataFrame([(1, "Ան կը կարդայ գիրք մը"), (2, "նա կարդում է մի գիրք և գյուղ"), (3, "hello"), (4, None)], "id int, text string")
    got = {x.id: x for x in classify.classified(df).collect()}
    assert got[1].label == "likely_western" and got[2].label == "likely_eastern" and got[3].label == got[4].label == "inconclusive"
    assert got[3].confidence == 0.0
    found = one(spark, "գիրք մը", classify.evidence(F.col("t")))[0]
    assert ("WA_INDEF_ARTICLE_MUH", 2.5) in {(x.rule_id, x.weight) for x in found}
    alias = spark.createDataFrame([("Western_Armenian",), ("hye e",), ("xx",), (None,)], "b string").select(classify.branch_alias(F.col("b")))
    assert [x[0] for x in alias.collect()] == ["hye-w", "hye-e", None, None]


def test_keep_first_is_not_a_component_rule(spark):
    keys = spark.createDataFrame([(i,) for i in range(1, 5)], "key long")
    pairs = spark.createDataFrame([(1, 2), (2, 3)], "a long, b long")
    assert rows(dedup.keep_first(keys, pairs)) == [(1, True), (2, False), (3, True), (4, True)]


def test_near_pairs_against_brute_force(spark):
    base = [a + b for a in "abcdefgh" for b in "ijklmnop"][:60]
    texts = [base, base[:58] + ["x", "y"], base[30:] + base[:30], ["z"] * 5, base]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)] + [(9, None), (10, "")], "doc_id long, text string")

    def sets(t):
        return {tuple(t[i : i + 5]) for i in range(max(1, len(t) - 4))}

    want = {(i, j) for i in range(4) for j in range(i + 1, 4) if len(sets(texts[i]) & sets(texts[j])) / len(sets(texts[i]) | sets(texts[j])) >= 0.8}
    assert {(x.a, x.b) for x in dedup.near_pairs(df).collect()} == want
    assert want >= {(0, 1), (0, 2)}


def test_near_twins_in_other_case_and_punctuation(spark):
    base = [a + b for a in "abcdefgh" for b in "ijklmnop"][:60]
    texts = {1: " ".join(base), 2: ", ".join(base).upper(), 3: " ".join(base[:58] + ["x", "y"]), 4: " ".join(base[:58] + ["x", "y"]) + "!", 5: ", ".join(base).upper(), 6: "", 7: "other words stand here alone", 8: ""}
    df = spark.createDataFrame([*texts.items(), (9, None)], "doc_id long, text string")
    got = {x.doc_id: (x.kept, x.links) for x in audit.near_twins(df).collect()}
    assert got == {1: (True, 3), 2: (False, 3), 3: (False, 3), 4: (False, 3), 5: (False, 3), 6: (True, 0), 7: (True, 0), 8: (False, 0)}


def test_distances(spark):
    a = spark.createDataFrame([("x", 2), ("y", 2)], "word string, n long")
    b = spark.createDataFrame([("z", 4)], "word string, n long")
    far, same = distance.divergences(a, b).first(), distance.divergences(a, a).first()
    assert (far.js_bits, far.hellinger, far.cosine, far.jaccard) == (1.0, 1.0, 1.0, 1.0)
    assert (same.js_bits, same.hellinger, same.jaccard, same.kl) == (0.0, 0.0, 0.0, 0.0)
    v = lambda *x: spark.createDataFrame([(i,) for i in x], "value double")
    assert distance.wasserstein(v(0.0, 1.0), v(1.0, 2.0)).first()[0] == 0.5
    load = distance.orthographic_load(F.lit("բերեցի"), F.lit("բերել ես"))
    assert one(spark, "", load)[0] == 3.0


def test_release(spark, tmp_path):
    df = spark.range(50).select(F.sha2(F.col("id").cast("string"), 256).alias("content_hash"), "id")
    split = lambda s: rows(df.select("id", release.split_of(F.col("content_hash"), s, 0.8, 0.1)))
    assert split("a") == split("a") != split("b")
    manifest = release.write_release(df, str(tmp_path / "out"))
    out = str(tmp_path / "out")
    assert sum(manifest["rows"].values()) == 50 and json.loads(spark.read.text(out + "/manifest").first()[0])["rows"] == manifest["rows"]
    assert spark.read.parquet(out + "/full").count() == 50 and "50 documents" in "".join(x.value for x in spark.read.text(out + "/card").collect())
    sums = spark.read.json(out + "/checksums").collect()
    assert len(sums) >= 4 and all(len(x.sha256) == 64 for x in sums)
    new = spark.createDataFrame([(1, "h"), (2, "h"), (3, "old"), (4, None)], "doc_id long, content_hash string")
    old = spark.createDataFrame([(9, "old")], "doc_id long, content_hash string")
    assert rows(release.insert_new(new, old)) == [(1, "h"), (4, None)]
    assert rows(release.upsert(old, new.where("doc_id = 3"), ["content_hash"])) == [(3, "old")]


def test_morphology(spark):
    t = F.col("t")
    assert one(spark, "տուն", morphology.definite(t), morphology.indefinite(t), morphology.plural(t))[:] == ("տունը", "տուն մը", "տուներ")
    assert one(spark, "կատու", morphology.definite(t), morphology.plural(t))[:] == ("կատուն", "կատուներ")
    forms = {(x.number, x.case, x.kind): x.form for x in one(spark, "տուն", morphology.declined(t))[0]}
    assert forms["singular", "ablative", "bare"] == "տունէ" and forms["plural", "instrumental", "definite"] == "տուններովը" and forms["singular", "nominative", "indefinite"] == "տուն մը"
    assert {x.form for x in one(spark, "քոյր", morphology.declined(t, "o_class"))[0]} >= {"քոյրորէ", "քոյրով"}
    verb = {(x.tense, x.person): x.form for x in one(spark, "բերել", morphology.conjugated(t))[0]}
    assert verb["present", "1sg"] == "կը բերեմ" and verb["future", "3pl"] == "պիտի բերեն" and verb["past_aorist", "1sg"] == "բերեցի" and verb["imperative_pl", None] == "բերեք"
    odd = {(x.tense, x.person): x.form for x in one(spark, "գալ", morphology.conjugated(t, "a_class", {"գալ": {"past_aorist": {"1sg": "եկայ"}}}))[0]}
    assert odd["past_aorist", "1sg"] == "եկայ" and odd["present", "1sg"] == "կը գամ"
    assert one(spark, "պար", morphology.romanized(t), morphology.romanized(t, "eastern"))[:] == ("bar", "par")
    assert "տուն" in one(spark, "տուներէն", morphology.stems(t))[0]
    assert one(spark, "պար", morphology.difficulty(t))[0] == 1.0


def test_alignment(spark):
    assert alignment.align(["one two", "three"], ["zzzz", "one two", "three!"]) == [("one two", "one two"), ("three", "three!")]
    df = spark.createDataFrame([(1, ["a b"], ["a b"]), (2, None, ["x"])], "pair_id long, left array<string>, right array<string>")
    assert rows(alignment.aligned(df)) == [(1, 0, "a b", "a b")]
    sides = [spark.createDataFrame([(i, n) for i, n in enumerate(x)], "id long, n long") for x in ([5, 5, 31, 90, None], [7, 33, 38, 500])]
    assert sorted((x["left"], x["right"]) for x in alignment.matched_by_length(*sides, "id", "n").collect()) == [(0, 0), (2, 1)]


def test_readers(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"text": "one"}\nbroken\n{"content": "two"}\n{"text": ""}\n')
    assert {x.text for x in readers.json_lines(spark, str(tmp_path / "a.jsonl")).collect()} == {"one", "two"}
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "x.txt").write_text("k=v\nBEGIN_DOCUMENT_CONTENT\nbody")
    got = readers.headed_texts(readers.text_tree(spark, str(tmp_path / "t"))).first()
    assert got.properties == {"k": "v"} and got.text == "body"
    page = "<mediawiki><page><ns>0</ns><id>1</id><title>T</title><revision><text bytes='9'>" + "long text " * 8 + "</text></revision></page><page><ns>0</ns><id>2</id><title>R</title><revision><text bytes='9'>#REDIRECT [[T]]</text></revision></page></mediawiki>"
    (tmp_path / "w.xml").write_text(page)
    assert [x.page_id for x in readers.wiki_dump(spark, str(tmp_path / "w.xml")).collect()] == [1]
    dates = spark.createDataFrame([("2020-01-02",), ("3.4.2021".replace("3.4", "03.04"),), ("5 March 2019",), ("2018",), ("?",), (None,)], "d string")
    assert [str(x[0]) for x in dates.select(readers.any_date(F.col("d"))).collect()] == ["2020-01-02", "2021-04-03", "2019-03-05", "2018-01-01", "None", "None"]
    lines = spark.createDataFrame([("p", "\n".join(["x" * 30] * 45 + ["short"]))], "path string, text string")
    assert [x.text.count("\n") + 1 for x in readers.grouped_lines(lines).orderBy("part").collect()] == [20, 20, 5]


def test_more_readers(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<feed><entry><title>A</title><link rel='self' href='x'/><link href='http://a'/><published>2020-01-02T10:00:00Z</published></entry></feed>")
    assert rows(readers.atom(spark, str(tmp_path / "a.xml")).selectExpr("title", "link", "cast(published as string)")) == [("A", "http://a", "2020-01-02")]
    item = {"id": "i1", "isShownAt": "u", "sourceResource": {"title": ["T"], "creator": "C", "date": {"displayDate": "1900"}, "language": [{"name": "Armenian"}], "type": "text", "subject": [{"name": "History of art"}]}}
    (tmp_path / "items.json").write_text(json.dumps(item) + "\n{broken\n")
    got = readers.catalog_items(spark, str(tmp_path / "items.json")).collect()
    assert [(x.item_id, x.title, x.creators, x.date, x.languages, x.category) for x in got] == [("i1", "T", ["C"], "1900", ["Armenian"], "history")]
    (tmp_path / "s.xml").write_text("<r xmlns:oai_dc='o' xmlns:dc='d'><oai_dc:dc><dc:identifier>ark:1</dc:identifier><dc:title>T</dc:title><dc:language>arm</dc:language></oai_dc:dc></r>")
    assert rows(readers.search_records(spark, str(tmp_path / "s.xml"))) == [("ark:1", "T", None, None, "arm")]
    entries = [{"word": "տուն", "lang_code": "hy", "etymology_text": "old", "categories": ["Armenian terms inherited from Old Armenian", "Armenian terms inherited from Old Armenian", "Armenian terms borrowed from Persian"]}, {"word": "house", "lang_code": "en"}]
    (tmp_path / "e.json").write_text("\n".join(map(json.dumps, entries)))
    assert rows(readers.etymologies(spark, str(tmp_path / "e.json"))) == [("տուն", "old", ["inherited:Old Armenian", "borrowed:Persian"], 0.8)]
    pairs = spark.createDataFrame([('[["a", "b"]]',), ('[{"western": "c", "eastern": "d", "confidence": 0.5}]',), ('{"pairs": [["e", "f"], ["g"]]}',)], "value string")
    assert sorted((x.western, x.eastern) for x in readers.letter_pairs(pairs).collect()) == [("a", "b"), ("c", "d"), ("e", "f")]
    (tmp_path / "r.jsonl").write_text("\n".join(json.dumps({"text": c * 120}) for c in "abc"))
    first = readers.resumed_json_lines(spark, str(tmp_path / "r.jsonl"), most=1)
    assert first.count() == 1 and readers.resumed_json_lines(spark, str(tmp_path / "r.jsonl"), first).count() == 2


def test_vector_duplicates_against_every_pair(spark):
    import numpy as np

    r = np.random.default_rng(4)
    v = r.standard_normal((150, 24))
    v = np.concatenate((v, v[:60] + r.standard_normal((60, 24)) * 0.12))
    df = spark.createDataFrame([(i, [float(y) for y in x]) for i, x in enumerate(v)] + [(999, None)], "id long, v array<double>")
    want = {(i, j) for i in range(len(v)) for j in range(i + 1, len(v)) if np.linalg.norm(v[i] - v[j]) <= 0.9}
    got = {(x.a, x.b) for x in retrieval.near_vectors(df, "id", "v", 0.9).collect()}
    assert got <= want and len(got) >= 0.97 * len(want) and len(want) >= 55
    kept = {x.key for x in retrieval.kept_vectors(df, "id", "v", 0.9).where("kept").collect()}
    assert 150 <= len(kept) <= 160 and set(range(150)) <= kept
    near = spark.createDataFrame([(1, [1.0, 0.0]), (2, [2.0, 0.01]), (3, [0.0, 1.0])], "id long, v array<double>")
    assert [(x.a, x.b) for x in retrieval.near_vectors(near, "id", "v", 0.01, angular=True).collect()] == [(1, 2)]


def test_records_and_coverage(spark):
    works = spark.createDataFrame([(1, "a", 1901, "book", True), (2, "b", 1902, "book", False), (3, None, None, None, False)], "work int, author string, year int, kind string, covered boolean").withColumn("words", F.lit(5))
    found = coverage.gaps(works)
    assert {(x.gap_type, x.name, x.priority) for x in found.collect()} == {("author", "b", "high")}
    assert coverage.ranked_gaps(found, 5).count() == 1 and coverage.gaps(works.limit(0)).count() == 0
    assert {(x.facet, x.value): (x.works, x.words) for x in coverage.inventory_summary(works).collect()}["all", "all"] == (3, 5)
    profiles = spark.createDataFrame([("x", 1890, 1910, ["X Y"]), ("z", None, 1950, ["Z"])], "name string, first int, last int, variants array<string>")
    assert [x.name for x in coverage.active_in(profiles, 1900, 1905).collect()] == ["x"] and [x.name for x in coverage.named(profiles, "y").collect()] == ["x"]
    df = spark.createDataFrame([("", "fam", "xx", 2.0), ("t", None, None, 0.5)], "text string, source_family string, dialect string, wa_score double")
    assert [x[0] for x in df.select(records.warnings(df)).collect()] == [["empty text", "unknown dialect: xx", "wa_score out of range"], ["empty source_family"]]
    assert records.must_rebuild(None, {}, 1) and records.must_rebuild(records.signature({"a": 1}), {"a": 2}, 5) and not records.must_rebuild(records.signature({"a": 1, "b": 2}), {"b": 2, "a": 1}, 5)
    assert one(spark, "x y", records.review_id(F.lit(""), F.col("t"), F.lit("b/c")))[0] == "x-y:b-c"


def test_names_languages_and_corrections(spark):
    t = F.col("t")
    names = {"Զարինէ Տափախատեան": True, "Dr. Jane Doe": True, "Jane": False, "այս Գիրքը": False, "J. Doe": False, "Anna Տափախատեան": True, "Annaա Doe": False, "Jane 2 Doe": False, "": False, "A B C D E": False}
    assert {k: one(spark, k, X.plausible_name(t))[0] for k in names} == names
    assert one(spark, None, X.plausible_name(t))[0] is False
    assert [one(spark, "", X.page_language(F.lit(a), F.lit(b)))[0] for a, b in ((0.95, 0.0), (0.5, 0.4), (0.2, 0.5), (0.2, 0.2))] == ["hye", "hye", "eng", "hye+eng"]
    words = spark.createDataFrame([("պահել",), ("հոն",)], "word string")
    tokens = spark.createDataFrame([("պաճել",), ("պահել",), ("abc",), (None,), ("ճոն",)], "token string")
    assert rows(correction.confusion_corrections(tokens, words)) == [("ճոն", "հոն"), ("պաճել", "պահել")]
    assert correction.confusion_corrections(tokens.limit(0), words).count() == 0
    assert [one(spark, w, morphology.with_schwa(t))[0] for w in ("սկիզբ", "գիրք", "բուն")] == ["ըսկիզըբ", "գիրըք", "բուն"]


def test_clusters_of_every_row(spark):
    import numpy as np

    r = np.random.default_rng(1)
    v = np.concatenate([r.normal(c, 0.1, (60, 3)) for c in (0, 4)] + [np.array([[20.0, -20.0, 9.0]])])
    df = spark.createDataFrame([(i, [float(y) for y in x]) for i, x in enumerate(v)] + [(900, None)], "id long, f array<double>")
    for rows_used in (500, 60):
        got = {x.id: x.cluster for x in clustering.clustered(df, "id", "f", eps=0.3, least=4, rows=rows_used).collect()}
        assert len(got) == 121 and got[120] == -1 and len({got[i] for i in range(60)}) == 1 and len({got[i] for i in range(60, 120)}) == 1 and got[0] != got[60]
    assert clustering.clustered(df.limit(0), "id", "f").count() == 0


def test_archives_pages_and_updates(spark, tmp_path):
    import zipfile

    from corpuspark.sources import sinks

    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x.txt", "\n".join(["y" * 30] * 45 + ["short"]))
        z.writestr("empty.txt", "")
        z.writestr("README", "z" * 50)
    got = readers.zipped_lines(spark, str(tmp_path / "a.zip")).orderBy("part").collect()
    assert [x.text.count("\n") + 1 for x in got] == [20, 20, 5] and all(x.path.endswith("a.zip#x.txt") for x in got)
    sinks.write_dashboard(spark.createDataFrame([("a<b", 2, None), ("c", 5, "2020")], "source string, documents int, latest string"), str(tmp_path / "page"))
    page = "\n".join(x.value for x in spark.read.text(str(tmp_path / "page")).collect())
    assert "a&lt;b" in page and page.index("<td>c</td>") < page.index("a&lt;b")
    old = spark.createDataFrame([(1, "x", "y"), (2, None, "z")], "id int, a string, b string")
    assert rows(sinks.with_updates(old, spark.createDataFrame([(2, "new"), (3, "gone"), (1, None)], "id int, a string"), ["id"])) == [(1, "x", "y"), (2, "new", "z")]


def test_stream_equals_batch(spark, tmp_path):
    schema = "source string, text string"
    for i, data in enumerate([[("s", "բառ բառ")], [("s", "բառ նոր"), ("t", "նոր")]]):
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"b{i}"))
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    incremental.start_counts(stream, str(tmp_path / "state"), str(tmp_path / "check")).awaitTermination()
    want = frequency.word_counts(spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in")), ["source"])
    assert rows(incremental.counts_now(spark, str(tmp_path / "state"), 1).select("source", "word", "n")) == rows(want)
    incremental.start_counts(stream, str(tmp_path / "state2"), str(tmp_path / "check2"), fold_after=2).awaitTermination()
    assert (tmp_path / "state2" / "base=000000001").exists()
    assert rows(incremental.counts_now(spark, str(tmp_path / "state2"), 1, fold_after=2).select("source", "word", "n")) == rows(want)


def test_full_buckets_meet_in_a_grid(spark, monkeypatch):
    monkeypatch.setattr(dedup, "HOT_BUCKET", 3)
    bands = spark.createDataFrame([(k, 0, 7) for k in range(12)] + [(k, 1, k) for k in range(12)], "key long, band int, h long")
    assert sorted((x.a, x.b) for x in dedup.bucket_pairs(bands).collect()) == [(a, b) for a in range(12) for b in range(a + 1, 12)]


def test_character_profile_against_all_pairs(spark):
    texts = ["the quick brown fox jumps over the lazy dog again and again until night", "the quick brown fox jumps over the lazy dog again and again until nights", "something else entirely is written here", "abc", "abc", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    _, pairs = dedup.near_classes(dedup.character_prints(df, "doc_id", "text"), 0.85, dedup.CHARACTER_BANDS, dedup.CHARACTER_ROWS)
    assert [(x.a, x.b) for x in pairs.collect()] == [(0, 1)]


def test_candidates_do_not_carry_their_texts(spark, tmp_path):
    import random
    import re

    draw = random.Random(2)
    part = lambda n: "".join(draw.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    form = part(1_500)  # more than half of the runs of any two texts, so they share buckets
    texts = [form + part(800) for _ in range(200)]
    texts += [texts[0][:-3] + "###", texts[1] + "#"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "texts"))
    df = spark.read.parquet(str(tmp_path / "texts"))
    classes = lambda: dedup.near_classes(dedup.character_prints(df, "doc_id", "text"), 0.85, dedup.CHARACTER_BANDS, dedup.CHARACTER_ROWS)[1]
    # an array is estimated at a few bytes, so a join that may broadcast the sets sends them to the driver
    plan = classes()._jdf.queryExecution().executedPlan().toString()
    assert not re.findall(r"BroadcastExchange .*\n.*set#.*", plan)
    sc = spark.sparkContext._jsc.sc()

    def written() -> int:
        sc.listenerBus().waitUntilEmpty(30_000)
        return sc.statusStore().executorSummary("driver").totalShuffleWrite()

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    before = written()
    assert sorted((x.a, x.b) for x in classes().collect()) == [(0, 200), (1, 201)]
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert written() - before < 10 * sum(map(len, texts))


def test_near_classes_in_full_buckets_and_many_cells(spark, monkeypatch):
    import random

    draw, letters = random.Random(3), "abcdefghijklmnopqrstuvwxyz"
    texts = []
    for _ in range(12):
        base = "".join(draw.choice(letters) for _ in range(draw.choice((8, 60, 400))))
        texts += [base, base + "x", base, *("".join(c if draw.random() > p else draw.choice(letters) for c in base) for p in (0.005, 0.01, 0.02, 0.04))]
    sets = [frozenset(t[i : i + 5] for i in range(max(1, len(t) - 4))) for t in texts]
    share = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    firsts = sorted({x: i for i, x in reversed(list(enumerate(sets)))}.values())
    want = {(a, b): round(share(a, b), 6) for a in firsts for b in firsts if a < b and share(a, b) >= 0.85}
    df = spark.createDataFrame([*enumerate(texts), (99, ""), (100, None)], "doc_id long, text string")
    for bucket, shingles, keys in ((1_000, 2_000_000, 500_000), (2, 500, 3)):
        for name, value in (("HOT_BUCKET", bucket), ("BLOCK_SHINGLES", shingles), ("BROADCAST_KEYS", keys)):
            monkeypatch.setattr(dedup, name, value)
        again = lambda keys: dedup.character_prints(dedup.chosen(df, "doc_id", keys), "doc_id", "text")
        members, pairs = dedup.near_classes(dedup.character_prints(df, "doc_id", "text"), 0.85, dedup.CHARACTER_BANDS, dedup.CHARACTER_ROWS, again)
        assert {x.key: x.first for x in members.collect()} == {i: sets.index(x) for i, x in enumerate(sets)}
        assert {(x.a, x.b): x.similarity for x in pairs.collect()} == want and len(want) > 10


def test_signed_score_and_sentences_of_a_grammar(spark):
    western = ["Ան կը խօսի հայերէն, հոն կ՚ապրի մէջ իւրաքանչիւր մանուկ", "մէջ իւրաքանչիւր բան մը", "կը խօսի հայերէն", "Ես կը սիրեմ հայերէն։", "Ես եւ ան կը խօսին միայն հայերէն։", "Ինքզինքս կը սիրեմ։"]
    df = spark.createDataFrame([(x,) for x in [*western, "մի խնձոր ունեմ"]], "text string")
    labels = [x.label for x in classify.classified(df).collect()]
    assert labels == ["likely_western"] * len(western) + ["likely_eastern"]
    t = F.col("t")
    assert one(spark, "կը կը կը", classify.signed_score(t))[0] == 4.0  # matches take the white space between them along
    assert one(spark, "սիրում և գրում", classify.signed_score(t))[0] == -2.0
    assert one(spark, None, classify.signed_score(t))[0] == 0.0
    assert "E" + "A_REGEX_YEV_INTERNAL" not in {x.rule_id for x in one(spark, "ինձևքեզ", classify.evidence(classify.folded(t)))[0]}


def test_core_imports_without_the_training_data_package():
    import subprocess
    import sys

    code = "import sys; sys.modules['corpuspark.llm'] = None; import __spark_entry__ as e; assert len(e.queries()) > 50"
    assert subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__)))).returncode == 0


@pytest.mark.skipif(not os.path.exists(DATA), reason="no test tables")
def test_queries_equal_their_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    from corpuspark.plans.catalog import QUERIES, SQL

    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.sql(f"create view {name.removesuffix('.parquet')} as select * from '{DATA}/{name}'")
    wrong = []
    for name in ("word_frequencies", "frequency_delta", "branch_divergences", "exact_duplicates", "release_split", "crawl_audit", "article_upsert", "branch_classification", "chunks", "nearest_vectors", "user_sessions"):
        want, got = con.sql(SQL[name]).df(), QUERIES[name](spark, DATA).toPandas()
        a, b = (sorted(map(tuple, x[sorted(x.columns)].astype(str).values)) for x in (want, got))
        if sorted(want.columns) != sorted(got.columns) or a != b:
            wrong.append(name)
    assert not wrong


def test_corrections(spark):
    from corpuspark.operators import correction

    counts = spark.createDataFrame([("river", 9), ("rivers", 4), ("rivr", 1), ("rver", 1), ("other", 1), ("ab", 1)], "word string, n long")
    got = {x.word: x.correction for x in correction.corrections(counts).collect()}
    assert got == {"rivr": "river", "rver": "river"}


def test_clusters():
    import numpy as np

    from corpuspark.operators import clustering

    r = np.random.default_rng(1)
    data = np.concatenate([r.normal(0, 0.05, (30, 3)), r.normal(3, 0.05, (30, 3)), [[10.0, -10.0, 10.0]]])
    labels = clustering.dbscan(data, 0.5, 4)
    assert set(labels[:30]) == {0} and set(labels[30:60]) == {1} and labels[60] == -1
    assert len(clustering.sweep(data)) == 15


def test_vector_search_against_brute_force(spark):
    import numpy as np

    from corpuspark.operators import retrieval

    r = np.random.default_rng(3)
    v = r.normal(size=(60, 8))
    df = spark.createDataFrame([(i, [float(x) for x in v[i]]) for i in range(60)] + [(99, None)], "vec_id long, embedding array<double>")
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    got = {(x.query_id, x.vec_id) for x in retrieval.within(df.where("vec_id % 20 = 0"), df, "vec_id", "embedding", 0.9).collect()}
    want = {(q, c) for q in (0, 20, 40) for c in range(60) if q != c and np.linalg.norm(u[q] - u[c]) <= 0.9}
    assert got == want
    near = retrieval.nearest(df.where("vec_id % 20 = 0"), df, "vec_id", "embedding", 3).collect()
    assert {(x.query_id, x.vec_id) for x in near} == {(q, int(c)) for q in (0, 20, 40) for c in [i for i in np.argsort(-(u @ u[q])) if i != q][:3]}
    assert retrieval.nearest(df.limit(0), df, "vec_id", "embedding").count() == 0


def test_more_text_functions(spark):
    t = F.col("t")
    armenian = "\n".join(["Ան կը կարդայ գիրք մը տունին մէջ։"] * 5)
    english = "\n".join(["She reads a book in the house now."] * 5)
    assert one(spark, armenian + "\n" + english, X.armenian_content(t))[0] == armenian
    assert one(spark, english, X.armenian_content(t), X.tri_state(t, F.lit(9.0)))[:] == (None, None)
    both = one(spark, armenian + "\n" + english, X.bilingual(t))[0]
    assert both.is_bilingual and both.own == armenian and both.other == english
    assert one(spark, "մէջ , տուն: ան", X.scan_punctuation(t))[0] == "մէջ, տուն։ ան"
    assert one(spark, "ab c 1", X.scan_quality(t))[0] == 0.5
    html = "<html><title>T</title><h1>Head <b>x</b></h1><a href='http://E.org/a/'>1</a><a href=\"http://e.org/a\">2</a></html>"
    assert one(spark, html, X.page_title(t, F.lit("u")), X.page_links(t))[:] == ("Head x", ["http://e.org/a"])
    assert one(spark, "Հեղինակ՝ Արամ Հայկ", X.stated_authors(t))[0] == ["Արամ Հայկ"]
    assert one(spark, "Յ. Շատ եկաւ տուն", X.stated_authors(t))[0] == []
    assert one(spark, "One two. Three four five. Six.", X.first_tokens(t, 5), X.first_tokens(t, 1))[:] == ("One two. Three four five.", "One")
    assert one(spark, "a.example.org", X.in_domains(t, ["example.org"]))[0]
    assert one(spark, armenian, X.acceptable_layer(t))[0] and not one(spark, None, X.acceptable_layer(t))[0]


def test_more_distances(spark):
    w = spark.createDataFrame([("a", 3), ("b", 1)], "word string, n long")
    e = spark.createDataFrame([("b", 4)], "word string, n long")
    assert distance.mapping_shift(e, spark.createDataFrame([("a", "b")], "western string, eastern string")).first()[0] == 1.0
    pairs = spark.createDataFrame([("a", "b")], "first string, second string")
    assert distance.variant_usage(w, e, pairs).first()[0] == pytest.approx(4 / 6 - 1 / 6)
    c = spark.createDataFrame([("k", "a", 2)], "keyword string, word string, n long")
    d = spark.createDataFrame([("k", "b", 2)], "keyword string, word string, n long")
    assert rows(distance.context_divergence(c, d)) == [("k", 1.0)] and rows(distance.context_divergence(c, c)) == [("k", 0.0)]


def test_sinks(spark, tmp_path):
    from corpuspark.sources import sinks

    df = spark.createDataFrame([(2, "b", "x"), (1, "a", "x"), (3, "", "y"), (4, None, "y")], "doc_id long, text string, tag string")
    sinks.export_sorted(df, str(tmp_path / "s"), "doc_id", "tag", 1)
    assert [r.doc_id for r in spark.read.parquet(str(tmp_path / "s")).collect()] == [1, 2, 3, 4]
    sinks.emit_clean(df, str(tmp_path / "c"), label="tag", wanted="x")
    assert rows(spark.read.json(str(tmp_path / "c"))) == [(1, "a"), (2, "b")]
    sinks.write_report(df, str(tmp_path / "r"))
    assert spark.read.csv(str(tmp_path / "r"), header=True).count() == 4
    assert sinks.replace_report(df, str(tmp_path / "p"), ["doc_id"], 2).count() == 2
    sinks.upsert_table(df.select("doc_id", "tag"), str(tmp_path / "u"), ["doc_id"], 0)
    sinks.upsert_table(spark.createDataFrame([(1, "new")], "doc_id long, tag string"), str(tmp_path / "u"), ["doc_id"], 1)
    assert rows(spark.read.parquet(str(tmp_path / "u" / "v=000001")).where("doc_id = 1").select("tag")) == [("new",)]


def test_ranks_and_running_sums_over_partitions(spark):
    import random

    from corpuspark.operators import order

    r = random.Random(2)
    data = [(r.choice("ab"), i, r.randint(1, 5)) for i in range(3000)]
    df = spark.createDataFrame(data, "g string, v long, n long")
    want, total = {}, {}
    for g, v, n in sorted(data):
        total[g] = total.get(g, 0) + n
        want[g, v] = total[g]
    got = {(x.g, x.v): (x.upto, x["all"]) for x in order.running(df, "g", "v").collect()}
    assert got == {k: (x, total[k[0]]) for k, x in want.items()}
    ranks = {x.v: x["rank"] for x in order.ranked(df, ["n"], ["v"]).collect()}
    assert ranks == {v: i for i, (_, v) in enumerate(sorted((-n, v) for _, v, n in data), 1)}


def test_crawl_audit_means_in_any_order(spark, tmp_path):
    import math
    import random

    from corpuspark.plans.catalog import QUERIES, SQL

    duckdb = pytest.importorskip("duckdb")
    r = random.Random(5)
    odd = {"ties": [0.00015, 0.00015], "none": [None, None], "nan": [math.nan, 0.5], "endless": [math.inf, 0.5], "huge": [1e300, 1e300], "below": [-0.0001, -0.0002], "tiny": [5e-324, 1e-20], "some": [None, 0.25]}
    pairs = odd | {f"p{i}": [r.randrange(99999) / 10000 for _ in range(2)] for i in range(300)}  # two addends: SQL has one sum whatever the order
    many = {f"m{i}": [r.randrange(99999) / 10000 for _ in range(16)] for i in range(300)}

    def pages(domains):
        return [(f"{d}/{i}", d, 200, "x", v, v, None, True) for d, values in domains.items() for i, v in enumerate(values)]

    def audited(data, parts):
        kind = "url string, domain string, status_code int, text string, armenian_char_ratio double, wa_score double, dialect_label string, robots_allowed boolean"
        where = tmp_path / f"{len(data)}_{parts}"
        spark.createDataFrame(data, kind).repartition(parts).write.parquet(str(where / "crawl_results.parquet"))
        return where, {x.domain: (repr(x.mean_ratio), repr(x.mean_score)) for x in QUERIES["crawl_audit"](spark, str(where)).collect()}

    where, got = audited(pages(pairs), 1)
    con = duckdb.connect()
    con.sql(f"create view crawl_results as select * from '{where}/crawl_results.parquet/*.parquet'")
    want = con.sql(f"select domain, mean_ratio, mean_score from ({SQL['crawl_audit']})").fetchall()
    assert got == {d: (repr(a), repr(b)) for d, a, b in want}
    assert got["ties"][0] == "0.0001" and got["none"][0] == "None" and got["nan"][0] == "nan"
    data = pages(many)
    r.shuffle(data)
    exact = {d: repr(math.floor(math.fsum(v) / len(v) * 1e4 + 0.5) / 1e4) for d, v in many.items()}
    for parts in (1, 5):
        assert audited(data, parts)[1] == {d: (x, x) for d, x in exact.items()}
