"""Records, coverage, retrieval of names, sampling, distances and other operators by name."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, functions as F
from pyspark.sql.window import Window

from corpuspark.functions import morphology, text as X
from corpuspark.operators import alignment, classify, correction, coverage, distance, frequency, order, records
from corpuspark.plans.cards import _ratio, _signed
from corpuspark.plans.extras import FUNCTION_WORDS
from corpuspark.plans.frequency import SIDES, TOKENS
from corpuspark.plans.registry import query
from corpuspark.plans.texts import CLASSIFIED
from corpuspark.session import broadcast_if_small, cut, table


def _docs(spark, d):
    return table(spark, d, "documents").where("text is not null")


def _warned(name: str, known) -> str:
    return f"CASE WHEN {name} <> '' AND {name} NOT IN ({', '.join(repr(x) for x in known)}) THEN 'unknown {name}: ' || {name} END"


FIELDS = ("source_language_code", "internal_language_code", "internal_language_branch", "source_type", "content_type", "writing_category")


@query(f"""
SELECT document_id, array_to_string(list_filter([{', '.join(_warned(f, records.KNOWN[f]) for f in FIELDS)}, CASE WHEN confidence_region < 0 OR confidence_region > 1 THEN 'confidence_region out of range' END], lambda x: x IS NOT NULL), '; ') AS warnings FROM text_metadata
""")
def soft_validation(spark, d):
    rows = table(spark, d, "text_metadata")
    return rows.select("document_id", F.array_join(records.warnings(rows), "; ").alias("warnings"))


FLAGS = ("adaptive_dpi", "detect_cursive", "layout_fallback_used", "zone_ocr_used", "vector_tables_appended")


@query(" UNION ALL ".join(f"SELECT '{f}' AS flag, count(*) FILTER ({f}) AS yes, count(*) - count(*) FILTER ({f}) AS no, round(100.0 * count(*) FILTER ({f}) / greatest(count(*), 1), 2) AS pct FROM ocr_page_metrics" for f in FLAGS))
def processing_status(spark, d):
    return records.status(table(spark, d, "ocr_page_metrics"), list(FLAGS))


@query("""
WITH p AS (SELECT DISTINCT url, text, wa_score, internal_language_branch AS b FROM crawl_results),
k AS (SELECT b, CASE WHEN b IS NOT NULL AND b <> '' THEN 'kept' WHEN wa_score IS NOT NULL THEN 'by_score' WHEN coalesce(text, '') <> '' THEN 'by_text' ELSE 'open' END AS how,
 CASE WHEN b IS NOT NULL AND b <> '' THEN b WHEN wa_score IS NOT NULL THEN CASE WHEN wa_score >= 5 THEN 'hye-w' ELSE 'hye-e' END WHEN regexp_matches(coalesce(text, ''), '[Ա-և]') THEN 'hye-e' WHEN coalesce(text, '') <> '' THEN 'eng' END AS branch FROM p)
SELECT how, branch, count(*) AS pages FROM k GROUP BY ALL
""")
def branch_backfill(spark, d):
    """Pages without a branch get one by their score, else by their script; the others keep theirs."""
    p = table(spark, d, "crawl_results").select("url", "text", "wa_score", F.col("internal_language_branch").alias("b")).distinct()
    text, has = F.coalesce("text", F.lit("")), F.col("b").isNotNull() & (F.col("b") != "")
    how = F.when(has, "kept").when(F.col("wa_score").isNotNull(), "by_score").when(text != "", "by_text").otherwise("open")
    branch = F.when(has, F.col("b")).when(F.col("wa_score").isNotNull(), F.when(F.col("wa_score") >= 5, "hye-w").otherwise("hye-e")).when(text.rlike("[Ա-և]"), "hye-e").when(text != "", "eng")
    return p.select(how.alias("how"), branch.alias("branch")).groupBy("how", "branch").agg(F.count(F.lit(1)).alias("pages"))


DIMENSION = (("newspaper", "diaspora", "news"), ("blog", "online", "article"), ("wikipedia_wa", "online", "article"), ("oral", "village", "unknown"))


@query(f"""
WITH v(key, region, category) AS (VALUES {', '.join(str(x) for x in DIMENSION)})
SELECT m.document_id, coalesce(m.region, o.region, k.region) AS region, coalesce(m.writing_category, o.category, k.category) AS writing_category
FROM text_metadata m LEFT JOIN v o ON m.source_name = o.key LEFT JOIN v k ON split_part(m.source_name, ':', 1) = k.key
""")
def source_enrichment(spark, d):
    """Missing regions and categories by source, else by kind of source."""
    dimension = spark.createDataFrame(DIMENSION, "key string, region string, writing_category string")
    rows = table(spark, d, "text_metadata").select("document_id", "source_name", "region", "writing_category")
    return records.enriched(rows, dimension, "source_name", ["region", "writing_category"]).drop("source_name")


@query("SELECT doc_id, title FROM documents WHERE source = (SELECT min(source) FROM documents) AND title IS NOT NULL ORDER BY doc_id LIMIT 100")
def found_documents(spark, d):
    """The first hundred titled documents of one source."""
    docs = table(spark, d, "documents")
    first = docs.agg(F.min("source").alias("source"))
    return docs.join(F.broadcast(first), "source").where("title is not null").select("doc_id", "title").orderBy("doc_id").limit(100)


KEYS = ("source_type", "source_language_code", "internal_language_branch", "content_type", "region")


@query(" UNION ALL ".join(f"SELECT '{k}' AS field, count(DISTINCT {k}) AS n, array_to_string(list_sort(list_distinct(list({k}))), ',') AS every FROM text_metadata" for k in KEYS))
def distinct_values(spark, d):
    """The values of fields that have few."""
    cells = F.explode(F.array(*[F.struct(F.lit(k).alias("field"), F.col(k).alias("v")) for k in KEYS]))
    values = table(spark, d, "text_metadata").select(cells.alias("x")).select("x.field", "x.v").distinct()
    return values.groupBy("field").agg(F.count("v").alias("n"), F.array_join(F.array_sort(F.collect_set("v")), ",").alias("every"))


@query("SELECT doc_id, source FROM documents ORDER BY sha256('sample:' || doc_id), doc_id LIMIT 15")
def sampled_documents(spark, d):
    """Fifteen documents at random, the same ones each time."""
    return table(spark, d, "documents").select("doc_id", "source").orderBy(F.sha2(F.concat(F.lit("sample:"), F.col("doc_id").cast("string")), 256), "doc_id").limit(15)


@query("""
SELECT source, count(*) FILTER (length(text) < 300) AS short, round(avg(length(text)) FILTER (length(text) < 300), 4) AS mean, round(100.0 * count(*) FILTER (length(text) < 300) / count(*), 4) AS pct FROM documents WHERE text IS NOT NULL GROUP BY source
""")
def short_texts_by_source(spark, d):
    short = F.length("text") < 300
    return _docs(spark, d).groupBy("source").agg(F.count_if(short).alias("short"), F.round(F.avg(F.when(short, F.length("text"))), 4).alias("mean"), F.round(100.0 * F.count_if(short) / F.count(F.lit(1)), 4).alias("pct"))


@query("WITH t AS (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL) SELECT a.lang AS first, b.lang AS second FROM t a, t b")
def tag_pairs(spark, d):
    """Ordered pairs of the few tags, each with itself too."""
    tags = cut(table(spark, d, "documents").where("lang is not null").select("lang").distinct())
    return tags.select(F.col("lang").alias("first")).crossJoin(F.broadcast(tags.select(F.col("lang").alias("second"))))


AUTHORS = """a AS (SELECT author, min(CASE language WHEN 'western_armenian' THEN 1 WHEN 'eastern_armenian' THEN 2 ELSE 3 END) AS rank FROM archive_org_texts WHERE author IS NOT NULL AND author LIKE '% %' GROUP BY author)"""


def _authors(spark, d):
    rank = F.when(F.col("language") == "western_armenian", 1).when(F.col("language") == "eastern_armenian", 2).otherwise(3)
    return table(spark, d, "archive_org_texts").where("author like '% %'").groupBy("author").agg(F.min(rank).alias("rank"))


def mentions(docs, authors):
    """(doc_id, author, rank): authors named in texts. Their first words are joined with the texts' words, so no text meets every author; what follows may be inflected."""
    words = docs.select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"[\p{L}]+"), F.lit(0)))).alias("word"))
    first = F.regexp_extract("author", r"[\p{L}]+", 0)
    near = words.join(broadcast_if_small(cut(authors.withColumn("word", first)), 100_000), "word").select("doc_id", "author", "rank").distinct()
    return near.join(docs.select("doc_id", "text"), "doc_id").where(F.col("text").contains(F.col("author"))).select("doc_id", "author", "rank")


@query(f"WITH {AUTHORS}, m AS (SELECT doc_id, author, row_number() OVER (PARTITION BY doc_id ORDER BY rank, author) AS i FROM documents JOIN a ON contains(text, author)) SELECT doc_id, author FROM m WHERE i = 1")
def author_mentions(spark, d):
    """The author a text names: western ones first, then eastern, then others, by name."""
    found = mentions(_docs(spark, d), _authors(spark, d))
    return found.groupBy("doc_id").agg(F.min_by("author", F.struct("rank", "author")).alias("author"))


@query(f"""
WITH {AUTHORS}, m AS (SELECT doc_id, rank, row_number() OVER (PARTITION BY doc_id ORDER BY rank, author) AS i FROM documents JOIN a ON contains(text, author)),
k AS (SELECT d.doc_id, {_signed('d.text')} AS s, CASE m.rank WHEN 1 THEN 'western' WHEN 2 THEN 'eastern' END AS b FROM documents d LEFT JOIN m ON m.doc_id = d.doc_id AND i = 1 WHERE d.text IS NOT NULL),
w AS (SELECT *, coalesce((s >= 5 AND b = 'eastern') OR (NOT s >= 5 AND b = 'western'), false) AS mismatch FROM k)
SELECT doc_id, CASE WHEN s >= 5 THEN 'western' WHEN s < 0 THEN 'eastern' ELSE 'unknown' END AS text_branch, mismatch, round(least(abs(s) / 10, 1.0), 4) AS confidence,
 CASE WHEN mismatch AND s >= 5 AND least(abs(s) / 10, 1.0) >= 0.8 THEN 'ACCEPT' WHEN mismatch THEN 'FLAG' ELSE 'ACCEPT' END AS recommendation FROM w
""")
def author_checks(spark, d):
    """Whether a text is written in the branch of the author it names."""
    docs = _docs(spark, d)
    first = mentions(docs, _authors(spark, d)).groupBy("doc_id").agg(F.min_by("rank", F.struct("rank", "author")).alias("rank"))
    branch = F.when(F.col("rank") == 1, "western").when(F.col("rank") == 2, "eastern")
    scored = classify.once(docs.select("doc_id", "text"), s=classify.signed_score(F.col("text"))).select("doc_id", "s").join(first, "doc_id", "left")
    return scored.select("doc_id", classify.author_check(F.col("s"), branch).alias("x")).select("doc_id", "x.*")


@query("SELECT DISTINCT url, array_to_string(list_filter(list_transform(links_found, lambda x, i: CASE WHEN list_position(links_found, x) = i THEN x END), lambda x: x IS NOT NULL), ' ') AS links FROM crawl_results WHERE links_found IS NOT NULL")
def ordered_links(spark, d):
    """Links of a page without repeats, in order."""
    return table(spark, d, "crawl_results").where("links_found is not null").select("url", F.array_join(F.array_distinct("links_found"), " ").alias("links")).distinct()


@query(f"""
WITH {SIDES}, p AS (SELECT word, n / sum(n) OVER () AS p FROM a), q AS (SELECT word, n / sum(n) OVER () AS q FROM b),
h AS (SELECT word FROM (SELECT word FROM p ORDER BY p DESC, word LIMIT 100) UNION SELECT word FROM (SELECT word FROM q ORDER BY q DESC, word LIMIT 100))
SELECT word, round(abs(coalesce(p, 1e-9) - coalesce(q, 1e-9)), 9) AS gap FROM h LEFT JOIN p USING (word) LEFT JOIN q USING (word) ORDER BY gap DESC, word LIMIT 20
""")
def drifted_words(spark, d):
    """The twenty words whose share differs most between two states."""
    docs = table(spark, d, "documents")
    sides = [cut(frequency.word_counts(docs.where(F.col("lang") == x), [])) for x in ("hyw", "hye")]
    shares = [s.crossJoin(F.broadcast(s.agg(F.sum("n").alias("all")))).select("word", (F.col("n") / F.col("all")).alias(n)) for s, n in zip(sides, "pq")]
    head = shares[0].orderBy(F.desc("p"), "word").limit(100).select("word").union(shares[1].orderBy(F.desc("q"), "word").limit(100).select("word")).distinct()
    rows = head.join(shares[0], "word", "left").join(shares[1], "word", "left")
    gap = F.round(F.abs(F.coalesce("p", F.lit(1e-9)) - F.coalesce("q", F.lit(1e-9))), 9)
    return rows.select("word", gap.alias("gap")).orderBy(F.desc("gap"), "word").limit(20)


@query(f"WITH t AS ({TOKENS}), c AS (SELECT doc_id, source, word, count(*) AS n FROM t WHERE source IS NOT NULL GROUP BY ALL) SELECT doc_id, source, count(*) AS different, CAST(sum(n) AS BIGINT) AS words FROM c GROUP BY ALL")
def document_state(spark, d):
    """What is kept of each document for later changes, by its size."""
    state = frequency.word_counts(_docs(spark, d).where("source is not null"), ["doc_id", "source"])
    return state.groupBy("doc_id", "source").agg(F.count(F.lit(1)).alias("different"), F.sum("n").alias("words"))


MARK = "2024-01-01T00:00:00"


@query(f"WITH t AS ({TOKENS}) SELECT source, word, count(*) AS n FROM t WHERE source IS NOT NULL AND enrichment_date IS NOT NULL GROUP BY ALL")
def merge_after_mark(spark, d):
    """Counts of the documents up to a mark, and those after it merged in: only rows past the mark are read again."""
    docs = _docs(spark, d).where("source is not null and enrichment_date is not null")
    stamp = F.date_format("enrichment_date", "yyyy-MM-dd'T'HH:mm:ss")
    state = frequency.word_counts(docs.where(stamp <= MARK), ["source"])
    change = frequency.word_counts(docs.where(stamp > MARK), ["source"]).withColumnRenamed("n", "change")
    return frequency.merged(state, change, ["source", "word"])


def _compatible() -> str:
    """Characters that compatibility composition changes one by one, of the blocks texts here may hold, with what becomes of them."""
    spans = ((0xA0, 0x2FF), (0x580, 0x590), (0x1E00, 0x2FFF), (0x3000, 0x3040), (0xFB00, 0xFB18), (0xFE30, 0xFE70), (0xFF01, 0xFFEF))
    rows = [(chr(i), unicodedata.normalize("NFKC", chr(i))) for a, b in spans for i in range(a, b) if unicodedata.normalize("NFKC", chr(i)) != chr(i)]
    return ", ".join("('{}', '{}')".format(a.replace("'", "''"), b.replace("'", "''")) for a, b in rows)


NFKC = f"""odd(c, plain) AS (VALUES {_compatible()}), chars AS (SELECT id, unnest(string_split(text, '')) AS c, generate_subscripts(string_split(text, ''), 1) AS i FROM texts WHERE regexp_matches(text, '[^\\x00-\\x7FÀ-žԱ-ֆ։֊А-яЁё«»“”‘’–—]')),
made AS (SELECT id, nfc_normalize(string_agg(coalesce(plain, chars.c), '' ORDER BY i)) AS text FROM chars LEFT JOIN odd USING (c) GROUP BY id),
plain AS (SELECT texts.id, coalesce(made.text, nfc_normalize(texts.text)) AS text FROM texts LEFT JOIN made USING (id))"""
SPACE = r"[\s\x{85}\x{1c}-\x{1f}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


@query(f"WITH texts AS (SELECT doc_id AS id, text FROM documents WHERE text IS NOT NULL), {NFKC} SELECT id AS doc_id, sha256(trim(regexp_replace(text, '{SPACE}', ' ', 'g'), ' ')) AS hash FROM plain")
def content_hashes_all(spark, d):
    """The project's hash of every text."""
    return _docs(spark, d).select("doc_id", X.content_hash(F.col("text")).alias("hash"))


@query(f"""
WITH r AS (SELECT DISTINCT document_id, text, content_hash FROM document_records), texts AS (SELECT document_id AS id, text FROM r WHERE content_hash IS NULL AND coalesce(text, '') <> ''), {NFKC}
SELECT r.document_id, coalesce(r.content_hash, sha256(trim(regexp_replace(plain.text, '{SPACE}', ' ', 'g'), ' '))) AS hash, r.content_hash IS NULL AS filled FROM r LEFT JOIN plain ON plain.id = r.document_id
""")
def hash_backfill(spark, d):
    """Stored hashes, and computed ones where none is stored and there is text."""
    rows = table(spark, d, "document_records").select("document_id", "text", "content_hash").distinct()
    made = F.when(F.coalesce("text", F.lit("")) != "", X.content_hash(F.col("text")))
    return rows.select("document_id", F.coalesce("content_hash", made).alias("hash"), F.col("content_hash").isNull().alias("filled"))


@query(f"""
WITH t AS ({TOKENS}), c AS (SELECT doc_id, word, count(*) AS f FROM t GROUP BY ALL), v AS (SELECT word, count(*) AS df FROM c GROUP BY word ORDER BY sum(f) DESC, word LIMIT 8192), n AS (SELECT count(DISTINCT doc_id) AS n FROM c),
w AS (SELECT doc_id, word, f * (ln((1 + n) / (1 + df)) + 1) AS w FROM c JOIN v USING (word), n), s AS (SELECT doc_id, sqrt(sum(w * w)) AS s FROM w GROUP BY doc_id)
SELECT doc_id, word, round(w / s, 6) AS weight FROM w JOIN s USING (doc_id)
""")
def tfidf_vectors(spark, d):
    """Unit vectors of the 8,192 most frequent words, rarer words weighing more; a row for each word of a text."""
    c = cut(frequency.word_counts(_docs(spark, d), ["doc_id"]))
    v = c.groupBy("word").agg(F.count(F.lit(1)).alias("df"), F.sum("n").alias("all")).orderBy(F.desc("all"), "word").limit(8192).select("word", "df")
    n = c.select("doc_id").distinct().agg(F.count(F.lit(1)).alias("docs"))
    w = c.join(F.broadcast(v), "word").crossJoin(F.broadcast(n)).select("doc_id", "word", (F.col("n") * (F.ln((1 + F.col("docs")) / (1 + F.col("df"))) + 1)).alias("w"))
    s = w.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("s"))
    return w.join(s, "doc_id").select("doc_id", "word", F.round(F.col("w") / F.col("s"), 6).alias("weight"))


@query(r"""
SELECT doc_id, round(CASE WHEN length(text) > 0 THEN length(regexp_replace(text, '[^Ա-և]', '', 'g')) / length(text) ELSE 0.0 END, 6) AS of_all,
 round(CASE WHEN length(trim(text, ' ')) > 0 THEN length(regexp_replace(text, '[^Ա-և]', '', 'g')) / length(trim(text, ' ')) ELSE 0.0 END, 6) AS of_trimmed,
 round(CASE WHEN length(regexp_replace(text, '[^\p{L}]', '', 'g')) > 0 THEN length(regexp_replace(text, '[^Ա-և]', '', 'g')) / length(regexp_replace(text, '[^\p{L}]', '', 'g')) ELSE 0.0 END, 6) AS of_letters FROM documents WHERE text IS NOT NULL
""")
def script_ratios(spark, d):
    """The share of Armenian letters among all characters, those of the trimmed text, and letters."""
    own = F.regexp_count("text", F.lit("[Ա-և]"))
    of = lambda n: F.round(X.share(own, n), 6)
    return _docs(spark, d).select("doc_id", of(F.length("text")).alias("of_all"), of(F.length(F.trim("text"))).alias("of_trimmed"), of(F.regexp_count("text", F.lit(r"\p{L}"))).alias("of_letters"))


WRAPPERS = " .,;:!?«»\"“”'()[]-–—"


@query("SELECT DISTINCT article_id, trim(regexp_replace(coalesce(title, ''), '\\s+', ' ', 'g'), '" + WRAPPERS.replace("'", "''") + "') AS title FROM newspaper_articles".replace("\\\\", "\\"))
def inventory_titles(spark, d):
    """Titles in single spaces without the signs around them."""
    title = F.regexp_replace(F.coalesce("title", F.lit("")), r"\s+", " ")
    return table(spark, d, "newspaper_articles").select("article_id", F.trim(title, F.lit(WRAPPERS)).alias("title")).distinct()


@query(r"""
WITH s AS (SELECT DISTINCT text_id, trim(full_text, ' ' || chr(9) || chr(10) || chr(12) || chr(13)) AS s FROM archive_org_texts WHERE full_text IS NOT NULL),
k AS (SELECT text_id, length(s) AS n, length(regexp_replace(s, '[^԰-֏]', '', 'g')) AS a, length(regexp_replace(s, '[^A-Za-z]', '', 'g')) AS l, length(regexp_replace(s, '[^\p{L}԰-֏]', '', 'g')) AS t, length(regexp_replace(s, '[^|]', '', 'g')) AS p FROM s)
SELECT text_id, round((CASE WHEN n > 0 THEN (a + l) / n ELSE 0.0 END) * 50 + t / greatest(n, 1) * 30 + least(n, 8000) * 0.02 - p * 2, 4) AS score FROM k
""")
def scan_scores(spark, d):
    """How well a scan reads: script, letters and length against the signs that failed tables leave."""
    rows = table(spark, d, "archive_org_texts").where("full_text is not null").select("text_id", F.trim("full_text", F.lit(" \t\n\f\r")).alias("s")).distinct()
    n = F.length("s")
    count = lambda p: F.regexp_count("s", F.lit(p))
    score = X.share(count("[԰-֏]") + count("[A-Za-z]"), n) * 50 + count(r"[\p{L}԰-֏]") / F.greatest(n, F.lit(1)) * 30 + F.least(n, F.lit(8000)) * 0.02 - count(r"\|") * 2
    return rows.select("text_id", F.round(score, 4).alias("score"))


# Words and endings that put a token of a grammar's word list into a category, in the order they are asked.
PARTICLES = ("կը", "մը", "պիտի", "չը", "կու", "ոչ")
ENDINGS = ("ուն", "ներ", "ալ", "ել", "աւ", "էք", "էին", "ալու")
WITHIN = ("մէջ", "տուն", "նոյն")


@query(f"""
WITH w AS (SELECT DISTINCT lower(lemma) AS token FROM lexicon_entries WHERE lemma IS NOT NULL)
SELECT token, CASE WHEN token IN {PARTICLES} THEN 'particle' WHEN token LIKE 'չ%' AND length(token) > 1 THEN 'negative_prefix' WHEN {' OR '.join(f"suffix(token, '{e}')" for e in ENDINGS)} THEN 'morphological_suffix'
 WHEN token LIKE 'կու%' THEN 'present_onset_gu' WHEN token IN {WITHIN} THEN 'dative_within' WHEN token = 'այլեւս' THEN 'negative_conjunction' ELSE 'lexicon' END AS category FROM w
""")
def token_categories(spark, d):
    t = F.col("token")
    ends = F.lit(False)
    for e in ENDINGS:
        ends |= t.endswith(e)
    c = F.when(t.isin(*PARTICLES), "particle").when(t.startswith("չ") & (F.length(t) > 1), "negative_prefix").when(ends, "morphological_suffix")
    c = c.when(t.startswith("կու"), "present_onset_gu").when(t.isin(*WITHIN), "dative_within").when(t == "այլեւս", "negative_conjunction").otherwise("lexicon")
    return table(spark, d, "lexicon_entries").where("lemma is not null").select(F.lower("lemma").alias("token")).distinct().select("token", c.alias("category"))


def _pairs(spark, d):
    return table(spark, d, "lexicon_entries").where("lemma is not null and translation is not null").select("entry_id", F.lower("lemma").alias("a"), F.lower("translation").alias("b")).distinct()


@query(r"""
WITH p AS (SELECT DISTINCT entry_id, lower(lemma) AS a, lower(translation) AS b FROM lexicon_entries WHERE lemma IS NOT NULL AND translation IS NOT NULL),
k AS (SELECT entry_id, a, b, regexp_extract_all(a, '\p{L}+') AS x, regexp_extract_all(b, '\p{L}+') AS y FROM p),
u AS (SELECT entry_id, a, b, x, y, list_distinct(list_concat(x, y)) AS u FROM k),
f AS (SELECT entry_id, a, b, x, y, u, list_transform(u, lambda w: len(list_filter(x, lambda z: z = w))) AS fx, list_transform(u, lambda w: len(list_filter(y, lambda z: z = w))) AS fy FROM u)
SELECT entry_id, round(CASE WHEN len(u) = 0 THEN 1.0 ELSE len(list_intersect(x, y)) / len(u) END, 6) AS jaccard,
 round(CASE WHEN len(x) > 0 AND len(y) > 0 THEN list_sum(list_transform(range(1, len(u) + 1), lambda i: fx[i] * fy[i])) / (sqrt(list_sum(list_transform(fx, lambda z: z * z))) * sqrt(list_sum(list_transform(fy, lambda z: z * z)))) ELSE 0.0 END, 6) AS cosine FROM f
""")
def pair_text_metrics(spark, d):
    """Similarities of two short texts' words, pair by pair."""
    words = lambda c: F.regexp_extract_all(c, F.lit(r"\p{L}+"), F.lit(0))
    k = classify.once(_pairs(spark, d), x=words("a"), y=words("b"))
    k = classify.once(k, u=F.array_union("x", "y"))
    counts = lambda c: F.transform("u", lambda w: F.size(F.filter(c, lambda z: z == w)))
    k = classify.once(k, fx=counts("x"), fy=counts("y"))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, z: a + z)
    dot = total(F.zip_with("fx", "fy", lambda p, q: p * q))
    norm = F.sqrt(total(F.transform("fx", lambda z: z * z))) * F.sqrt(total(F.transform("fy", lambda z: z * z)))
    return k.select(
        "entry_id", F.round(distance.token_jaccard(F.col("x"), F.col("y")), 6).alias("jaccard"), F.round(F.when((F.size("x") > 0) & (F.size("y") > 0), dot / norm).otherwise(0.0), 6).alias("cosine"),
    )


LOAD = "1.0 * abs(length(regexp_replace(a, '[^\\p{L}]', '', 'g')) - length(regexp_replace(b, '[^\\p{L}]', '', 'g'))) + 2.0 * abs(length(regexp_replace(a, '[^ ]', '', 'g')) - length(regexp_replace(b, '[^ ]', '', 'g')))"


@query(f"""
WITH p AS (SELECT DISTINCT entry_id, lower(lemma) AS a, lower(translation) AS b FROM lexicon_entries WHERE lemma IS NOT NULL AND translation IS NOT NULL), l AS (SELECT {LOAD} AS v FROM p)
SELECT count(*) AS pairs, round(avg(v), 6) AS mean, round(median(v), 6) AS median, round(100.0 * count(*) FILTER (v > 0) / count(*), 4) AS above, round(100.0 * count(*) FILTER (v = 0) / count(*), 4) AS none FROM l
""")
def pair_summary(spark, d):
    """Mean, median and shares of the spelling load over all pairs; the median from counted values."""
    v = _pairs(spark, d).select(distance.orthographic_load(F.col("a"), F.col("b")).alias("v"))
    counts = cut(v.groupBy("v").agg(F.count(F.lit(1)).alias("n")))
    every = order.steps(counts, "v", ["n"]).crossJoin(F.broadcast(counts.agg(F.sum("n").alias("all"))))
    at = lambda k: F.min(F.when(F.col("upto_n") >= k, F.col("v")))
    middle = (at(F.floor((F.col("all") + 1) / 2)) + at(F.floor(F.col("all") / 2) + 1)) / 2
    n = F.sum("n")
    part = lambda c: F.round(100.0 * F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)) / n, 4)
    return every.agg(n.alias("pairs"), F.round(F.sum(F.col("v") * F.col("n")) / n, 6).alias("mean"), F.round(middle, 6).alias("median"), part(F.col("v") > 0).alias("above"), part(F.col("v") == 0).alias("none"))


LENGTHS = "len(regexp_extract_all(s, '[Ա-Ֆա-և]+'))"
SPLIT = "unnest(list_filter(list_transform(regexp_split_to_array(text, '[։?!:]+'), lambda x: trim(x, ' ')), lambda x: x <> ''))"


def _js(a: str, b: str, key: str) -> str:
    return f"""SELECT greatest(0.0, least(1.0, coalesce(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2, 0.0))) AS js,
 coalesce(1 - sum(least(na, nb)) / sum(greatest(na, nb)), 0.0) AS wj FROM (SELECT coalesce({a}.n, 0) AS na, coalesce({b}.n, 0) AS nb, coalesce({a}.n, 0) / (SELECT sum(n) FROM {a}) AS p, coalesce({b}.n, 0) / (SELECT sum(n) FROM {b}) AS q FROM {a} FULL JOIN {b} USING ({key}))"""


FW = ", ".join(f"'{w}'" for w in FUNCTION_WORDS)


@query(f"""
WITH t AS (SELECT lang, unnest(list_filter(regexp_extract_all(lower(text), '[Ա-Ֆա-և]+'), lambda x: length(x) >= 2)) AS word FROM documents WHERE lang IN ('hyw', 'hye')),
a AS (SELECT word, count(*) AS n FROM t WHERE lang = 'hyw' GROUP BY word), b AS (SELECT word, count(*) AS n FROM t WHERE lang = 'hye' GROUP BY word), w AS ({_js('a', 'b', 'word')}),
s AS (SELECT lang, {LENGTHS} AS v FROM (SELECT lang, {SPLIT} AS s FROM documents WHERE lang IN ('hyw', 'hye') AND text IS NOT NULL)),
c AS (SELECT v, sum((lang = 'hyw')::INT) AS na, sum((lang = 'hye')::INT) AS nb FROM s GROUP BY v),
g AS (SELECT v, abs(sum(na) OVER (ORDER BY v) / sum(na) OVER () - sum(nb) OVER (ORDER BY v) / sum(nb) OVER ()) * (lead(v) OVER (ORDER BY v) - v) AS area FROM c), z AS (SELECT sum(area) / (max(v) - min(v)) AS d FROM g),
f AS (SELECT lang, list_filter(regexp_extract_all(lower(text), '[Ա-Ֆա-և]+'), lambda x: x IN ({FW})) AS f FROM documents WHERE lang IN ('hyw', 'hye') AND text IS NOT NULL),
r AS (SELECT lang, unnest(list_transform(range(1, len(f)), lambda i: f[i] || ' ' || f[i + 1])) AS bi FROM f), x AS (SELECT bi, count(*) AS n FROM r WHERE lang = 'hyw' GROUP BY bi), y AS (SELECT bi, count(*) AS n FROM r WHERE lang = 'hye' GROUP BY bi), h AS ({_js('x', 'y', 'bi')})
SELECT round(0.4 * w.js + 0.25 * w.wj, 6) AS lexical, round(0.6 * z.d + 0.4 * h.js, 6) AS structural, round(0.65 * (0.4 * w.js + 0.25 * w.wj) + 0.35 * (0.6 * z.d + 0.4 * h.js), 6) AS total FROM w, z, h
""")
def component_distance(spark, d):
    """Lexical and structural distance of the two branches and their weighted sum, without a mapping of forms."""
    docs = _docs(spark, d).where("lang in ('hyw', 'hye')")
    sides = [docs.where(F.col("lang") == x) for x in ("hyw", "hye")]
    lexical = distance.divergences(*[cut(frequency.word_counts(x, [], profile="armenian")) for x in sides]).select("js_bits", "jaccard")
    lengths = [x.select(F.explode(X.sentences(F.col("text"), "marks")).alias("s")).select(F.size(X.words(F.col("s"), "armenian", 1)).alias("value")) for x in sides]
    apart = distance.wasserstein(*lengths)

    def bigrams(docs):
        w = F.filter(X.words(F.col("text"), "armenian", 1), lambda x: x.isin(*FUNCTION_WORDS))
        rows = classify.once(docs.select("text"), w=w).where(F.size("w") > 1)
        two = F.zip_with(F.slice("w", F.lit(1), F.size("w") - 1), F.slice("w", F.lit(2), F.size("w")), lambda a, b: F.concat(a, F.lit(" "), b))
        return rows.select(F.explode(two).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))

    structure = distance.divergences(*[cut(bigrams(x)) for x in sides]).select(F.col("js_bits").alias("bigram_js"))
    return distance.components(lexical.crossJoin(apart).crossJoin(structure))


def _works(spark, d):
    year = F.nullif(F.regexp_extract("publication_date", r"(?:1[5-9]|20)\d{2}", 0), F.lit("")).cast("int")
    words = F.size(F.filter(F.split("full_text", r"\s+"), lambda x: x != ""))
    return table(spark, d, "archive_org_texts").select(
        F.col("text_id").alias("work"), "author", year.alias("year"), F.col("extracted_from_format").alias("kind"), (F.col("full_text").isNotNull() & (F.col("language") == "western_armenian")).alias("covered"), F.coalesce(words, F.lit(0)).alias("words")
    ).distinct().fillna(False, ["covered"])


WORKS = r"""WITH k AS (SELECT DISTINCT text_id AS work, author, try_cast(nullif(regexp_extract(publication_date, '(1[5-9]|20)[0-9]{2}'), '') AS INTEGER) AS year, extracted_from_format AS kind,
 coalesce(full_text IS NOT NULL AND language = 'western_armenian', false) AS covered, coalesce(len(list_filter(regexp_split_to_array(full_text, '\s+'), lambda x: x <> '')), 0) AS words FROM archive_org_texts)"""


def _gap(name: str, value: str, low: float, priority: str) -> str:
    return f"SELECT '{name}' AS gap_type, CAST({value} AS VARCHAR) AS name, count(*) AS works, count(*) FILTER (covered) AS covered, round(count(*) FILTER (covered) / count(*), 6) AS share, {priority} AS priority, count(*) - count(*) FILTER (covered) AS impact FROM k WHERE {value} IS NOT NULL GROUP BY {value} HAVING round(count(*) FILTER (covered) / count(*), 6) < {low}"


GAPS = f"{WORKS} " + " UNION ALL ".join((_gap("author", "author", 0.25, "CASE WHEN count(*) FILTER (covered) = 0 THEN 'high' ELSE 'medium' END"), _gap("period", "year // 10 * 10", 0.3, "'medium'"), _gap("kind", "kind", 0.4, "'low'")))


@query(GAPS)
def coverage_gaps(spark, d):
    return coverage.gaps(cut(_works(spark, d)))


@query(f"SELECT * FROM ({GAPS}) ORDER BY CASE priority WHEN 'high' THEN 1 WHEN 'medium' THEN 2 ELSE 3 END, impact DESC, gap_type, name LIMIT 20")
def first_gaps(spark, d):
    """The twenty gaps to close first."""
    return coverage.ranked_gaps(coverage.gaps(cut(_works(spark, d))), 20)


@query(f"""{WORKS}, f AS (SELECT 'all' AS facet, 'all' AS value, covered, words FROM k UNION ALL SELECT 'kind', kind, covered, words FROM k UNION ALL SELECT 'decade', CAST(year // 10 * 10 AS VARCHAR), covered, words FROM k UNION ALL SELECT 'author', author, covered, words FROM k)
SELECT facet, value, count(*) AS works, count(*) FILTER (covered) AS covered, CAST(coalesce(sum(words) FILTER (covered), 0) AS BIGINT) AS words FROM f WHERE value IS NOT NULL GROUP BY ALL""")
def inventory_summary(spark, d):
    return coverage.inventory_summary(_works(spark, d))


@query(f"""{WORKS}, p AS (SELECT author AS name, min(year) AS first, max(year) AS last FROM k WHERE author IS NOT NULL GROUP BY author) SELECT name, first, last FROM p WHERE coalesce(first, last) <= 1950 AND coalesce(last, first) >= 1900""")
def authors_of_a_period(spark, d):
    """Authors with texts of the first half of the twentieth century."""
    p = _works(spark, d).where("author is not null").groupBy(F.col("author").alias("name")).agg(F.min("year").alias("first"), F.max("year").alias("last"))
    return coverage.active_in(p, 1900, 1950)


@query(r"SELECT DISTINCT concat_ws(':', nullif(trim(source_name), ''), 'crawl', regexp_replace(coalesce(nullif(trim(operation_id), ''), 'none'), '[^\p{L}\p{N}._:-]+', '-', 'g')) AS review_id FROM newspaper_articles".replace("nullif(trim(source_name), '')", r"regexp_replace(nullif(trim(source_name), ''), '[^\p{L}\p{N}._:-]+', '-', 'g')"))
def review_ids(spark, d):
    """One stable name for each source and operation to review."""
    made = records.review_id(F.col("source_name"), F.lit("crawl"), F.coalesce(F.nullif(F.trim("operation_id"), F.lit("")), F.lit("none")))
    return table(spark, d, "newspaper_articles").select(made.alias("review_id")).distinct()


@query("""
SELECT DISTINCT url, (coalesce(dialect_confidence, 0) < 0.35 OR coalesce(armenian_char_ratio, 0) >= 0.3 OR coalesce(wa_score, 0) >= 2.5) AS review FROM crawl_results WHERE status_code = 200
""")
def borderline_pages(spark, d):
    """Pages to look at: an unsure branch, enough script, or half the score that accepts."""
    low = F.coalesce("dialect_confidence", F.lit(0.0)) < 0.35
    due = low | (F.coalesce("armenian_char_ratio", F.lit(0.0)) >= 0.3) | (F.coalesce("wa_score", F.lit(0.0)) >= max(0.5 * classify.WESTERN_SCORE, 1.0))
    return table(spark, d, "crawl_results").where("status_code = 200").select("url", due.alias("review")).distinct()


@query("SELECT document_id FROM text_metadata WHERE document_id NOT IN (SELECT document_id FROM document_records WHERE split = 'test')")
def pending_tasks(spark, d):
    """Records of the metadata that the test split hasn't dealt with."""
    return records.pending(table(spark, d, "text_metadata").select("document_id"), table(spark, d, "document_records").where("split = 'test'"), "document_id")


@query("""
SELECT document_id, coalesce(nullif(regexp_extract(publication_date, '(19|20)[0-9]{2}'), ''), nullif(regexp_extract(publication_date, '[0-9]{4}'), ''), left(publication_date, 50)) AS year FROM text_metadata WHERE publication_date IS NOT NULL
""")
def year_facets(spark, d):
    """The year a date in any form names: one of the last two centuries, else four digits, else its beginning."""
    p = F.col("publication_date")
    found = lambda x: F.nullif(F.regexp_extract(p, x, 0), F.lit(""))
    return table(spark, d, "text_metadata").where(p.isNotNull()).select("document_id", F.coalesce(found(r"(19|20)[0-9]{2}"), found("[0-9]{4}"), F.substring(p, 1, 50)).alias("year"))


@query("""
WITH o AS (SELECT source_name, operation_timestamp AS t, status FROM ingestion_operations WHERE operation_timestamp IS NOT NULL), g AS (SELECT source_name, status, epoch(t) - epoch(lag(t) OVER (PARTITION BY source_name ORDER BY t, status)) AS gap FROM o)
SELECT source_name, count(*) AS operations, count(*) FILTER (status <> 'success') AS failed, round(avg(gap), 3) AS mean_gap FROM g GROUP BY source_name
""")
def operation_telemetry(spark, d):
    """Operations of each source, failures, and the mean time between them: the sum of the gaps is the span, so no source is sorted."""
    t = F.col("operation_timestamp").cast("timestamp").cast("double")
    g = table(spark, d, "ingestion_operations").where("operation_timestamp is not null").groupBy("source_name")
    return g.agg(F.count(F.lit(1)).alias("operations"), F.count_if(F.col("status") != "success").alias("failed"), F.round((F.max(t) - F.min(t)) / F.nullif(F.count(F.lit(1)) - 1, F.lit(0)), 3).alias("mean_gap"))


@query("""
WITH r AS (SELECT doc_id, n_chars, lang, n_chars // 10 AS band, row_number() OVER (PARTITION BY lang, n_chars // 10 ORDER BY n_chars, doc_id) AS i FROM documents WHERE n_chars IS NOT NULL AND lang IN ('hyw', 'hye'))
SELECT a.doc_id AS "left", b.doc_id AS "right", a.n_chars AS left_n, b.n_chars AS right_n FROM r a JOIN r b ON a.band = b.band AND a.i = b.i WHERE a.lang = 'hyw' AND b.lang = 'hye'
""")
def matched_lengths(spark, d):
    """Documents of the two branches paired by near length, each once."""
    docs = table(spark, d, "documents")
    return alignment.matched_by_length(docs.where("lang = 'hyw'"), docs.where("lang = 'hye'"), "doc_id", "n_chars")


@query()
def aligned_sentences(spark, d):
    """Sentences of matched documents aligned by length."""
    docs = _docs(spark, d).select("doc_id", X.sentences(F.col("text"), "marks").alias("s"))
    pairs = matched_lengths(spark, d).select(F.monotonically_increasing_id().alias("pair_id"), "left", "right")
    sides = pairs.join(docs.select(F.col("doc_id").alias("left"), F.col("s").alias("a")), "left").join(docs.select(F.col("doc_id").alias("right"), F.col("s").alias("b")), "right")
    return alignment.aligned(sides.select("pair_id", F.col("a").alias("left"), F.col("b").alias("right")))


@query("SELECT doc_id, len(list_filter(string_split(text, chr(10)), lambda x: trim(x, ' ') <> '' AND {r} >= 0.5)) AS own, len(list_filter(string_split(text, chr(10)), lambda x: trim(x, ' ') <> '' AND {r} < 0.5)) AS other FROM documents WHERE text IS NOT NULL".replace("{r}", _ratio("x")))
def bilingual_lines(spark, d):
    """Lines of either side of texts in two scripts."""
    both = _docs(spark, d).select("doc_id", F.explode(F.array(X.bilingual(F.col("text")))).alias("b"))
    count = lambda c: F.size(F.filter(F.split(c, "\n"), lambda x: F.trim(x) != "")).cast("bigint")
    return both.select("doc_id", count("b.own").alias("own"), count("b.other").alias("other"))


C = morphology.CONSONANTS
NUCLEI = f"greatest(1, len(regexp_extract_all(w, 'ու|[{morphology.VOWELS}]')))"
RARE = " + ".join(f"{x} * length(regexp_replace(w, '[^{c}]', '', 'g'))" for c, x in morphology.RARE_SOUNDS.items())
AFFIX = " + ".join(f"CASE WHEN suffix(w, '{a}') AND length(w) > {len(a)} THEN 0.3 ELSE 0.0 END" for a in morphology.AFFIXES)
BETWEEN = f"array_to_string(list_transform(range(1, length({{r}}) + 1), lambda i: {{r}}[i] || CASE WHEN regexp_matches({{r}}[i], '[{C}]') AND regexp_matches({{r}}[i + 1], '[{C}]') AND NOT ({{r}}[i] = 'ւ' AND i > 1 AND {{r}}[i - 1] IN ('ո', 'ի')) THEN 'ը' ELSE '' END), '')"


@query(f"""
WITH l AS (SELECT DISTINCT entry_id, lower(lemma) AS w FROM lexicon_entries WHERE lemma IS NOT NULL)
SELECT entry_id, round(1.0 + least(0.8 * {NUCLEI}, 3.0) + 0.5 * least(2.0, {RARE}) + 0.5 * least(1.5, coalesce(list_sum(list_transform(regexp_extract_all(w || '#', '([{C}յ]{{2,}})[^{C}յ#]', 1), lambda x: 0.1 * length(x))), 0.0)), 4) AS difficulty, round({AFFIX}, 4) AS affixes FROM l
""")
def word_difficulty(spark, d):
    rows = table(spark, d, "lexicon_entries").where("lemma is not null").select("entry_id", F.lower("lemma").alias("w")).distinct()
    return rows.select("entry_id", F.round(morphology.noun_difficulty(F.col("w")), 4).alias("difficulty"), F.round(morphology.affix_score(F.col("w")), 4).alias("affixes"))


@query(f"""
WITH l AS (SELECT DISTINCT entry_id, lower(lemma) AS w FROM lexicon_entries WHERE lemma IS NOT NULL)
SELECT entry_id, CASE WHEN regexp_matches(w, '^ս[կպտք]') THEN 'ը' || left(w, 2) || {BETWEEN.format(r='substring(w, 3)')} ELSE {BETWEEN.format(r='w')} END AS spoken FROM l
""")
def spoken_lemmas(spark, d):
    """Lemmas with the vowels that are said but not written."""
    rows = table(spark, d, "lexicon_entries").where("lemma is not null").select("entry_id", F.lower("lemma").alias("w")).distinct()
    return rows.select("entry_id", morphology.with_schwa(F.col("w")).alias("spoken"))


@query(r"""
WITH s AS (SELECT DISTINCT text_id, full_text AS t FROM archive_org_texts WHERE full_text IS NOT NULL),
k AS (SELECT text_id, CASE WHEN length(regexp_replace(t, '[^\p{L}]', '', 'g')) > 0 THEN length(regexp_replace(t, '[^Ա-և]', '', 'g')) / length(regexp_replace(t, '[^\p{L}]', '', 'g')) ELSE 0.0 END AS a,
 CASE WHEN length(regexp_replace(t, '[^\p{L}]', '', 'g')) > 0 THEN length(regexp_replace(t, '[^A-Za-z]', '', 'g')) / length(regexp_replace(t, '[^\p{L}]', '', 'g')) ELSE 0.0 END AS b FROM s)
SELECT text_id, CASE WHEN a >= 0.9 THEN 'hye' WHEN b >= 0.9 THEN 'eng' WHEN b > a AND b >= 0.35 THEN 'eng' WHEN a > b AND a >= 0.35 THEN 'hye' ELSE 'hye+eng' END AS language FROM k
""".replace("\\\\", "\\"))
def scan_languages(spark, d):
    """The language each scan should be recognised in, by its scripts."""
    rows = table(spark, d, "archive_org_texts").where("full_text is not null").select("text_id", F.col("full_text").alias("t")).distinct()
    letters = F.regexp_count("t", F.lit(r"\p{L}"))
    share = lambda p: X.share(F.regexp_count("t", F.lit(p)), letters)
    return rows.select("text_id", X.page_language(share("[Ա-և]"), share("[A-Za-z]")).alias("language"))


def _forms(t: str) -> str:
    each = [f"CASE WHEN instr({t}, '{a}') > 0 THEN substring({t}, 1, instr({t}, '{a}') - 1) || '{b}' || substring({t}, instr({t}, '{a}') + 1) END" for pair in correction.CONFUSED for a, b in (pair, pair[::-1])]
    return f"list_filter([{', '.join(each)}], lambda x: x IS NOT NULL)"


@query(f"""
WITH t AS (SELECT DISTINCT unnest(regexp_split_to_array(full_text, '[\\s]+')) AS token FROM archive_org_texts WHERE full_text IS NOT NULL), k AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[Ա-և]+')) AS word FROM documents WHERE text IS NOT NULL),
o AS (SELECT token FROM t WHERE regexp_matches(token, '[԰-֏]') AND token NOT IN (SELECT word FROM k)), f AS (SELECT token, unnest({_forms('token')}) AS word FROM o)
SELECT token, min(word) AS correction FROM f WHERE word IN (SELECT word FROM k) GROUP BY token HAVING count(*) = 1
""".replace("\\\\", "\\"))
def confusion_corrections(spark, d):
    """Tokens of scans that are no word of the documents, and the one word that undoing a confusion makes of each."""
    tokens = table(spark, d, "archive_org_texts").where("full_text is not null").select(F.explode(F.split("full_text", r"\s+")).alias("token"))
    known = _docs(spark, d).select(F.explode(F.regexp_extract_all("text", F.lit("[Ա-և]+"), F.lit(0))).alias("word")).distinct()
    return correction.confusion_corrections(tokens, known)


@query("""
WITH p AS (SELECT author, min(try_cast(nullif(regexp_extract(publication_date, '(1[5-9]|20)[0-9]{2}'), '') AS INTEGER)) AS y FROM archive_org_texts WHERE author IS NOT NULL GROUP BY author)
SELECT CASE WHEN y IS NULL THEN 'unknown' WHEN y < 1870 THEN 'before 1870' WHEN y < 1890 THEN '1870 to 1889' WHEN y < 1920 THEN '1890 to 1919' WHEN y < 1950 THEN '1920 to 1949' WHEN y < 1975 THEN '1950 to 1974' ELSE 'from 1975' END AS generation,
 coalesce(CAST(y // 25 * 25 AS VARCHAR), 'unknown') AS quarter, count(*) AS authors FROM p GROUP BY ALL
""")
def author_generations(spark, d):
    """Authors by generation and quarter of a century of their first text."""
    year = F.nullif(F.regexp_extract("publication_date", r"(?:1[5-9]|20)\d{2}", 0), F.lit("")).cast("int")
    p = table(spark, d, "archive_org_texts").where("author is not null").groupBy("author").agg(F.min(year).alias("y"))
    quarter = F.coalesce((F.floor(F.col("y") / 25) * 25).cast("string"), F.lit("unknown"))
    return p.groupBy(coverage.generation(F.col("y")).alias("generation"), quarter.alias("quarter")).agg(F.count(F.lit(1)).alias("authors"))


@query(f"""
WITH m AS (SELECT * FROM text_metadata), r AS (SELECT document_id, min(text) AS text, min(source_family) AS source_family FROM document_records WHERE text IS NOT NULL GROUP BY document_id),
t AS (SELECT unnest(list_filter(regexp_extract_all(lower(text), '[Ա-Ֆա-ֆ]+'), lambda x: length(x) >= 2)) AS word, r.source_family, m.internal_language_branch AS branch, m.region, m.writing_category, regexp_extract(m.publication_date, '(19|20)[0-9]{{2}}') AS year FROM r JOIN m USING (document_id)),
f AS (SELECT 'source' AS facet, source_family AS facet_value, word FROM t UNION ALL SELECT 'branch', branch, word FROM t UNION ALL SELECT 'region', region, word FROM t UNION ALL SELECT 'category', writing_category, word FROM t UNION ALL SELECT 'year', year, word FROM t)
SELECT facet, facet_value, count(DISTINCT word) AS different, count(*) AS words FROM f WHERE facet_value IS NOT NULL AND facet_value <> '' GROUP BY ALL
""")
def record_facets(spark, d):
    """Words of the records along five facets, by facet value."""
    r = table(spark, d, "document_records").where("text is not null").groupBy("document_id").agg(F.min("text").alias("text"), F.min("source_family").alias("source_family"))
    m = table(spark, d, "text_metadata").select("document_id", F.col("internal_language_branch").alias("branch"), "region", "writing_category", F.regexp_extract("publication_date", r"(19|20)[0-9]{2}", 0).alias("year"))
    values = {"source": F.col("source_family"), "branch": F.col("branch"), "region": F.col("region"), "category": F.col("writing_category"), "year": F.col("year")}
    words = frequency.facets(r.join(m, "document_id"), values)
    return words.groupBy("facet", "facet_value").agg(F.count(F.lit(1)).alias("different"), F.sum("n").alias("words"))


EXPORTED = ("title", "source_url", "content_hash", "internal_language_code", "internal_language_branch", "split")
METADATA = ("source_type", "source_language_code", "dialect_subcategory", "extraction_date", "publication_date", "region", "source_name", "content_type", "writing_category", "processor_version")


@query(f"""
WITH r AS (SELECT DISTINCT document_id, source_family, text, {', '.join(EXPORTED)} FROM document_records WHERE coalesce(text, '') <> '')
SELECT r.document_id, coalesce(nullif(source_family, ''), 'unknown') AS source_family, r.text, {', '.join(f"coalesce(nullif(r.{c}, ''), '') AS {c}" for c in EXPORTED)}, {', '.join(f"coalesce(nullif(m.{c}, ''), '') AS {c}" for c in METADATA)},
 length(r.text) AS char_count, len(regexp_extract_all(r.text, '\\S+')) AS word_count, coalesce(m.confidence_region, 0.0) AS confidence_region, m.document_id IS NOT NULL AS has_metadata FROM r LEFT JOIN text_metadata m USING (document_id)
""".replace("\\\\", "\\"))
def exported_records(spark, d):
    """Records with text and their metadata as flat rows of 23 columns; blanks count as missing."""
    r = table(spark, d, "document_records").where("coalesce(text, '') <> ''").select("document_id", "source_family", "text", *EXPORTED).distinct()
    m = table(spark, d, "text_metadata").select("document_id", *METADATA, "confidence_region", F.lit(True).alias("has_metadata"))
    rows = r.join(m, "document_id", "left")
    blank = lambda c, other="": F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(other)).alias(c)
    return rows.select(
        "document_id", blank("source_family", "unknown"), "text", *[blank(c) for c in (*EXPORTED, *METADATA)], F.length("text").cast("bigint").alias("char_count"),
        F.regexp_count("text", F.lit(r"\S+")).cast("bigint").alias("word_count"), F.coalesce("confidence_region", F.lit(0.0)).alias("confidence_region"), F.coalesce("has_metadata", F.lit(False)).alias("has_metadata"),
    )


@query()
def plausible_authors(spark, d):
    """Authors as written, and whether they can be names."""
    return table(spark, d, "archive_org_texts").where("author is not null").select("author").distinct().select("author", X.plausible_name(F.col("author")).alias("plausible"))


@query("""
WITH a AS (SELECT article_id, content, content_sha1, row_number() OVER (PARTITION BY content_sha1 ORDER BY article_id, scraped_timestamp) AS i FROM newspaper_articles)
SELECT CASE WHEN coalesce(trim(content), '') = '' OR content_sha1 IS NULL THEN 'error' WHEN i > 1 THEN 'duplicate' ELSE 'inserted' END AS outcome, count(*) AS rows FROM a GROUP BY 1
""")
def insert_outcomes(spark, d):
    """What becomes of articles put in one by one: without text they fail, with a hash already there they are skipped."""
    a = table(spark, d, "newspaper_articles")
    bad = (F.coalesce(F.trim("content"), F.lit("")) == "") | F.col("content_sha1").isNull()
    each = a.where(F.col("content_sha1").isNotNull()).groupBy("content_sha1").agg(F.count(F.lit(1)).alias("n"), F.count_if(~bad).alias("good"), F.min_by(bad, F.struct("article_id", "scraped_timestamp")).alias("first_bad"))
    # the first of a hash is in, the rest are duplicates; rows without text fail wherever they stand
    split = each.agg(F.coalesce(F.sum(F.when(~F.col("first_bad"), 1).otherwise(0)), F.lit(0)).alias("inserted"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"))
    total = split.crossJoin(a.agg(F.count_if(bad).alias("error")))
    cells = F.array(*[F.struct(F.lit(k).alias("outcome"), v.cast("bigint").alias("rows")) for k, v in (("error", F.col("error")), ("inserted", F.col("inserted")), ("duplicate", F.col("good") - F.col("inserted")))])
    return total.select(F.explode(cells).alias("x")).select("x.*").where("rows > 0")


@query(f"""
WITH c AS (SELECT * FROM ({CLASSIFIED}) WHERE western + eastern + classical <> 0),
r AS (SELECT doc_id, label, confidence, CASE WHEN label = 'inconclusive' THEN 'inconclusive' WHEN confidence < 0.35 THEN 'low_confidence' WHEN abs(western - eastern) < 2.0 THEN 'small_margin' END AS reason FROM c)
SELECT doc_id, reason, CASE reason WHEN 'inconclusive' THEN 1 WHEN 'low_confidence' THEN 2 ELSE 3 END AS priority FROM r WHERE reason IS NOT NULL ORDER BY priority, doc_id LIMIT 50
""")
def review_listing(spark, d):
    """The first fifty texts to review, by reason, then by number."""
    c = classify.classified(_docs(spark, d).select("doc_id", "text")).where("western + eastern + classical <> 0")
    reason = F.when(F.col("label") == "inconclusive", "inconclusive").when(F.col("confidence") < 0.35, "low_confidence").when(F.abs(F.col("western") - F.col("eastern")) < 2.0, "small_margin")
    priority = F.when(F.col("reason") == "inconclusive", 1).when(F.col("reason") == "low_confidence", 2).otherwise(3)
    return c.select("doc_id", reason.alias("reason")).where("reason is not null").select("doc_id", "reason", priority.alias("priority")).orderBy("priority", "doc_id").limit(50)


@query(f"""
WITH t AS ({TOKENS}), c AS (SELECT lang, word, count(*) AS n FROM t WHERE lang IS NOT NULL GROUP BY ALL), p AS (SELECT lang, word, n, n / sum(n) OVER (PARTITION BY lang) AS p FROM c),
k AS (SELECT a.lang AS first, b.lang AS second, sum(a.p * log2(2 * a.p / (a.p + b.p)) + b.p * log2(2 * b.p / (a.p + b.p))) AS s, sum(a.p) AS sa, sum(b.p) AS sb FROM p a JOIN p b ON a.word = b.word GROUP BY ALL),
l AS (SELECT DISTINCT lang FROM c)
SELECT x.lang AS first, y.lang AS second, round(greatest(0.0, (coalesce(s, 0) + 1 - coalesce(sa, 0) + 1 - coalesce(sb, 0)) / 2), 6) AS js FROM l x CROSS JOIN l y LEFT JOIN k ON k.first = x.lang AND k.second = y.lang
""")
def tag_distances(spark, d):
    """Jensen-Shannon distance of the word shares of every ordered pair of tags, each with itself too; only words of both need to meet."""
    c = cut(frequency.word_counts(_docs(spark, d).where("lang is not null"), ["lang"]))
    p = c.join(F.broadcast(c.groupBy("lang").agg(F.sum("n").alias("all"))), "lang").select("lang", "word", (F.col("n") / F.col("all")).alias("p"))
    a, b = p.select(F.col("lang").alias("first"), "word", "p"), p.select(F.col("lang").alias("second"), "word", F.col("p").alias("q"))
    both = F.col("p") * F.log2(2 * F.col("p") / (F.col("p") + F.col("q"))) + F.col("q") * F.log2(2 * F.col("q") / (F.col("p") + F.col("q")))
    shared = a.join(b, "word").groupBy("first", "second").agg(F.sum(both).alias("s"), F.sum("p").alias("sa"), F.sum("q").alias("sb"))
    tags = cut(c.select("lang").distinct())
    every = tags.select(F.col("lang").alias("first")).crossJoin(F.broadcast(tags.select(F.col("lang").alias("second")))).join(shared, ["first", "second"], "left").fillna(0.0)
    return every.select("first", "second", F.round(F.greatest(F.lit(0.0), (F.col("s") + 2 - F.col("sa") - F.col("sb")) / 2), 6).alias("js"))
