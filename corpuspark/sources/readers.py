"""Readers that give the record shapes the operators take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from corpuspark.functions.text import redirects, wikitext


def text_tree(spark: SparkSession, path: str, suffix: str = "*.txt") -> DataFrame:
    """(path, text): whole files of a tree."""
    rows = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", suffix).text(path, wholetext=True)
    return rows.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def json_lines(spark: SparkSession, path: str) -> DataFrame:
    """(key, text) of JSON lines whose text is in text, content or raw_content; malformed lines and lines without text are skipped."""
    schema = T.StructType([T.StructField(x, T.StringType()) for x in ("text", "content", "raw_content")])
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    text = F.coalesce(*[F.nullif(F.col(x), F.lit("")) for x in ("text", "content", "raw_content")])
    return rows.select(text.alias("text")).where("text is not null").select(F.sha1(F.substring("text", 1, 200)).alias("key"), "text")


def wiki_dump(spark: SparkSession, path: str, least: int = 50) -> DataFrame:
    """(page_id, title, text) of a MediaWiki XML dump: articles only, no redirects, cleaned texts of at least `least` characters."""
    revision = T.StructType([T.StructField("text", T.StructType([T.StructField("_VALUE", T.StringType())]))])
    schema = T.StructType([T.StructField("ns", T.LongType()), T.StructField("id", T.LongType()), T.StructField("title", T.StringType()), T.StructField("revision", revision)])
    rows = spark.read.format("xml").option("rowTag", "page").option("attributePrefix", "_").schema(schema).load(path)
    raw = F.col("revision.text._VALUE")
    rows = rows.where((F.col("ns") == 0) & raw.isNotNull() & ~redirects(raw))
    return rows.select(F.col("id").alias("page_id"), "title", wikitext(raw).alias("text")).where(F.length("text") >= least)


def catalog_tsv(spark: SparkSession, path: str, language: str = "arm") -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True).where(F.col("language") == language)


def feed(spark: SparkSession, path: str) -> DataFrame:
    """(title, link, published) of RSS items."""
    schema = T.StructType([T.StructField(x, T.StringType()) for x in ("title", "link", "pubDate")])
    rows = spark.read.format("xml").option("rowTag", "item").schema(schema).load(path)
    return rows.select("title", "link", any_date(F.col("pubDate")).alias("published"))


def headed_texts(texts: DataFrame, marker: str = "BEGIN_DOCUMENT_CONTENT") -> DataFrame:
    """(path, properties, text) of texts that start with key=value lines up to a marker line; without a marker all is text."""
    parts = F.split(F.col("text"), marker, 2)
    lines = F.filter(F.split(parts[0], "\n"), lambda x: x.contains("="))
    pairs = F.transform(lines, lambda x: F.struct(F.trim(F.substring_index(x, "=", 1)).alias("k"), F.trim(F.regexp_replace(x, "^[^=]*=", "")).alias("v")))
    has = F.size(parts) > 1
    return texts.select("path", F.when(has, F.map_from_entries(pairs)).alias("properties"), F.regexp_replace(F.when(has, parts[1]).otherwise(F.col("text")), r"^\s+|\s+$", "").alias("text"))


def lexicon_forms(lexicon: DataFrame, inflections: DataFrame) -> DataFrame:
    """(entry_id, lemma, form, inflection) of nested lexemes -> lemmas -> word forms, inflection ids resolved by a left join."""
    lemmas = lexicon.select(F.explode_outer("lemmas").alias("l"))
    forms = lemmas.select("l.lemmaId", "l.lemmaString", F.explode_outer("l.wordForms").alias("f"))
    flat = forms.select(F.col("lemmaId").alias("entry_id"), F.col("lemmaString").alias("lemma"), F.col("f.s").alias("form"), F.col("f.i").alias("id"))
    return flat.join(inflections.select("id", "inflection"), "id", "left").select("entry_id", "lemma", "form", "inflection").distinct()


def grouped_lines(texts: DataFrame, least: int = 30, size: int = 20) -> DataFrame:
    """(path, part, text): `size` consecutive lines of at least `least` characters per document, made inside each row."""
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.trim(x)) >= least)
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.greatest(F.size(lines), F.lit(1)) - 1) / size).cast("int")), lambda i: F.array_join(F.slice(lines, i * size + 1, size), "\n"))
    return texts.where(F.size(lines) > 0).select("path", F.posexplode(parts).alias("part", "text"))


def zipped_lines(spark: SparkSession, path: str, least: int = 30, size: int = 20) -> DataFrame:
    """(path, part, text): `size` consecutive lines of at least `least` characters per document, of the text files in zip archives.

    An archive is opened where it is read and its lines leave it in groups, so no whole text is held.
    """
    import io
    import zipfile

    import pandas as pd

    def run(batches):
        for pdf in batches:
            for where, content in zip(pdf["path"], pdf["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for name in sorted(n for n in archive.namelist() if not n.endswith("/") and not n.upper().endswith(("README", "LICENSE", ".XML"))):
                        out, lines = [], []
                        with archive.open(name) as member:
                            for line in io.TextIOWrapper(member, "utf-8", errors="replace"):
                                if len(line := line.strip()) >= least:
                                    lines.append(line)
                                if len(lines) == size:
                                    out.append((f"{where}#{name}", len(out), "\n".join(lines)))
                                    lines = []
                        out += [(f"{where}#{name}", len(out), "\n".join(lines))] if lines else []
                        yield pd.DataFrame(out, columns=["path", "part", "text"]) if out else pd.DataFrame({"path": pd.Series(dtype=object), "part": pd.Series(dtype="int64"), "text": pd.Series(dtype=object)})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path)
    return files.select("path", "content").mapInPandas(run, "path string, part bigint, text string")


def binaries(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)


def any_date(value):
    """A date out of several written forms, null if none fits; only the year known gives its first day."""
    text = F.regexp_replace(F.trim(value), r"^[A-Za-z]{3},\s*", "")
    forms = ["yyyy-MM-dd", "dd.MM.yyyy", "dd/MM/yyyy", "d MMMM yyyy", "MMMM d, yyyy", "d MMM yyyy HH:mm:ss Z", "yyyy/MM/dd"]
    iso = F.try_to_timestamp(F.regexp_extract(text, r"^(\d{4}-\d\d-\d\d)", 1), F.lit("yyyy-MM-dd"))
    year = F.try_to_timestamp(F.regexp_extract(text, r"^(\d{4})$", 1), F.lit("yyyy"))
    return F.to_date(F.coalesce(iso, *[F.try_to_timestamp(text, F.lit(f)) for f in forms], year))


def atom(spark: SparkSession, path: str) -> DataFrame:
    """(title, link, published) of Atom entries; the link is the one that stands for the entry itself."""
    link = T.StructType([T.StructField("_href", T.StringType()), T.StructField("_rel", T.StringType())])
    schema = T.StructType([T.StructField("title", T.StringType()), T.StructField("link", T.ArrayType(link)), T.StructField("published", T.StringType()), T.StructField("updated", T.StringType())])
    rows = spark.read.format("xml").option("rowTag", "entry").option("attributePrefix", "_").schema(schema).load(path)
    own = F.filter("link", lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
    return rows.select("title", F.coalesce(F.get(own, 0)["_href"], F.get(F.col("link"), 0)["_href"]).alias("link"), any_date(F.coalesce("published", "updated")).alias("published"))


def resumed_json_lines(spark: SparkSession, path: str, done: DataFrame | None = None, least: int = 100, most: int | None = None) -> DataFrame:
    """(key, text) of JSON lines of at least `least` characters that are not among the keys done; at most `most` if asked, the first by key."""
    rows = json_lines(spark, path).where(F.length("text") >= least).dropDuplicates(["key"])
    rows = rows.join(done.select("key").distinct(), "key", "left_anti") if done is not None else rows
    return rows.orderBy("key").limit(most) if most is not None else rows


# Words in a catalogue's type or subject that tell the category of an item, in the order they are asked.
CATEGORIES = (("manuscript", "manuscript"), ("periodical", "news"), ("newspaper", "news"), ("journal", "academic"), ("thesis", "academic"), ("liturg", "liturgical"), ("fiction", "fiction"), ("poet", "literature"), ("history", "history"), ("book", "book"))


def category_of(words: Column) -> Column:
    """The category that the first known word in a text of types and subjects tells, unknown without one."""
    low = F.lower(F.coalesce(words, F.lit("")))
    out = None
    for word, category in CATEGORIES:
        out = F.when(low.contains(word), category) if out is None else out.when(low.contains(word), category)
    return out.otherwise("unknown")


def catalog_items(spark: SparkSession, path: str) -> DataFrame:
    """(item_id, title, creators, date, languages, category, url) of a union catalogue's items in JSON lines; fields come as a value or a list."""
    rows = spark.read.option("mode", "DROPMALFORMED").text(path).select(F.col("value").alias("j")).where("j <> ''")
    one = lambda p: F.get_json_object("j", p)

    def many(p):
        raw = one(p)
        return F.when(raw.startswith("["), F.from_json(raw, "array<string>")).when(raw.isNotNull(), F.array(raw)).otherwise(F.array().cast("array<string>"))

    title = F.get(many("$.sourceResource.title"), 0)
    kinds = F.concat_ws(" ", many("$.sourceResource.type"), many("$.sourceResource.format"), F.transform(F.coalesce(F.from_json(one("$.sourceResource.subject"), "array<struct<name:string>>"), F.array().cast("array<struct<name:string>>")), lambda x: x["name"]))
    languages = F.transform(F.coalesce(F.from_json(one("$.sourceResource.language"), "array<struct<name:string>>"), F.array().cast("array<struct<name:string>>")), lambda x: x["name"])
    out = rows.select(one("$.id").alias("item_id"), title.alias("title"), many("$.sourceResource.creator").alias("creators"), F.coalesce(one("$.sourceResource.date.displayDate"), one("$.sourceResource.date[0].displayDate")).alias("date"), languages.alias("languages"), category_of(kinds).alias("category"), one("$.isShownAt").alias("url"))
    return out.where("item_id is not null")


def search_records(spark: SparkSession, path: str) -> DataFrame:
    """(identifier, title, creator, date, language) of the records of a library's XML search answers, in Dublin Core."""
    names = ("identifier", "title", "creator", "date", "language")
    schema = T.StructType([T.StructField(f"dc:{n}", T.ArrayType(T.StringType())) for n in names])
    rows = spark.read.format("xml").option("rowTag", "oai_dc:dc").option("ignoreNamespace", "false").schema(schema).load(path)
    return rows.select(*[F.get(F.col(f"`dc:{n}`"), 0).alias(n) for n in names])


def etymologies(spark: SparkSession, path: str, language: str = "hy") -> DataFrame:
    """(lemma, etymology, relations, confidence) of a dictionary dump in JSON lines: one language, the last entry of a lemma wins.

    relations are what the categories name as origin: inherited, borrowed or derived from a language, each once in order.
    """
    schema = "word string, lang_code string, etymology_text string, categories array<string>"
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path).where((F.col("lang_code") == language) & (F.trim("word") != ""))
    found = lambda kind: F.transform(F.filter("categories", lambda c: c.rlike(f"(?i){kind} from ")), lambda c: F.concat(F.lit(f"{kind}:"), F.regexp_extract(c, f"(?i){kind} from (.+)$", 1)))
    relations = F.coalesce(F.array_distinct(F.concat(found("inherited"), found("borrowed"), found("derived"))), F.array().cast("array<string>"))
    rows = rows.select(F.lower(F.trim("word")).alias("lemma"), "etymology_text", relations.alias("relations"), F.monotonically_increasing_id().alias("at"))
    return rows.groupBy("lemma").agg(F.max_by(F.struct(F.col("etymology_text").alias("etymology"), "relations"), "at").alias("x")).select("lemma", "x.etymology", "x.relations", F.lit(0.8).alias("confidence"))


def letter_pairs(payloads: DataFrame) -> DataFrame:
    """(western, eastern, confidence, source) of JSON payloads (value) in any of three shapes: a list of pairs, a list of objects, or an object with such a list as pairs."""
    objects = "array<struct<western:string,eastern:string,confidence:double,source:string>>"
    inner = F.coalesce(F.get_json_object("value", "$.pairs"), F.col("value"))
    as_lists = F.transform(F.from_json(inner, "array<array<string>>"), lambda x: F.struct(F.get(x, 0).alias("western"), F.get(x, 1).alias("eastern"), F.lit(None).cast("double").alias("confidence"), F.lit(None).cast("string").alias("source")))
    as_objects = F.from_json(inner, objects)
    listed = inner.rlike(r"^\s*\[\s*\[")
    rows = payloads.select(F.explode(F.when(listed, as_lists).otherwise(as_objects)).alias("x"))
    return rows.select("x.*").where("western is not null and eastern is not null")
