"""JSON inputs. Schemas are given, never inferred: an object with verse keys is a map, not a row."""

from __future__ import annotations

import json
import os
import shutil
import urllib.request

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.functions.text import parse_key, verse_key
from lectern.sources.json_split import elements

_POSITION = "array<struct<surah:int,ayah:int>>"
#: Dimensions of a marker document and the columns they fill.
DIMENSIONS = {"page": "page_number", "juz": "juz_number", "hizb": "hizb_number", "rub_el_hizb": "rub_el_hizb", "ruku": "ruku_number"}
MARKERS = f"struct<{','.join(f'{d}:{_POSITION}' for d in (*DIMENSIONS, 'sajda'))}>"
PAYLOAD = "struct<data:struct<edition:struct<englishName:string,name:string>,surahs:array<struct<number:int,ayahs:array<struct<numberInSurah:int,text:string>>>>>>"


def _document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("j"))


def _large(spark: SparkSession, path: str) -> bool:
    """Whether a document is more than one task should read; then it is split."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    size = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(where).getLength()
    return size > spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))


def _items(spark: SparkSession, path: str, keys: tuple[str, ...], schema: str) -> DataFrame:
    """(keys of `elements`, n, level, j) of a large document's elements below these keys; j is the parsed value."""
    found = elements(spark, path, len(keys) + 1)
    for i, k in enumerate(keys, 1):
        found = found.where(F.col(f"k{i}") == k) if k else found
    return found.withColumn("j", F.from_json(F.concat(F.lit('{"v":'), "json", F.lit("}")), f"struct<v:{schema}>", {"mode": "FAILFAST"})["v"])


def download(url: str, path: str, timeout: float = 60) -> str:
    """Saves the JSON document at a URL; nothing is left at path if it does not arrive whole or is no JSON."""
    draft = f"{path}.part"
    try:
        with urllib.request.urlopen(url, timeout=timeout) as answer, open(draft, "wb") as f:
            shutil.copyfileobj(answer, f)
        with open(draft, encoding="utf-8") as f:
            json.load(f)
        os.replace(draft, path)
    finally:
        if os.path.exists(draft):
            os.remove(draft)
    return path


def verse_map(spark: SparkSession, path: str) -> DataFrame:
    """(surah, ayah, text) of an object "c:v" -> text."""
    if _large(spark, path):
        rows = _items(spark, path, (), "string").select(F.col("k1").alias("key"), F.col("j").alias("text"))
    else:
        rows = _document(spark, path, "map<string,string>").select(F.explode("j").alias("key", "text"))
    chapter, verse = parse_key(F.col("key"))
    return rows.select(chapter.alias("surah"), verse.alias("ayah"), "text")


def marker_document(spark: SparkSession, path: str) -> DataFrame:
    """(dimension, n, surah, ayah): n counts from 1 in the order of the list. Absent dimensions have no rows."""
    if _large(spark, path):
        rows = _items(spark, path, ("",), "struct<surah:int,ayah:int>").where(F.col("k1").isin([*DIMENSIONS, "sajda"]) & (F.col("level") == 2))
        first = rows.groupBy(F.col("k1").alias("dimension")).agg(F.min("n").alias("first"))  # a row per dimension
        return rows.join(F.broadcast(first), F.col("k1") == F.col("dimension")).select("dimension", (F.col("n") - F.col("first") + 1).cast("int").alias("n"), "j.surah", "j.ayah")
    doc = _document(spark, path, MARKERS)
    one = lambda d: doc.where(F.col(f"j.{d}").isNotNull()).select(F.lit(d).alias("dimension"), F.posexplode(f"j.{d}").alias("n", "p")).select("dimension", (F.col("n") + 1).alias("n"), "p.surah", "p.ayah")
    first, *rest = (one(d) for d in (*DIMENSIONS, "sajda"))
    for x in rest:
        first = first.unionByName(x)
    return first


def present_dimensions(spark: SparkSession, path: str) -> set[str]:
    """The dimensions of a marker document; of a large one those that have markers."""
    if _large(spark, path):
        return {r["dimension"] for r in marker_document(spark, path).select("dimension").distinct().collect()}
    row = _document(spark, path, MARKERS).select(*(F.col(f"j.{d}").isNotNull().alias(d) for d in (*DIMENSIONS, "sajda"))).first()
    return {d for d, here in row.asDict().items() if here}


def flatten_payload(spark: SparkSession, path: str) -> DataFrame:
    """(surah, ayah, ayah_key, text) of a nested web payload that was saved to a file."""
    chapter = "struct<number:int,ayahs:array<struct<numberInSurah:int,text:string>>>"
    if _large(spark, path):
        chapters = _items(spark, path, ("data", "surahs"), chapter).where("level = 3").select(F.col("j").alias("s"))
    else:
        chapters = _document(spark, path, PAYLOAD).select(F.explode("j.data.surahs").alias("s"))
    verses = chapters.select(F.col("s.number").alias("surah"), F.explode("s.ayahs").alias("a"))
    return verses.select("surah", F.col("a.numberInSurah").alias("ayah"), verse_key(F.col("surah"), F.col("a.numberInSurah")).alias("ayah_key"), "a.text")
