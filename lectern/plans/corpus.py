"""The compiler: sources of one ordered corpus in, five related tables out.

All inputs are checked before anything is written, and outputs are put in place in one step.
Frames are lazy but for running ids and markers, whose ranges are written as the plan is built: put
shared.scratch around a compilation, as the commands do, to have them removed. The corpus is
read once per table that needs it.
"""

from __future__ import annotations

import hashlib
import logging
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime, timezone
from pathlib import Path

import pandas as pd
import yaml
from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.functions import text as T
from lectern.operators import relational as R, sequence as S
from lectern.operators.align import graft
from lectern.plans.resolve import CHAPTER, METADATA, resolve, text_kind
from lectern.shared import materialise
from lectern.sources import json_files as J, sqlite
from lectern.sources.tables import write_together

log = logging.getLogger("lectern")

# The contract of the output file.
DDL = """
PRAGMA page_size = 1024;
CREATE TABLE db_meta (key TEXT PRIMARY KEY, value TEXT NOT NULL);
CREATE TABLE surahs (id INTEGER PRIMARY KEY, name_arabic TEXT NOT NULL, name_english TEXT NOT NULL, revelation_place TEXT, total_ayahs INTEGER NOT NULL);
CREATE TABLE ayahs (id INTEGER PRIMARY KEY, surah_id INTEGER NOT NULL REFERENCES surahs(id), ayah_number INTEGER NOT NULL, text_arabic_uthmani TEXT NOT NULL, text_arabic_indopak TEXT,
    page_number INTEGER, juz_number INTEGER, hizb_number INTEGER, rub_el_hizb INTEGER, ruku_number INTEGER, sajda INTEGER NOT NULL DEFAULT 0, UNIQUE (surah_id, ayah_number));
CREATE TABLE resources (id INTEGER PRIMARY KEY, type TEXT NOT NULL, language_code TEXT NOT NULL, name TEXT NOT NULL, author TEXT, license TEXT, source_url TEXT);
CREATE TABLE translations (id INTEGER PRIMARY KEY AUTOINCREMENT, ayah_id INTEGER NOT NULL REFERENCES ayahs(id), resource_id INTEGER NOT NULL REFERENCES resources(id), text_content TEXT NOT NULL, UNIQUE (ayah_id, resource_id));
CREATE INDEX idx_ayahs_surah ON ayahs(surah_id);
CREATE INDEX idx_ayahs_page ON ayahs(page_number);
CREATE INDEX idx_ayahs_juz ON ayahs(juz_number);
CREATE INDEX idx_ayahs_hizb ON ayahs(hizb_number);
CREATE INDEX idx_ayahs_rub ON ayahs(rub_el_hizb);
CREATE INDEX idx_ayahs_ruku ON ayahs(ruku_number);
CREATE INDEX idx_tr_resource_ayah ON translations(resource_id, ayah_id);
CREATE INDEX idx_tr_ayah ON translations(ayah_id);
CREATE INDEX idx_tr_resource ON translations(resource_id);
"""
ORDER = {"db_meta": ["key"], "surahs": ["id"], "ayahs": ["id"], "resources": ["id"], "translations": ["id"]}
DIVISIONS = ("page_number", "juz_number", "hizb_number", "rub_el_hizb", "ruku_number")
POSITION = ["surah", "ayah"]


@dataclass(frozen=True)
class Source:
    file: str
    table: str | None = None
    columns: dict[str, str] = field(default_factory=dict)
    extra: dict = field(default_factory=dict)

    @classmethod
    def of(cls, spec: dict) -> Source:
        return cls(spec["file"], spec.get("table"), spec.get("columns") or {}, {k: v for k, v in spec.items() if k not in ("file", "table", "columns")})


def load_config(path: str) -> dict:
    if not Path(path).exists():
        raise FileNotFoundError(f"config not found: {path}")
    return yaml.safe_load(Path(path).read_text(encoding="utf-8"))


def input_files(config: dict) -> list[str]:
    sources = config["sources"]
    specs = [sources["surahs"], sources["arabic_uthmani"], *(sources[k] for k in ("arabic_indopak", "metadata") if sources.get(k)), *(sources.get("translations") or [])]
    extra = [sources["arabic_uthmani"][k] for k in ("reading_overrides", "tatweel_reference") if sources["arabic_uthmani"].get(k)]
    return [*(s["file"] for s in specs), *extra]


def check_inputs(config: dict) -> None:
    if missing := [f for f in input_files(config) if not Path(f).exists()]:
        raise FileNotFoundError(f"source files not found: {missing}")


#: Bytes of a file that a task holds while it adds up the checksum.
CHUNK = 1 << 20


def checksum(uri: str) -> str:
    """SHA-256 of a file at a path or URI, in bounded memory."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)
    digest = hashlib.sha256()
    with store.open_input_stream(path, compression=None, buffer_size=0) as f:
        while chunk := f.read(CHUNK):
            digest.update(chunk)
    return digest.hexdigest()


def checksums(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, sha256) of files of any size: a row and a task per file, which streams through it."""
    names = spark.createDataFrame([(p,) for p in dict.fromkeys(paths)], "path string")
    spread = names.repartition(max(min(len(paths), 1000), 1), "path") if paths else names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(sha256=[checksum(p) for p in batch["path"]])

    return spread.mapInPandas(run, "path string, sha256 string")


def _table(spark: SparkSession, source: Source, choose) -> tuple[DataFrame, dict[str, str | None], str]:
    """The columns that choose(names) names, and no others, are read from the file; also what it chose."""
    table = sqlite.data_table(source.file, source.table)
    names = sqlite.columns(source.file, table)
    kind, c = choose(names)
    return sqlite.read_table(spark, source.file, table, only=sorted({x for x in c.values() if x})), c, kind


def _resolved(source: Source, wanted: dict[str, list[str]], needs: tuple[str, ...], what: str):
    def choose(names: list[str]):
        c = resolve(names, wanted, source.columns)
        if not all(c[n] for n in needs):
            raise ValueError(f"{what} columns not found in {source.file}: {names}")
        return what, c

    return choose


def read_chapters(spark: SparkSession, source: Source) -> DataFrame:
    df, c, _ = _table(spark, source, _resolved(source, CHAPTER, ("id", "name_arabic", "name_english"), "chapter"))
    col = lambda name: F.col(c[name]) if c[name] else F.lit(None).cast("string")
    named = lambda name: T.strip(F.coalesce(col(name), F.raise_error(F.lit(f"{name} is null")).cast("string")))
    rows = df.select(T.strip(col("id")).cast("int").alias("id"), named("name_arabic").alias("name_arabic"), T.lower_between_hyphens(named("name_english")).alias("name_english"), T.strip_lower(col("revelation_place")).alias("revelation_place"), T.strip(col("total_ayahs")).cast("int").alias("total_ayahs"), "_rowid")
    return R.last_wins(rows, ["id"], "_rowid").drop("_rowid")


def read_text(spark: SparkSession, source: Source) -> DataFrame:
    """(surah, ayah, text, seq): one row per position; seq is the source row that first named it."""
    df, c, kind = _table(spark, source, lambda names: text_kind(names, source.columns))
    if kind == "words":
        rows = df.select(F.col(c["surah"]).cast("int").alias("surah"), F.col(c["ayah"]).cast("int").alias("ayah"), F.col(c["word_index"]).cast("long").alias("_i"), F.col(c["word"]).alias("_w"), "_rowid")
        first = rows.where("_w IS NOT NULL").groupBy(*POSITION).agg(F.min("_rowid").alias("seq"))
        return R.ordered_concat(rows, POSITION, "_i", "_w", "_rowid").join(first, POSITION)
    chapter, verse = (F.col(c["surah"]).cast("int"), F.col(c["ayah"]).cast("int")) if kind == "ayah" else T.parse_key(F.col(c["key"]))
    rows = df.where(F.col(c["text"]).isNotNull()).select(chapter.alias("surah"), verse.alias("ayah"), F.col(c["text"]).alias("text"), "_rowid")
    return rows.groupBy(*POSITION).agg(F.max_by("text", "_rowid").alias("text"), F.min("_rowid").alias("seq"))


def read_verse_metadata(spark: SparkSession, source: Source) -> DataFrame:
    df, c, _ = _table(spark, source, _resolved(source, METADATA, ("surah", "ayah"), "metadata"))
    number = lambda name: (F.col(c[name]) if c[name] else F.lit(None)).cast("int").alias(name)
    sajda = T.flag(F.col(c["sajda"])) if c["sajda"] else F.lit(None).cast("int")
    return R.last_wins(df.select(number("surah"), number("ayah"), *map(number, DIVISIONS), sajda.alias("sajda"), "_rowid"), POSITION, "_rowid").drop("_rowid")


def read_marker_metadata(spark: SparkSession, source: Source, positions: DataFrame) -> DataFrame:
    markers, here = J.marker_document(spark, source.file), J.present_dimensions(spark, source.file)
    by_name = {name: markers.where(F.col("dimension") == d).drop("dimension") for d, name in J.DIMENSIONS.items() if d in here}
    out = S.expand_markers(positions.select(*POSITION), by_name, POSITION, "n")
    out = out.withColumns({name: F.lit(None).cast("int") for name in DIVISIONS if name not in by_name}).select(*POSITION, *DIVISIONS)
    return R.membership_flag(out, markers.where("dimension = 'sajda'"), POSITION, "sajda") if "sajda" in here else out.withColumn("sajda", F.lit(None).cast("int"))


@dataclass(frozen=True)
class Compiled:
    """The five tables, and what was done for them: rows (what, subject, n)."""

    tables: dict[str, DataFrame]
    counters: DataFrame


def compile_corpus(spark: SparkSession, config: dict, graft_mode: str = "needed") -> Compiled:
    """graft_mode: needed, full or none. The counters are aggregates of the tables' rows, so retries count nothing twice."""
    check_inputs(config)
    sources = config["sources"]
    chapters = read_chapters(spark, Source.of(sources["surahs"]))
    main = sources["arabic_uthmani"]
    verses = read_text(spark, Source.of(main)).select(*POSITION, "text").withColumns({"applied": F.lit(0), "grafted": F.lit(0)})
    if main.get("reading_overrides"):
        verses = R.override(verses.drop("applied"), J.verse_map(spark, main["reading_overrides"]), POSITION, "text")
    if main.get("tatweel_reference") and graft_mode != "none":
        reference = J.verse_map(spark, main["tatweel_reference"]).withColumnRenamed("text", "_ref")
        done = graft(F.col("text"), F.col("_ref"), graft_mode == "needed")
        verses = verses.join(reference, POSITION, "left").withColumn("_g", done).select(*POSITION, F.col("_g.text").alias("text"), "applied", F.col("_g.grafted").alias("grafted"))
    second = read_text(spark, Source.of(sources["arabic_indopak"])).select(*POSITION, F.col("text").alias("second")) if sources.get("arabic_indopak") else None
    numbered = S.running_id(verses, POSITION).withColumn("id", F.col("id").cast("int"))
    meta_spec = sources.get("metadata")
    if not meta_spec:
        meta = numbered.select(*POSITION, *(F.lit(None).cast("int").alias(c) for c in (*DIVISIONS, "sajda")))
    elif meta_spec.get("mode", "per_ayah") == "markers":
        meta = read_marker_metadata(spark, Source.of(meta_spec), numbered)
    else:
        meta = read_verse_metadata(spark, Source.of(meta_spec))
    ayahs = R.with_defaults(numbered, meta, POSITION, {"sajda": 0})
    ayahs = ayahs.join(second, POSITION, "left") if second is not None else ayahs.withColumn("second", F.lit(None).cast("string"))
    ayahs = ayahs.select("id", F.col("surah").alias("surah_id"), F.col("ayah").alias("ayah_number"), F.col("text").alias("text_arabic_uthmani"), F.col("second").alias("text_arabic_indopak"), *DIVISIONS, "sajda")
    surahs = R.fill_counts(chapters, numbered, "id", "surah", "total_ayahs").withColumn("total_ayahs", F.col("total_ayahs").cast("int")).select("id", "name_arabic", "name_english", "revelation_place", "total_ayahs")

    editions = sources.get("translations") or []
    resources = spark.createDataFrame([(i, "translation", e["language_code"], e["name"], e.get("author"), e.get("license"), e.get("source_url")) for i, e in enumerate(editions, 1)], "id int, type string, language_code string, name string, author string, license string, source_url string")
    ids = numbered.select(*POSITION, F.col("id").alias("ayah_id"))
    empty = spark.createDataFrame([], "ayah_id int, seq long, text_content string, resource_id int")
    texts = [read_text(spark, Source.of(e)).join(ids, POSITION).select("ayah_id", "seq", T.apply_flags(F.col("text"), {f for f in T.EDITION_FLAGS if e.get(f)}).alias("text_content")) for e in editions]
    all_texts = R.append_editions(texts) if texts else empty
    translations = S.running_id(all_texts, ["resource_id", "seq"]).select("id", "ayah_id", "resource_id", "text_content")
    tables = {"db_meta": metadata_rows(spark, config), "surahs": surahs, "ayahs": ayahs, "resources": resources, "translations": translations}
    return Compiled(tables, _counters(numbered, resources, translations))


def compile_tables(spark: SparkSession, config: dict, graft_mode: str = "needed") -> dict[str, DataFrame]:
    """The five tables of compile_corpus()."""
    return compile_corpus(spark, config, graft_mode).tables


def _counters(verses: DataFrame, resources: DataFrame, translations: DataFrame) -> DataFrame:
    line = lambda what, n: F.struct(F.lit(what).alias("what"), F.lit("verses").alias("subject"), F.coalesce(n, F.lit(0)).cast("long").alias("n"))
    totals = verses.agg(F.explode(F.array(line("verses", F.count(F.lit(1))), line("overrides applied", F.sum("applied")), line("carriers grafted", F.sum("grafted")))).alias("r")).select("r.*")
    inserted = R.with_defaults(resources.select("id", "name"), translations.groupBy(F.col("resource_id").alias("id")).agg(F.count(F.lit(1)).alias("n")), ["id"], {"n": 0})
    return totals.unionByName(inserted.select(F.lit("rows inserted").alias("what"), F.col("name").alias("subject"), "n"))


def metadata_rows(spark: SparkSession, config: dict) -> DataFrame:
    """(key, value): what the compiler records. Inputs are hashed on the executors."""
    sums = R.sorted_json(checksums(spark, input_files(config)), "path", "sha256", "value").select(F.lit("source_checksums").alias("key"), "value", F.lit(3).cast("long").alias("seq"))
    own = {"schema_version": str(int(config.get("schema_version", 1))), "db_version": str(config.get("db_version", "0.0.0")), "built_at": datetime.now(timezone.utc).isoformat()}
    return R.upsert(spark.createDataFrame([(*kv, i) for i, kv in enumerate(own.items())], "key string, value string, seq long").unionByName(sums), ["key"], "seq")


def write_parquet(spark: SparkSession, config: dict, folder: str, graft_mode: str = "needed") -> str:
    """Compiles into a folder of Parquet tables, put in place in one step; stops before that if rows lack their parents.

    The verses are clustered by all five divisions, in the place of indexes.
    """
    tables = {name: materialise(df, name) for name, df in compile_corpus(spark, config, graft_mode).tables.items()}
    links = [("ayahs", "surah_id", "surahs"), ("translations", "ayah_id", "ayahs"), ("translations", "resource_id", "resources")]
    if broken := [f"{child}.{key}" for child, key, parent in links if not R.orphans(tables[child].select(key), tables[parent].select("id"), key, "id").isEmpty()]:
        raise ValueError(f"rows without their parents: {broken}")
    write_together(tables, folder, ORDER | {"translations": ["resource_id", "ayah_id"]}, {"ayahs": DIVISIONS})
    return folder


def build(spark: SparkSession, config: dict, output: str | None = None, graft_mode: str = "needed") -> str:
    """Compiles into one SQLite file and returns its path."""
    done = compile_corpus(spark, config, graft_mode)
    path = output or config["output"]
    sqlite.export(done.tables, path, DDL, ORDER)
    for row in done.counters.collect():  # three rows and one per edition
        log.info("%s, %s: %d", row["subject"], row["what"], row["n"])
    log.info("wrote %s", path)
    return path


def prepare(spark: SparkSession, words: str, layout: str, divisions: dict[str, tuple[str, str, str]], flags: str) -> DataFrame:
    """Per-verse divisions from raw files: (surah, ayah, page_number, juz_number, ..., sajda).

    divisions: column -> (file, table, column that orders its start markers).
    """
    read = lambda path, table, *columns: sqlite.read_table(spark, path, table, only=list(columns))
    first = read(words, "words", "id", "surah", "ayah").groupBy(F.col("surah").cast("int").alias("surah"), F.col("ayah").cast("int").alias("ayah")).agg(F.min(F.col("id").cast("long")).alias("word"))
    lines = read(layout, "pages", "line_type", "first_word_id", "last_word_id", "page_number").where("line_type = 'ayah' AND first_word_id <> '' AND last_word_id <> ''")
    lines = lines.select(F.col("first_word_id").cast("long").alias("lo"), F.col("last_word_id").cast("long").alias("hi"), F.col("page_number").cast("int").alias("page_number"), "_rowid")
    out = S.range_join(first, lines, "word", "lo", "hi", 64, "page_number", F.col("_rowid"))
    markers = {}
    for name, (path, table, order) in divisions.items():
        chapter, verse = T.parse_key(F.col("first_verse_key"))
        starts = read(path, table, "first_verse_key", order).select(chapter.alias("surah"), verse.alias("ayah"), F.col(order).cast("long").alias("_o"))
        markers[name] = starts
    out = S.scan_markers(out, markers, POSITION, "_o").withColumns({name: F.col(name).cast("int") for name in markers})
    chapter, verse = T.parse_key(F.col("verse_key"))
    members = read(flags, "sajdah", "verse_key").select(chapter.alias("surah"), verse.alias("ayah"))
    return R.membership_flag(out, members, POSITION, "sajda").select(*POSITION, "page_number", *divisions, "sajda")


def normalised_script(spark: SparkSession, snapshot: str, expected: int | None = 6236) -> DataFrame:
    """(sura, ayah, text) of a second-script snapshot; stops if verses are missing or come out empty."""
    out = J.verse_map(spark, snapshot).select(F.col("surah").alias("sura"), "ayah", T.normalise_code_points(F.col("text")).alias("text"))
    n, blank = out.agg(F.count(F.lit(1)), F.count_if(F.expr("text IS NULL OR text = ''"))).first()
    if blank or expected is not None and n != expected:
        raise ValueError(f"expected {expected} verses and none empty, got {n}, {blank} of them empty")
    return out


def edition_from_payload(spark: SparkSession, path: str, chapters: int | None = 114, verses: int | None = 6236) -> DataFrame:
    """(sura, ayah, ayah_key, text) of a saved web payload; stops if its size is not the expected one."""
    out = J.flatten_payload(spark, path).withColumnRenamed("surah", "sura")
    n, c = out.agg(F.count(F.lit(1)), F.count_distinct("sura")).first()
    if chapters is not None and c != chapters or verses is not None and n != verses:
        raise ValueError(f"expected {chapters} chapters and {verses} verses, got {c} and {n}")
    return out
