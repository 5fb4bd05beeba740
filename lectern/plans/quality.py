"""Checks of a compiled corpus: one pass over the verses for all counts, small joins for the rest."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from lectern.functions.text import count_in_class
from lectern.operators import relational as R
from lectern.plans import shaping

# What the full corpus has.
RANGES = {"page_number": (1, 604), "juz_number": (1, 30), "hizb_number": (1, 60), "rub_el_hizb": (1, 240), "ruku_number": (1, 600)}
PRIVATE_USE = r"\ue000-\uf8ff"
CONTROLS = r"\u200b\u200c\u200d\u200e\u200f\ufeff\u0604"
CARRIER = r"\u0640"
OPENING = "\u064a\u064e\u0640\u0670\u0653"
#: (chapter, verse, what, test) of the second script.
CANARIES: list[tuple[int, int, str, Callable[[Column], Column]]] = [
    (1, 2, "opens with alef and fatha", lambda t: t.startswith("\u0627\u064e")),
    (1, 4, "opens with meem and dagger alef", lambda t: t.startswith("\u0645\u0670")),
    (1, 5, "opens with alef and kasra, without hamza", lambda t: t.startswith("\u0627\u0650") & ~t.contains("\u0625")),
    (1, 6, "opens with alef and kasra", lambda t: t.startswith("\u0627\u0650")),
]


@dataclass(frozen=True)
class Expected:
    chapters: int = 114
    verses: int = 6236
    carriers: int | None = 1163
    flagged: int = 15
    ranges: dict[str, tuple[int, int]] = field(default_factory=lambda: dict(RANGES))
    opening: tuple[int, int] | None = (5, 1)


def report(tables: dict[str, DataFrame], expected: Expected | None = None, glyphs: DataFrame | None = None, font: str | None = None) -> DataFrame:
    """(check_name, severity, subject, message), a row per finding; severity is FAIL, WARN or INFO.

    The second script's shaping is checked on glyphs (shaping.GLYPHS by surah_id and
    ayah_number) if given, or with a font where a shaping library is present; else the
    report says that it was not.
    """
    e = expected or Expected()
    spark = tables["ayahs"].sparkSession
    a = tables["ayahs"]
    first, second = F.col("text_arabic_uthmani"), F.col("text_arabic_indopak")
    at = lambda c, v: (F.col("surah_id") == c) & (F.col("ayah_number") == v)
    canary = [F.max(F.when(at(c, v), ~test(second))).alias(f"canary{i}") for i, (c, v, _, test) in enumerate(CANARIES)]
    seen = [F.max(F.when(at(c, v), True)).alias(f"seen{i}") for i, (c, v, _, _) in enumerate(CANARIES)]
    opening = F.max(F.when(at(*e.opening), first.startswith(OPENING))) if e.opening else F.lit(True)
    n = a.agg(
        F.count(F.lit(1)).alias("verses"), F.count_if(F.coalesce(F.trim(first) == "", F.lit(True))).alias("blank"), F.count_if(F.trim(second) != "").alias("second"),
        F.sum(count_in_class(second, PRIVATE_USE)).alias("private"), F.sum(count_in_class(second, CONTROLS)).alias("controls"), F.sum(count_in_class(first, CARRIER)).alias("carriers"),
        F.count_if(F.col("sajda") == 1).alias("flagged"), opening.alias("opening"), *canary, *seen,
    ).first()
    chapters = tables["surahs"].count()
    rows: list[tuple[str, str, str, str]] = []
    add = lambda bad, *row: rows.append(row) if bad else None
    add(chapters != e.chapters, "cardinality", "FAIL", "surahs", f"expected {e.chapters}, found {chapters}")
    add(n["verses"] != e.verses, "cardinality", "FAIL", "ayahs", f"expected {e.verses}, found {n['verses']}")
    add(n["blank"], "blank_text", "FAIL", "text_arabic_uthmani", f"{n['blank']} verses without text")
    add(n["second"] and n["second"] != e.verses, "second_script", "FAIL", "text_arabic_indopak", f"{n['second']} of {e.verses} verses filled")
    if n["second"] and n["second"] == e.verses:
        add(n["private"], "leaked_glyphs", "FAIL", "text_arabic_indopak", f"{n['private']} private-use characters")
        add(n["controls"], "leaked_controls", "FAIL", "text_arabic_indopak", f"{n['controls']} format controls")
        for i, (c, v, what, _) in enumerate(CANARIES):
            add(n[f"canary{i}"] or not n[f"seen{i}"], "canary", "FAIL", f"{c}:{v}", f"not so: {what}")
        if glyphs is None and font and shaping.available():
            glyphs = shaping.shape(a, "text_arabic_indopak", font)
        add(glyphs is None, "shaping", "WARN", "text_arabic_indopak", "glyphs not checked: " + ("no shaping library" if font else "no font given"))
        rows += shaping.findings(glyphs, "text_arabic_indopak") if glyphs is not None else []
    add(e.carriers is not None and n["carriers"] != e.carriers, "carriers", "FAIL", "text_arabic_uthmani", f"expected {e.carriers}, found {n['carriers']}")
    add(not n["opening"], "opening", "FAIL", ":".join(map(str, e.opening or ())), "does not open with the carried mark, or is missing")
    add(n["flagged"] != e.flagged, "flagged", "WARN", "sajda", f"expected {e.flagged}, found {n['flagged']}")
    counted = spark.createDataFrame(rows, "check_name string, severity string, subject string, message string")

    line = lambda df, name, severity, subject, message: df.select(F.lit(name).alias("check_name"), F.lit(severity).alias("severity"), subject.cast("string").alias("subject"), message.alias("message"))
    differing = R.declared_vs_actual(tables["surahs"], a, "id", "surah_id", "total_ayahs")
    declared = line(differing, "declared_count", "WARN", F.col("id"), F.format_string("declared %d, found %d", F.col("total_ayahs").cast("long"), F.col("actual")))
    ranges = R.range_profile(a, e.ranges).where("status <> 'ok'")
    outside = line(ranges, "range", "WARN", F.col("name"), F.when(F.col("status") == "empty", "no values").otherwise(F.format_string("%d to %d, allowed %d to %d", "minimum", "maximum", "lo", "hi")))
    covered = tables["resources"].join(tables["translations"].groupBy(F.col("resource_id").alias("_r")).count(), F.col("id") == F.col("_r"), "left").withColumn("n", F.coalesce("count", F.lit(0))).where(F.col("n") != e.verses)
    gaps = line(covered, "coverage", "WARN", F.col("name"), F.format_string(f"%d of {e.verses} verses, %d missing", F.col("n"), F.lit(e.verses) - F.col("n")))
    sums = tables["db_meta"].where("key = 'source_checksums'").select(F.explode(F.from_json("value", "map<string,string>")).alias("f", "s"))
    listed = line(sums, "checksum", "INFO", F.col("f"), F.substring("s", 1, 16))
    return counted.unionByName(declared).unionByName(outside).unionByName(gaps).unionByName(listed)


def exit_code(findings: DataFrame) -> int:
    """1 if anything failed."""
    return int(not findings.where("severity = 'FAIL'").isEmpty())


def structure_report(rows: DataFrame, verses: int = 6236, show: int = 5) -> DataFrame:
    """(severity, message) about prepared divisions: counts, pages, and the first verses without a page."""
    n, a, b, pages, missing = rows.agg(F.count(F.lit(1)), F.min("page_number"), F.max("page_number"), F.count_distinct("page_number"), F.count_if(F.col("page_number").isNull())).first()
    some = ", ".join(f"{r[0]}:{r[1]}" for r in rows.where("page_number IS NULL").orderBy("surah", "ayah").select("surah", "ayah").limit(show).collect())
    lines = [
        ("WARN", f"expected {verses} verses, got {n}") if n != verses else None,
        ("INFO", f"pages {a} to {b}, {pages} distinct") if pages else ("WARN", "no page numbers"),
        ("WARN", f"{missing} verses without a page, such as {some}") if missing else None,
    ]
    return rows.sparkSession.createDataFrame([x for x in lines if x], "severity string, message string")
