"""Checks of shaped text: missing glyphs, and marks that failed to stack.

A shaped text is an array of glyphs (GLYPHS). The checks are column expressions on it; the
shaping itself needs a library and a font that are both optional.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

GLYPHS = "array<struct<glyph:int,advance:int,x:int,y:int>>"
#: Font units from which a mark stands high above its base.
HIGH = 600
#: Font features in use when the texts are displayed.
FEATURES = {"calt": True, "ccmp": True}


def missing_glyph(glyphs: Column) -> Column:
    """Whether any glyph is number 0, the font's sign for "none"."""
    return F.exists(glyphs, lambda g: g["glyph"] == 0)


def collapsed_stack(glyphs: Column) -> Column:
    """Whether, above one base, a mark stands high and another lies at the origin.

    Glyphs with an advance are bases; each starts a new run of marks. One whole number is
    carried along: 1 for a high mark in this run, 2 for one at the origin, 4 for a run that
    had both.
    """
    mark = lambda g: F.when(g["y"] >= HIGH, 1).when((g["x"] == 0) & (g["y"] == 0), 2).otherwise(0)
    settled = lambda state: F.when(state >= 3, 4).otherwise(0)
    step = lambda state, g: F.when(g["advance"] != 0, settled(state)).otherwise(state.bitwiseOR(mark(g)))
    return F.aggregate(glyphs, F.lit(0), step, lambda state: state >= 3)


def available() -> bool:
    try:
        import uharfbuzz  # noqa: F401
    except ImportError:
        return False
    return True


def shape(texts: DataFrame, text_col: str, font: str) -> DataFrame:
    """texts (surah_id, ayah_number, text) as (surah_id, ayah_number, glyphs); the font must be at a path all executors see."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import uharfbuzz as hb

        face = hb.Font(hb.Face(hb.Blob.from_file_path(font)))
        for batch in batches:
            rows = []
            for text in batch[text_col]:
                buffer = hb.Buffer()
                buffer.add_str(text)
                buffer.guess_segment_properties()
                hb.shape(face, buffer, FEATURES)
                rows.append([{"glyph": i.codepoint, "advance": p.x_advance, "x": p.x_offset, "y": p.y_offset} for i, p in zip(buffer.glyph_infos, buffer.glyph_positions)])
            yield pd.DataFrame({"surah_id": batch["surah_id"], "ayah_number": batch["ayah_number"], "glyphs": rows})

    return texts.where(F.col(text_col).isNotNull()).select("surah_id", "ayah_number", text_col).mapInPandas(run, f"surah_id int, ayah_number int, glyphs {GLYPHS}")


def findings(glyphs: DataFrame, subject: str, show: int = 10) -> list[tuple[str, str, str, str]]:
    """(check_name, severity, subject, message) of shaped texts (surah_id, ayah_number, glyphs)."""
    flagged = glyphs.select("surah_id", "ayah_number", missing_glyph(F.col("glyphs")).alias("missing"), collapsed_stack(F.col("glyphs")).alias("collapsed"))
    n = flagged.agg(F.count_if("missing").alias("missing"), F.count_if("collapsed").alias("collapsed")).first()
    rows = []
    if n["missing"]:
        rows.append(("missing_glyphs", "WARN", subject, f"{n['missing']} verses have characters that the font lacks"))
    if n["collapsed"]:
        first = flagged.where("collapsed").orderBy("surah_id", "ayah_number").limit(show).collect()
        rows.append(("collapsed_marks", "FAIL", subject, f"{n['collapsed']} verses have marks that failed to stack: " + ", ".join(f"{r[0]}:{r[1]}" for r in first)))
    return rows
