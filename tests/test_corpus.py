"""Sources and the compiler on a small corpus of invented text."""

import hashlib
import json
import random
import sqlite3
import threading
from contextlib import closing, contextmanager
from functools import partial
from http.server import SimpleHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from lectern.__main__ import corpus_tables, main
from lectern.operators.align import CARRIER
from lectern.plans import corpus, quality, shaping
from lectern.plans.resolve import pick, resolve, text_kind
from lectern.sources import json_files, sqlite, tables

VERSES = [(1, 1), (1, 2), (1, 3), (2, 1), (2, 2)]


def make(path, **tables):
    with closing(sqlite3.connect(path)) as db:
        for name, (columns, rows) in tables.items():
            db.execute(f"CREATE TABLE {name} ({columns})")
            db.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(columns.split(',')))})", rows)
        db.commit()
    return str(path)


@pytest.fixture
def config(tmp_path):
    words = [(i, c, v, w) for i, (c, v, w) in enumerate([(1, 1, "alef"), (1, 1, "beh"), (1, 2, "teh"), (1, 3, None), (1, 3, " jeem "), (2, 1, "dal"), (2, 2, "reh")], 1)]
    return {
        "output": str(tmp_path / "out" / "corpus.db"),
        "db_version": "1.2",
        "sources": {
            "surahs": {"file": make(tmp_path / "c.db", chapters=("ID INT, name TEXT, Name_Simple TEXT, place TEXT, verses_count INT", [(1, " one ", "Aal-E-One", " Makkah ", 0), (2, "two", "Two", None, 7)]), small=("x INT", []))},
            "arabic_uthmani": {
                "file": make(tmp_path / "w.db", words=("word_index INT, surah INT, ayah INT, text TEXT", reversed(words))),
                "reading_overrides": str(tmp_path / "o.json"),
                "tatweel_reference": str(tmp_path / "t.json"),
            },
            "arabic_indopak": {"file": make(tmp_path / "s.db", arabic_text=("sura INT, ayah INT, text TEXT", [(1, 1, "x"), (9, 9, "unknown"), (1, 2, None)]))},
            "metadata": {"file": str(tmp_path / "m.json"), "mode": "markers"},
            "translations": [
                {"file": make(tmp_path / "a.db", verses=("verse_key TEXT, text TEXT", [("1:1", "first"), ("1:1", "Allâh  last"), ("8:8", "unknown"), ("2:2", "b  c"), ("1:2", None)])), "language_code": "en", "name": "A", "strip_translit_diacritics": True, "collapse_nbsp": True},
                {"file": make(tmp_path / "b.db", t=("surah INT, ayah INT, text TEXT", [(c, v, f" {c}.{v} ") for c, v in VERSES])), "language_code": "xx", "name": "B"},
            ],
        },
    }


@pytest.fixture
def inputs(config, tmp_path):
    (tmp_path / "o.json").write_text(json.dumps({"2:2": "changed", "9:9": "unknown"}))
    (tmp_path / "t.json").write_text(json.dumps({"1:2": f"t{CARRIER}eh", "2:1": "da"}, ensure_ascii=False), encoding="utf-8")
    at = lambda *ps: [{"surah": c, "ayah": v} for c, v in ps]
    (tmp_path / "m.json").write_text(json.dumps({"page": at((1, 2), (7, 7), (2, 1)), "juz": at((1, 1)), "sajda": at((2, 2), (8, 8))}))
    return config


def test_compile(spark, inputs):
    t = corpus.compile_tables(spark, inputs, "full")
    assert sorted(map(tuple, t["surahs"].collect())) == [(1, "one", "Aal-e-One", "makkah", 3), (2, "two", "Two", None, 7)]
    a = sorted(map(tuple, t["ayahs"].collect()))
    assert [r[:5] for r in a] == [(1, 1, 1, "alef beh", "x"), (2, 1, 2, f"t{CARRIER}eh", None), (3, 1, 3, "jeem", None), (4, 2, 1, "dal", None), (5, 2, 2, "changed", None)]
    assert [r[5:] for r in a] == [(0, 1, None, None, None, 0), (1, 1, None, None, None, 0), (1, 1, None, None, None, 0), (3, 1, None, None, None, 0), (3, 1, None, None, None, 1)]
    assert sorted(map(tuple, t["translations"].collect()))[:2] == [(1, 1, 1, "Allah last"), (2, 5, 1, "b c")]
    assert [r[1:] for r in sorted(map(tuple, t["translations"].collect()))[2:]] == [(i, 2, f" {c}.{v} ") for i, (c, v) in enumerate(VERSES, 1)]


def test_build_and_verify(spark, inputs, tmp_path):
    path = corpus.build(spark, inputs, graft_mode="none")
    with closing(sqlite3.connect(path)) as db:
        assert db.execute("SELECT text_arabic_uthmani FROM ayahs WHERE id = 2").fetchone() == ("teh",)
        assert db.execute("SELECT value FROM db_meta WHERE key = 'schema_version'").fetchone() == ("1",)
        assert len(json.loads(db.execute("SELECT value FROM db_meta WHERE key = 'source_checksums'").fetchone()[0])) == 8
        assert db.execute("PRAGMA page_size").fetchone() == (1024,)
    found = {(r["check_name"], r["severity"], r["subject"]) for r in quality.report(corpus_tables(spark, path)).collect()}
    assert {("cardinality", "FAIL", "surahs"), ("cardinality", "FAIL", "ayahs"), ("second_script", "FAIL", "text_arabic_indopak"), ("carriers", "FAIL", "text_arabic_uthmani"), ("opening", "FAIL", "5:1"), ("declared_count", "WARN", "2"), ("range", "WARN", "hizb_number"), ("coverage", "WARN", "A"), ("flagged", "WARN", "sajda")} <= found
    assert ("declared_count", "WARN", "1") not in found
    fit = quality.Expected(chapters=2, verses=5, carriers=0, flagged=1, ranges={"juz_number": (1, 30)}, opening=None)
    good = quality.report({**corpus_tables(spark, path), "ayahs": corpus_tables(spark, path)["ayahs"].drop("text_arabic_indopak").selectExpr("*", "CAST(NULL AS STRING) AS text_arabic_indopak")}, fit)
    assert quality.exit_code(good) == 0
    assert main(["verify", "--db", path]) == 1


def test_command_line_builds(spark, inputs, tmp_path, caplog, monkeypatch, capsys):
    import yaml

    monkeypatch.setattr("lectern.__main__.session", lambda: spark)
    marked, plain = f"ي{CARRIER}\u0653", "ي\u0653"
    inputs["sources"]["arabic_uthmani"]["columns"] = {"word": "text"}
    with closing(sqlite3.connect(inputs["sources"]["arabic_uthmani"]["file"])) as db:
        db.execute("UPDATE words SET text = ? WHERE surah = 2 AND ayah = 1", (plain,))
        db.commit()
    (tmp_path / "t.json").write_text(json.dumps({"1:2": f"t{CARRIER}eh", "2:1": marked}, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "c.yaml").write_text(yaml.safe_dump(inputs, allow_unicode=True), encoding="utf-8")
    with caplog.at_level("INFO", logger="lectern"):
        assert main(["build", "--config", str(tmp_path / "c.yaml"), "--output", str(tmp_path / "o.db")]) == 0
    said = [r.getMessage() for r in caplog.records]
    assert {"verses, verses: 5", "verses, overrides applied: 1", "verses, carriers grafted: 1", "A, rows inserted: 2", "B, rows inserted: 5"} <= set(said)
    with closing(sqlite3.connect(tmp_path / "o.db")) as db:  # needed carriers only, by default
        assert [t for (t,) in db.execute("SELECT text_arabic_uthmani FROM ayahs ORDER BY id")] == ["alef beh", "teh", "jeem", marked, "changed"]
        assert db.execute("SELECT count(*) FROM sqlite_master WHERE type = 'index' AND name LIKE 'idx_%'").fetchone() == (9,)
        built = db.execute("SELECT value FROM db_meta WHERE key = 'built_at'").fetchone()[0]
        assert built.endswith("+00:00")
    with pytest.raises(FileNotFoundError, match="config"):
        main(["build", "--config", str(tmp_path / "none.yaml")])
    assert main(["build", "--config", str(tmp_path / "c.yaml"), "--no-graft"]) == 0 and str(tmp_path) in capsys.readouterr().out


def test_command_line_prepares(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr("lectern.__main__.session", lambda: spark)
    make(tmp_path / "words.db", words=("id INT, surah INT, ayah INT, glyph TEXT", [(i, c, v, "x") for i, (c, v) in enumerate(VERSES, 1)]))
    make(tmp_path / "layout.db", pages=("page_number INT, line_type TEXT, first_word_id, last_word_id, more", [(1, "ayah", 1, 5, "")]))
    for name, table, column in (("juz", "juz", "juz_number"), ("hizb", "hizbs", "hizb_number"), ("rub", "rub", "rub_number"), ("ruku", "ruku", "ruku_number")):
        make(tmp_path / f"{name}.sqlite", **{table: (f"{column} INT, first_verse_key TEXT", [(1, "1:1"), (2, "2:1")])})
    make(tmp_path / "sajda.sqlite", sajdah=("verse_key TEXT", [("2:2",)]))
    assert main(["prepare", "--sources", str(tmp_path)]) == 0
    with closing(sqlite3.connect(tmp_path / "structure.sqlite")) as db:
        assert db.execute("SELECT * FROM ayah_meta ORDER BY surah, ayah").fetchall()[-1] == (2, 2, 1, 2, 2, 2, 2, 1)
    assert "expected 6236 verses, got 5" in capsys.readouterr().out


@contextmanager
def serving(folder):
    """A web server on this machine for the files of a folder."""
    quiet = type("Quiet", (SimpleHTTPRequestHandler,), {"log_message": lambda *a: None})
    server = ThreadingHTTPServer(("127.0.0.1", 0), partial(quiet, directory=str(folder)))
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        yield f"http://127.0.0.1:{server.server_port}"
    finally:
        server.shutdown()


def test_command_line_script_and_edition(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("lectern.__main__.session", lambda: spark)
    (tmp_path / "s.json").write_text(json.dumps({f"{1 + i // 300}:{i % 300}": "a" for i in range(6236)}))
    assert main(["script", str(tmp_path / "s.json"), str(tmp_path / "s.db")]) == 0
    whole = {"data": {"surahs": [{"number": c, "ayahs": [{"numberInSurah": v, "text": "t"} for v in range(1, 55 if c > 80 else 56)]} for c in range(1, 115)]}}
    extra = 6236 - sum(len(s["ayahs"]) for s in whole["data"]["surahs"])
    whole["data"]["surahs"][0]["ayahs"] = [{"numberInSurah": v, "text": "t"} for v in range(1, 56 + extra)]
    (tmp_path / "p.json").write_text(json.dumps(whole))
    assert main(["edition", str(tmp_path / "p.json"), str(tmp_path / "e.db")]) == 0
    with serving(tmp_path) as url:
        assert main(["edition", f"{url}/p.json", str(tmp_path / "f.db")]) == 0
        with pytest.raises(Exception, match="404"):
            json_files.download(f"{url}/none.json", str(tmp_path / "none.json"))
        (tmp_path / "half.json").write_text('{"a": [')
        with pytest.raises(ValueError):
            json_files.download(f"{url}/half.json", str(tmp_path / "got.json"))
    assert not list(tmp_path.glob("none*")) and not list(tmp_path.glob("got*"))
    for name, table in (("s", "arabic_text"), ("e", "translation"), ("f", "translation")):
        assert sqlite.row_count(str(tmp_path / f"{name}.db"), table) == 6236


def test_null_names_are_errors(spark, inputs, tmp_path):
    inputs["sources"]["surahs"] = {"file": make(tmp_path / "n.db", chapters=("id INT, name TEXT, name_simple TEXT", [(1, None, "One")]))}
    with pytest.raises(Exception, match="name_arabic is null"):
        corpus.compile_tables(spark, inputs)["surahs"].collect()


def verse_tables(spark, second, **more):
    rows = [(i, c, v, "x", second.get((c, v), "t"), 1, 1) for i, (c, v) in enumerate([(1, v) for v in range(1, 8)], 1)]
    a = spark.createDataFrame(rows, "id int, surah_id int, ayah_number int, text_arabic_uthmani string, text_arabic_indopak string, juz_number int, sajda int")
    return {
        "ayahs": a, "surahs": spark.createDataFrame([(1, 7)], "id int, total_ayahs int"), "resources": spark.createDataFrame([(1, "A")], "id int, name string"),
        "translations": spark.createDataFrame([(1,)] * 6, "resource_id int"), "db_meta": spark.createDataFrame([("source_checksums", json.dumps({"f": "0123456789abcdef01"}))], "key string, value string"), **more,
    }


def test_second_script_checks(spark):
    e = quality.Expected(chapters=1, verses=7, carriers=0, flagged=7, ranges={"juz_number": (1, 30)}, opening=None)
    good = {(1, 2): "\u0627\u064ex", (1, 4): "\u0645\u0670", (1, 5): "\u0627\u0650x", (1, 6): "\u0627\u0650"}
    found = lambda second, **k: {(r["check_name"], r["severity"], r["subject"], r["message"]) for r in quality.report(verse_tables(spark, second), e, **k).collect()}
    fine = {("coverage", "WARN", "A", "6 of 7 verses, 1 missing"), ("checksum", "INFO", "f", "0123456789abcdef")}
    assert found(good) == fine | {("shaping", "WARN", "text_arabic_indopak", "glyphs not checked: no font given")}
    bad = found({**good, (1, 5): "\u0627\u0650\u0625", (1, 6): "x", (1, 1): "\ue01a\u200b\u200d"})
    assert {("leaked_glyphs", "FAIL", "text_arabic_indopak", "1 private-use characters"), ("leaked_controls", "FAIL", "text_arabic_indopak", "2 format controls")} <= bad
    assert {r[2] for r in bad if r[0] == "canary"} == {"1:5", "1:6"}
    glyph = "surah_id int, ayah_number int, glyphs " + shaping.GLYPHS
    base, high, low, origin, none = (5, 100, 0, 0), (6, 0, 3, 700), (7, 0, 3, 40), (8, 0, 0, 0), (0, 9, 0, 0)
    shaped = spark.createDataFrame([(1, 1, [base, high, low, base, origin]), (1, 2, [none, high, base]), (1, 3, [base, origin, low, high]), (1, 4, [high, origin, base]), (1, 5, [])], glyph)
    rows = found(good, glyphs=shaped) - fine
    assert rows == {("missing_glyphs", "WARN", "text_arabic_indopak", "1 verses have characters that the font lacks"), ("collapsed_marks", "FAIL", "text_arabic_indopak", "2 verses have marks that failed to stack: 1:3, 1:4")}


def test_stacks_against_a_loop(spark):
    rng = random.Random(3)
    kinds = [(1, 100, 0, 0), (2, 0, 3, 600), (3, 0, 0, 0), (4, 0, 1, 0), (5, 0, 0, 599), (6, -5, 0, 0)]
    texts = [[rng.choice(kinds) for _ in range(rng.randrange(9))] for _ in range(400)]

    def collapsed(glyphs):
        runs = [[]]
        for g in glyphs:
            runs.append([]) if g[1] else runs[-1].append(g)
        return any(any(g[3] >= 600 for g in run) and any(g[2:] == (0, 0) for g in run) for run in runs)

    df = spark.createDataFrame([(i, g) for i, g in enumerate(texts)], f"i int, g {shaping.GLYPHS}")
    assert [r["x"] for r in df.select("i", shaping.collapsed_stack(F.col("g")).alias("x")).orderBy("i").collect()] == [*map(collapsed, texts)]


def test_missing_inputs_leave_the_output_alone(spark, inputs, tmp_path):
    old = tmp_path / "out" / "corpus.db"
    old.parent.mkdir()
    old.write_text("old")
    inputs["sources"]["translations"][0]["file"] += ".gone"
    with pytest.raises(FileNotFoundError, match="gone"):
        corpus.build(spark, inputs)
    assert old.read_text() == "old"


def test_verse_metadata(spark, inputs, tmp_path):
    rows = [(1, 1, 5, None, "0"), (1, 1, 6, 1, "False"), (2, 2, 7, 2, ""), (1, 3, None, None, None)]
    inputs["sources"]["metadata"] = {"file": make(tmp_path / "meta.db", m=("Surah INT, ayah INT, page INT, juz INT, sajda TEXT", rows))}
    a = {(r["surah_id"], r["ayah_number"]): (r["page_number"], r["juz_number"], r["hizb_number"], r["sajda"]) for r in corpus.compile_tables(spark, inputs)["ayahs"].collect()}
    assert a == {(1, 1): (6, 1, None, 1), (1, 2): (None, None, None, 0), (1, 3): (None, None, None, 0), (2, 1): (None, None, None, 0), (2, 2): (7, 2, None, 0)}


def test_prepare(spark, tmp_path):
    words = make(tmp_path / "w.db", words=("id INT, surah INT, ayah INT", [(i, c, v) for i, (c, v) in enumerate([v for v in VERSES for _ in range(2)], 1)]))
    layout = make(tmp_path / "l.db", pages=("page_number INT, line_type TEXT, first_word_id, last_word_id", [(1, "ayah", 1, 4), (1, "name", "", ""), (2, "ayah", 4, 7), (3, "ayah", 7, 8), (9, "basmala", 9, 10)]))
    juz = make(tmp_path / "j.db", juz=("juz_number INT, first_verse_key TEXT", [(30, "2:1"), (4, "1:2")]))
    flags = make(tmp_path / "f.db", sajdah=("verse_key TEXT", [("2:2",), ("2:2",)]))
    out = corpus.prepare(spark, words, layout, {"juz_number": (juz, "juz", "juz_number")}, flags)
    assert sorted(map(tuple, out.collect())) == [(1, 1, 1, 0, 0), (1, 2, 1, 1, 0), (1, 3, 2, 1, 0), (2, 1, 3, 2, 0), (2, 2, None, 2, 1)]
    lines = {tuple(r) for r in quality.structure_report(out).collect()}
    assert ("INFO", "pages 1 to 3, 3 distinct") in lines and ("WARN", "1 verses without a page, such as 2:2") in lines


def test_script_and_payload(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"1:1": " a ", "1:2": "b"}))
    assert sorted(map(tuple, corpus.normalised_script(spark, str(tmp_path / "s.json"), 2).collect())) == [(1, 1, "a"), (1, 2, "b")]
    with pytest.raises(ValueError, match="expected 6236"):
        corpus.normalised_script(spark, str(tmp_path / "s.json"))
    payload = {"data": {"edition": {"englishName": "x", "name": "y"}, "surahs": [{"number": 1, "ayahs": [{"numberInSurah": 1, "text": "p"}, {"numberInSurah": 2, "text": "q"}]}]}}
    (tmp_path / "p.json").write_text(json.dumps(payload))
    assert sorted(map(tuple, corpus.edition_from_payload(spark, str(tmp_path / "p.json"), 1, 2).collect())) == [(1, 1, "1:1", "p"), (1, 2, "1:2", "q")]
    with pytest.raises(ValueError, match="114 chapters"):
        corpus.edition_from_payload(spark, str(tmp_path / "p.json"))


def test_sqlite_source(spark, tmp_path, monkeypatch):
    path = make(tmp_path / "x.db", little=("a INT", [(1,)]), big=("a INT, b TEXT", [(i, None if i == 2 else i / 2) for i in range(5)]), also=("a INT", [(i,) for i in range(5)]))
    assert sqlite.tables(path) == ["little", "big", "also"] and sqlite.columns(path, "big") == ["a", "b"] and sqlite.row_count(path, "big") == 5
    assert sqlite.data_table(path) == "big" and sqlite.data_table(path, "little") == "little"
    with pytest.raises(ValueError, match="no table"):
        sqlite.data_table(path, "none")
    with pytest.raises(ValueError, match="no tables"):
        sqlite.data_table(make(tmp_path / "empty.db"))
    with pytest.raises(FileNotFoundError):
        sqlite.tables(str(tmp_path / "no.db"))
    rows = sorted(map(tuple, sqlite.read_table(spark, path, only=["b"]).collect()), key=lambda r: r[1])
    assert rows == [("0.0", 1), ("0.5", 2), (None, 3), ("1.5", 4), ("2.0", 5)]
    with closing(sqlite3.connect(path)) as db:
        db.execute("CREATE TABLE keyed (k TEXT PRIMARY KEY, v INT) WITHOUT ROWID")
        db.execute("INSERT INTO keyed VALUES ('a', 1), ('b', 2)")
        db.commit()
        db.execute("CREATE TABLE far (v INT)")
        db.executemany("INSERT INTO far (rowid, v) VALUES (?, ?)", [(r, i) for i, r in enumerate((-(2**62), -1, 0, 5, 2**40, 2**62))])
        db.commit()
    assert sorted(map(tuple, sqlite.read_table(spark, path, "keyed").collect())) == [("a", "1", 1), ("b", "2", 2)]
    for n in (1, 2, 4, 6, 250_000):  # parts are counted in rows, however far the rowids lie apart
        monkeypatch.setattr(sqlite, "ROWS_PER_PARTITION", n)
        parts = sqlite._Reader(path, "far", ["v"]).partitions()
        assert len(parts) == -(-6 // n)
        assert [v for p in parts for b in sqlite._Reader(path, "far", ["v"]).read(p) for v in b.column("v").to_pylist()] == list("012345")


def test_filters_go_to_sqlite(spark, tmp_path, monkeypatch):
    """Cells of every type under every affinity: the same rows as by Spark's own filter, and no filter above the scan."""
    path = str(tmp_path / "mixed.db")
    cells = [None, 0, 5, -3, 2**60, 0.5, 5.0, 1e300, "5", "05", " 5", "abc", "ABC", "Abd", "", "é", "z%_", "'q'", b"5", b"abc", "10", 10, "9"]
    with closing(sqlite3.connect(path)) as db:
        db.execute('CREATE TABLE m (i INT, r REAL, t TEXT, n TEXT COLLATE NOCASE, b, "odd ""name" NUMERIC)')
        db.executemany("INSERT INTO m VALUES (?, ?, ?, ?, ?, ?)", [(c,) * 6 for c in cells])
        db.execute("CREATE TABLE v (t TEXT PRIMARY KEY, i INT) WITHOUT ROWID")
        db.execute("INSERT INTO v SELECT DISTINCT CAST(b AS TEXT), 1 FROM m WHERE b IS NOT NULL")
        db.commit()
    old = spark.conf.get(sqlite.PUSHDOWN)
    columns = ["i", "r", "t", "n", "b", '`odd "name`']
    tests = [f"{c} {x}" for c in columns for x in ("= '5'", "= 'abc'", "<> '5'", "<=> '5'", "<=> NULL", "IN ('5', '10', 'ABC', '5.0')", "NOT IN ('5', 'abc')", "IS NULL", "IS NOT NULL", "> '5'", ">= '5.0'", "< 'abc'", "<= 'ABC'", "LIKE 'ab%'", "LIKE '%b%'", "> 'z'", "= ''", "= '''q'''")]
    tests += ["_rowid = 3", "_rowid > 4 AND _rowid <= 9", "_rowid IN (1, 7)", "NOT _rowid = 2", "_rowid <=> 5", "t = 'abc' AND _rowid < 13 AND i <> '0'", "_rowid < 0"]
    open_ = ["t LIKE '%c'", "try_cast(i AS INT) = 5", "t = '5' OR r = '5.0'", "length(t) = 3"]
    try:
        spark.conf.set(sqlite.PUSHDOWN, "false")
        plain = sqlite.read_table(spark, path, "m").cache()
        assert plain.count() == len(cells)
        want = {t: sorted(r["_rowid"] for r in plain.where(t).collect()) for t in tests + open_}
        view = sorted(r["t"] for r in sqlite.read_table(spark, path, "v").where("t > 'A'").collect())
        spark.conf.set(sqlite.PUSHDOWN, "true")
        monkeypatch.setattr(sqlite, "ROWS_PER_PARTITION", 5)
        for t, rows in want.items():
            got = sqlite.read_table(spark, path, "m").where(t)
            assert sorted(r["_rowid"] for r in got.collect()) == rows, t
            assert t in open_ or "Filter (" not in got._jdf.queryExecution().executedPlan().toString(), t
        assert "Filter (" in got._jdf.queryExecution().executedPlan().toString()  # of the last test, which SQLite can't do
        assert sorted(r["t"] for r in sqlite.read_table(spark, path, "v").where("t > 'A'").collect()) == view
        assert [r["_rowid"] for r in sqlite.read_table(spark, path, "v").where("_rowid = 2").collect()] == [2]
        reader = sqlite._PushingReader(path, "m", ["t"])
        assert list(reader.pushFilters([sqlite.D.GreaterThan(("_rowid",), 20)])) == [] and [(p.first, p.last) for p in reader.partitions()] == [(21, 23)]
    finally:
        spark.conf.set(sqlite.PUSHDOWN, old)
        plain.unpersist()


def test_checksums_agree(spark, tmp_path):
    """A file of over 2 GB streams through its task; other files give hashlib's digest."""
    (tmp_path / "f.bin").write_bytes(b"abc" * 1_000_000)
    with open(tmp_path / "large.bin", "wb") as f:
        f.truncate(3 * 2**30)
    (tmp_path / "empty").write_bytes(b"")
    paths = [str(tmp_path / n) for n in ("f.bin", "large.bin", "empty", "f.bin")]
    got = {r["path"]: r["sha256"] for r in corpus.checksums(spark, [*paths, f"file://{paths[0]}"]).collect()}
    zeros = hashlib.sha256()
    for _ in range(3 * 2**10):
        zeros.update(bytes(2**20))
    assert got == {paths[0]: hashlib.sha256(b"abc" * 1_000_000).hexdigest(), paths[1]: zeros.hexdigest(), paths[2]: hashlib.sha256().hexdigest(), f"file://{paths[0]}": got[paths[0]]}
    assert corpus.checksums(spark, []).count() == 0


def test_merge_into_a_stored_table(spark, tmp_path):
    """Batches by key: the table, a dict beside it, parts that are left alone, and retries."""
    import os

    rng, want = random.Random(2), {False: {}, True: {}}
    schema = "k int, part_ string, v int"
    for replace in (True, False):
        path = str(tmp_path / f"t{replace}")
        assert tables.read_merged(spark, path, schema).count() == 0
        for nth in range(3):
            rows = [(rng.choice((None, *range(30))), f"p{i}", nth * 100 + i, i) for i in range(25)]
            for k, x, v, _ in rows if replace else reversed(rows):
                if replace or k not in want[False] or want[False][k][1] >= nth * 100:
                    want[replace][k] = (x, v)
            batch = spark.createDataFrame(rows, f"{schema}, seq int")
            for _ in range(2):  # a batch that comes again changes nothing
                tables.merge_into(path, batch, ["k"], "seq", replace, parts=5)
                assert {r["k"]: (r["part_"], r["v"]) for r in tables.read_merged(spark, path, schema).collect()} == want[replace]
        before = {p: os.listdir(f"{path}/{p}") for p in os.listdir(path) if p.startswith("part=")}
        tables.merge_into(path, spark.createDataFrame([(7, "one", -1, 1)], f"{schema}, seq int"), ["k"], "seq", replace, parts=5)
        tables.merge_into(path, batch.limit(0), ["k"], "seq", replace, parts=5)
        after = {p: os.listdir(f"{path}/{p}") for p in before}
        assert len(before) == 5 and sum(before[p] != after[p] for p in before) == 1
    with pytest.raises(ValueError, match="own"):
        tables.merge_into(path, batch.withColumn("part", F.lit(1)), ["k"], "seq")


def test_parquet_output_in_one_step(spark, inputs, tmp_path, monkeypatch):
    import os

    folder = str(tmp_path / "tables")
    assert corpus.write_parquet(spark, inputs, folder, "none") == folder
    a = spark.read.parquet(f"{folder}/ayahs").orderBy("id").collect()
    assert [r["text_arabic_uthmani"] for r in a] == ["alef beh", "teh", "jeem", "dal", "changed"] and spark.read.parquet(f"{folder}/translations").count() == 7
    assert len(json.loads(spark.read.parquet(f"{folder}/db_meta").where("key = 'source_checksums'").first()["value"])) == 8
    real = corpus.compile_corpus

    def broken(*args):
        done = real(*args)
        return corpus.Compiled(done.tables | {"ayahs": done.tables["ayahs"].withColumn("surah_id", F.lit(99))}, done.counters)

    monkeypatch.setattr(corpus, "compile_corpus", broken)
    with pytest.raises(ValueError, match="ayahs.surah_id"):
        corpus.write_parquet(spark, inputs, folder, "none")
    assert spark.read.parquet(f"{folder}/ayahs").where("surah_id = 99").count() == 0 and not [f for f in os.listdir(tmp_path) if "draft" in f]


def test_resolver():
    assert pick(["B", "a"], ["x", "A", "b"]) == "a" and pick(["b"], ["x"]) is None
    assert text_kind(["surah", "ayah", "position", "text"])[0] == "words"
    assert text_kind(["sura", "verse", "translation"])[0] == "ayah" and text_kind(["verse_key", "text"])[0] == "keyed"
    assert resolve(["q", "text"], {"t": ["text"]}, {"t": "q"}) == {"t": "q"} and resolve(["text"], {"t": ["text"]}, {"t": ""}) == {"t": "text"}
    with pytest.raises(ValueError, match="no column"):
        resolve(["text"], {"t": ["text"]}, {"t": "zz"})
    with pytest.raises(ValueError, match="no text columns"):
        text_kind(["a"])


def test_duplicate_translation_rows_and_first_wins(spark):
    from lectern.operators.relational import first_wins, last_wins

    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 5, None)], "k int, o int, v string").withColumn("p", __import__("pyspark").sql.functions.col("o"))
    assert {r["k"]: r["v"] for r in first_wins(df, ["k"], "o").collect()} == {1: "a", 2: None}
    assert {r["k"]: r["v"] for r in last_wins(df, ["k"], "o").collect()} == {1: "b", 2: None}


def test_look_ups_by_each_division_skip_most_row_groups(spark, tmp_path):
    import glob

    from pyarrow import parquet

    n = 120_000
    ids = spark.range(n).withColumnRenamed("id", "verse")
    mixed = lambda salt, k: F.pmod(F.xxhash64("verse", F.lit(salt)), F.lit(k)).cast("int")
    verses = ids.select("verse", (F.col("verse") / n * 604).cast("int").alias("page"), (F.col("verse") / n * 30).cast("int").alias("juz"), mixed(1, 60).alias("hizb"), mixed(2, 240).alias("rub"), F.when(F.col("verse") % 9 > 0, mixed(3, 500)).alias("ruku"))
    columns = ("page", "juz", "hizb", "rub", "ruku")
    tables.write_together({"v": verses.repartition(4)}, str(tmp_path / "out"), {"v": ["verse"]}, {"v": columns}, group_bytes=2048)
    groups = [m.row_group(i) for f in glob.glob(f"{tmp_path}/out/v/*.parquet") for m in [parquet.ParquetFile(f).metadata] for i in range(m.num_row_groups)]
    assert len(groups) > 1000
    for at, c in enumerate(columns, 1):
        stats = [g.column(at).statistics for g in groups]
        top = max(s.max for s in stats if s.has_min_max)
        for value in (top // 5, top // 2, top - 1):
            read = sum(s.has_min_max and s.min <= value <= s.max for s in stats)
            assert read <= 0.5 * len(groups), (c, value, read, len(groups))
    got = spark.read.parquet(f"{tmp_path}/out/v")
    assert got.exceptAll(verses).count() == 0 and got.count() == n
    assert tables.clustered(verses.limit(0), columns, ["verse"]).count() == 0
