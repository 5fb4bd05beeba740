"""Documents read in many byte ranges, against json.loads."""

import json
import random

import pytest

from lectern.sources import json_files
from lectern.sources.json_split import elements

SIZE = "spark.sql.files.maxPartitionBytes"
ODD = ["", "a,b", '"', "\\", '\\"', "\\\\", "é", "日本語, x", "🙂", "[1,{", "}],", "\n\t", " ", 'x\\",y', " ", ":", "{\"a\":[1,2]}", "\\u002c"]


@pytest.fixture
def small(spark):
    old = {k: spark.conf.get(k) for k in (SIZE, "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum") if spark.conf.get(k, None)}
    spark.conf.set(SIZE, "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield 200
    for k in (SIZE, "spark.sql.files.openCostInBytes"):
        spark.conf.set(k, old.get(k, "128m" if k == SIZE else "4m"))


def flat(value, depth, keys=()):
    """(keys, value) in the order of the document, '' for places in arrays."""
    if len(keys) < depth and isinstance(value, (dict, list)):
        for k, v in value.items() if isinstance(value, dict) else (("", v) for v in value):
            yield from flat(v, depth, (*keys, k))
    elif keys:
        yield keys, value


def random_value(rng, deep):
    kind = rng.randrange(7 if deep else 4)
    if kind == 0:
        return rng.choice(ODD) + rng.choice(ODD)
    if kind == 1:
        return rng.choice([0, -1.5, 1e30, True, False, None, 123456789])
    if kind < 4:
        return "".join(rng.choice(ODD) for _ in range(rng.randrange(6)))
    if kind == 4:
        return [random_value(rng, deep - 1) for _ in range(rng.randrange(4))]
    return {rng.choice(ODD) + str(i): random_value(rng, deep - 1) for i in range(rng.randrange(4))}


def test_elements_of_any_document(spark, small, tmp_path):
    rng = random.Random(small)
    docs = [{f"k{i}": random_value(rng, 3) for i in range(8)}, [random_value(rng, 3) for _ in range(8)], {"a": {"b": [[1, 2], {"c": ODD}]}, "d": []}, {}, [], {o: o * 9 for o in ODD}]
    for nth, doc in enumerate(docs):
        path = tmp_path / f"{nth}.json"
        path.write_text(json.dumps(doc, ensure_ascii=nth % 2 == 0, indent=nth % 3 or None), encoding="utf-8")
        for depth in (3,) if nth < 2 else (2,):
            got = [(tuple(r[f"k{i}"] for i in range(1, r["level"] + 1)), json.loads(r["json"])) for r in elements(spark, str(path), depth).orderBy("n").collect()]
            assert got == list(flat(doc, depth)), (nth, depth)


def test_documents_of_the_compiler(spark, small, tmp_path):
    rng = random.Random(1)
    texts = {f"{c}:{v}": rng.choice(ODD) + rng.choice(ODD) for c in range(1, 6) for v in range(1, 9)} | {"9:9": None}
    (tmp_path / "m.json").write_text(json.dumps(texts, ensure_ascii=False, indent=1), encoding="utf-8")
    got = {f"{r['surah']}:{r['ayah']}": r["text"] for r in json_files.verse_map(spark, str(tmp_path / "m.json")).collect()}
    assert json_files._large(spark, str(tmp_path / "m.json")) and got == texts
    places = {d: [{"surah": rng.randrange(9), "ayah": rng.randrange(9), "more": [1, {"x": ","}]} for _ in range(n)] for d, n in (("page", 20), ("juz", 1), ("other", 3), ("sajda", 4))}
    (tmp_path / "p.json").write_text(json.dumps(places))
    want = sorted((d, i, p["surah"], p["ayah"]) for d, ps in places.items() if d != "other" for i, p in enumerate(ps, 1))
    assert sorted(map(tuple, json_files.marker_document(spark, str(tmp_path / "p.json")).collect())) == want
    assert json_files.present_dimensions(spark, str(tmp_path / "p.json")) == {"page", "juz", "sajda"}
    chapters = [{"number": c, "name": "n,", "ayahs": [{"numberInSurah": v, "text": rng.choice(ODD), "page": 1} for v in range(1, 4)]} for c in range(1, 5)]
    (tmp_path / "e.json").write_text(json.dumps({"code": 200, "status": "OK", "data": {"surahs": chapters, "edition": {"name": "x", "surahs": [1]}}}))
    got = sorted(map(tuple, json_files.flatten_payload(spark, str(tmp_path / "e.json")).collect()))
    assert got == sorted((c["number"], a["numberInSurah"], f"{c['number']}:{a['numberInSurah']}", a["text"]) for c in chapters for a in c["ayahs"])


def test_several_ranges_and_broken_documents(spark, small, tmp_path):
    path = tmp_path / "x.json"
    path.write_text(json.dumps({f"{i}:1": "y" * 40 for i in range(40)}))
    cut = spark.read.option("lineSep", ",").text(str(path))
    assert cut.rdd.getNumPartitions() > 4
    for bad in ('{"a": "b', "[1, 2", '{"a": 1 2}', '{"a": }'):
        path.write_text(bad)
        with pytest.raises(Exception, match="ends|JSON|value|delimiter"):
            elements(spark, str(path), 1).collect()
