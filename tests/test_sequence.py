"""Markers, ids and ranges against plain loops on random inputs."""

import random

import pytest
from pyspark.sql import Window, functions as F

from lectern.operators import relational as R, sequence as S


def carried(positions, markers):
    at, now, out = dict(markers), 0, {}
    for p in sorted(positions):
        now = at.get(p, now)
        out[p] = now
    return out


def test_markers_both_ways(spark):
    rng = random.Random(7)
    for _ in range(3):
        positions = rng.sample(range(200), 80)
        starts = [rng.randrange(220) for _ in range(25)]
        markers = [(p, i) for i, p in enumerate(starts, 1)]
        want = carried(positions, markers)  # a later marker at the same place wins
        df, m = spark.createDataFrame([(p,) for p in positions], "p long"), spark.createDataFrame(markers, "p long, n int")
        one = S.expand_markers(df, {"d": m}, ["p"], "n").collect()
        two = S.expand_markers_by_interval(df, m, "p", "n", "d", 16).collect()
        assert {r["p"]: r["d"] for r in one} == want == {r["p"]: r["d"] for r in two}
        assert len(two) == len(positions)


def test_no_markers_and_no_positions(spark):
    df, none = spark.createDataFrame([(1,), (2,)], "p long"), spark.createDataFrame([], "p long, n int")
    assert [r["d"] for r in S.expand_markers(df, {"d": none}, ["p"], "n").collect()] == [0, 0]
    assert sorted(r["d"] for r in S.expand_markers_by_interval(df, none, "p", "n", "d", 8).collect()) == [0, 0]
    assert S.expand_markers(df.limit(0), {"d": none}, ["p"], "n").count() == 0


def test_range_join_last_wins(spark):
    rng = random.Random(9)
    ranges = [(i, a := rng.randrange(100), a + rng.randrange(-3, 30)) for i in range(20)]
    points = list(range(0, 130, 3))
    want = {p: max((i for i, a, z in ranges if a <= p <= z), default=None) for p in points}
    got = S.range_join(spark.createDataFrame([(p,) for p in points], "p long"), spark.createDataFrame(ranges, "i int, a long, z long"), "p", "a", "z", 16, "i", F.col("i"))
    assert {r["p"]: r["i"] for r in got.collect()} == want


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_running_id_of_wide_rows(spark, adaptive):
    """Every row, each with its own id, whatever other columns there are and however ranges are dealt."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(old, (adaptive, "1m", "16")):
            spark.conf.set(k, v)
        n = 300_000
        rows = spark.range(n).select(F.xxhash64("id").alias("a"), F.sha2(F.col("id").cast("string"), 256).alias("wide"), F.lit("mine").alias("_at"))
        got = S.running_id(rows, ["a"])
        assert got.columns == ["a", "wide", "_at", "id"]
        both = got.join(rows.select(F.col("a").alias("b"), F.col("wide").alias("w")), F.col("a") == F.col("b")).where("wide = w AND _at = 'mine'")
        by_window = F.row_number().over(Window.orderBy("a"))
        assert both.agg(F.count(F.lit(1)), F.count_distinct("id"), F.min("id"), F.max("id")).first() == (n, n, 1, n)
        assert got.withColumn("want", by_window).where("want <> id").count() == 0
        values = rows.withColumn("v", F.when(F.col("a") % 5000 == 0, F.col("wide")))
        carried = S.carry_forward(values, ["a"], ["v"])
        want = values.withColumn("v", F.last("v", ignorenulls=True).over(Window.orderBy("a").rowsBetween(Window.unboundedPreceding, 0)))
        assert carried.exceptAll(want).count() == 0 == want.exceptAll(carried).count() and carried.count() == n
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_running_id_edges(spark):
    df = spark.createDataFrame([(2, "b"), (None, "n"), (1, "x"), (1, "y")], "a int, id_ string")
    got = sorted((r["id"], r["a"]) for r in S.running_id(df, ["a"]).collect())
    assert got == [(1, None), (2, 1), (3, 1), (4, 2)]
    assert S.running_id(df.limit(0), ["a"]).count() == 0
    assert [r["v"] for r in S.carry_forward(spark.createDataFrame([(1, None), (2, None)], "a int, v int"), ["a"], ["v"]).collect()] == [None, None]


def test_first_offenders_and_upsert(spark):
    rows = [(1, "b", 1), (1, "a", 2), (1, "a", 3), (1, "c", 4), (2, None, 5), (3, "z", 6), (3, None, 7)]
    df = spark.createDataFrame(rows, "g int, k string, o int")
    assert {r["g"]: r["s"] for r in R.first_offenders(df, ["g"], F.col("k"), 2, "s").collect()} == {1: "a, b", 2: "", 3: "z"}
    assert {r["g"]: r["k"] for r in R.upsert(df, ["g"], "o").collect()} == {1: "c", 2: None, 3: None}


def test_scratch_tables_are_removed(spark):
    import os

    from lectern import shared

    with shared.scratch(spark):
        df = shared.materialise(spark.range(3), "x")
        path = df.inputFiles()[0].removeprefix("file:")
        assert df.count() == 3 and os.path.exists(path)
    assert not os.path.exists(path)
    assert shared.materialise(spark.range(2), "x").count() == 2


def test_shared_folder(spark, monkeypatch):
    from types import SimpleNamespace

    from lectern import shared

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):  # a cluster without a shared folder
        shared.shared_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(master="spark://host:7077", getConf=lambda: SimpleNamespace(get=lambda k: None))))
    assert shared.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert shared.unused_prefix(spark.createDataFrame([(1, 1)], "_A int, __b int")) == "___"


def test_ordered_concat_is_stable_and_skips_nulls(spark):
    df = spark.createDataFrame([(1, 2, 0, "b"), (1, 1, 1, "z"), (1, 1, 2, "a"), (1, 3, 3, None), (2, 1, 4, " x ")], "k int, o int, t int, x string")
    assert {r["k"]: r["text"] for r in R.ordered_concat(df, ["k"], "o", "x", "t").collect()} == {1: "z a b", 2: "x"}


def test_fill_counts_treats_zero_as_missing(spark):
    p, c = spark.createDataFrame([(1, 0), (2, None), (3, 9), (4, 0)], "k int, n int"), spark.createDataFrame([(1,), (1,), (2,)], "k int")
    got = R.fill_counts(p, c.withColumnRenamed("k", "ck"), "k", "ck", "n").collect()
    assert {r["k"]: r["n"] for r in got} == {1: 2, 2: 1, 3: 9, 4: 0}


def test_scan_of_unsorted_markers_at_unknown_positions(spark):
    rng = random.Random(8)
    for _ in range(2):
        positions = rng.sample(range(200), 90)
        want, markers = {p: [] for p in positions}, {}
        for name in ("a", "n", "_r"):
            starts = [(rng.randrange(210), i / 2) for i in range(rng.choice((0, 1, 30)))]
            holds = carried(positions, [(p, i) for i, (p, _) in enumerate(starts, 1)])
            for p in positions:
                want[p].append(holds[p])
            rng.shuffle(starts)
            markers[name] = spark.createDataFrame(starts, "p long, at double").withColumn("extra", F.lit(1)).repartition(3)
        df = spark.createDataFrame([(p, "mine", "x") for p in positions], "p long, at string, _at string").repartition(4)
        got = S.scan_markers(df, markers, ["p"], "at")
        assert got.columns == ["p", "at", "_at", "a", "n", "_r"]
        assert {r["p"]: list(r[3:]) for r in got.collect()} == want
        assert {r["at"] for r in got.collect()} == {"mine"} and got.count() == len(positions)
    assert S.scan_markers(df.limit(0), markers, ["p"], "at").count() == 0


def test_scan_writes_once(spark, monkeypatch):
    names = []
    real = S.materialise
    monkeypatch.setattr(S, "materialise", lambda df, name: names.append(name) or real(df, name))
    e = spark.range(50).select("id", F.col("id").alias("at"))
    S.scan_markers(e, {f"m{k}": e.where(F.col("id") % (k + 2) == 0) for k in range(5)}, ["id"], "at").collect()
    assert names == ["markers"]


def test_long_ranges_are_few_rows(spark):
    one = spark.createDataFrame([(5, 5 + 10**12, 1)], "lo long, hi long, i int")
    assert S.dyadic_blocks(one, "lo", "hi", 6, "l", "k").count() < 100
    ends = [-(2**63), -(2**62) - 1, -7, -1, 0, 1, 6, 2**40 + 3, 2**63 - 1]
    ranges = [(a, z, i) for i, (a, z) in enumerate((a, z) for a in ends for z in ends)] + [(None, 3, 900), (3, None, 901)]
    points = sorted({x + d for x in ends for d in (-1, 0, 1) if -(2**63) <= x + d < 2**63})
    want = {p: max((i for a, z, i in ranges if a is not None and z is not None and a <= p <= z), default=None) for p in points}
    df = spark.createDataFrame([(p, "x") for p in points] + [(None, "x")], "p long, block string")
    spans = spark.createDataFrame(ranges, "lo long, hi long, at int")
    for width in (1, 64, 2**33):
        got = S.range_join(df, spans, "p", "lo", "hi", width, "at", F.col("at"), out="hit")
        assert {r["p"]: r["hit"] for r in got.collect()} == want | {None: None}
        assert got.columns == ["p", "block", "hit"]
    assert S.range_join(df, spans.limit(0), "p", "lo", "hi", 8, "at", F.col("at")).where("at IS NULL").count() == len(points) + 1


def test_blocks_cover_each_position_once(spark):
    rng = random.Random(2)
    ranges = [(a := rng.randrange(-300, 300), a + rng.randrange(0, 200)) for _ in range(60)]
    rows = S.dyadic_blocks(spark.createDataFrame(ranges, "lo long, hi long").distinct(), "lo", "hi", 0, "l", "k").collect()
    for lo, hi in set(ranges):
        held = [x for r in rows if (r["lo"], r["hi"]) == (lo, hi) for x in range(r["k"] << r["l"], r["k"] + 1 << r["l"])]
        assert sorted(held) == list(range(lo, hi + 1))


def test_equal_order_keys_are_many_ranges(spark):
    """A constant key is dealt over tasks, and ids are the same in each run."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(old, ("false", "8")):
            spark.conf.set(k, v)
        n = 300_000
        rows = spark.range(n).select(F.lit(None).cast("int").alias("a"), F.sha2(F.col("id").cast("string"), 256).alias("wide"))
        one = S.running_id(rows, ["a"])
        parts = S._ranged(rows, ["a"], "_at").groupBy(S._range_of("_at").alias("r")).count().collect()
        assert len(parts) >= 6 and max(r["count"] for r in parts) < n / 3
        two = S.running_id(rows.repartition(5, "wide"), ["a"])
        assert one.join(two.withColumnRenamed("id", "other"), "wide").where("id = other").count() == n
        assert one.agg(F.count_distinct("id"), F.min("id"), F.max("id")).first() == (n, 1, n)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_long_groups_in_two_levels(spark):
    """One group with a third of all rows, dealt evenly; order, ties, nulls and other groups as ever."""
    rng = random.Random(6)
    rows = [(None if i % 3 else g, rng.randrange(50), rng.randrange(3), rng.choice((None, " a ", "b", f"x{i}"))) for i, g in enumerate(rng.choices(range(40), k=3000))]
    df = spark.createDataFrame(rows, "k int, o int, t int, x string").withColumn("_o", F.lit("clash"))
    want = {}
    for k in {r[0] for r in rows}:
        x = sorted((o, t, x) for g, o, t, x in rows if g == k and x is not None)
        want[k] = " ".join(s for *_, s in x).strip()
    for long in (1, 100, 10**9):
        got = R.ordered_concat(df, ["k"], "o", "x", "t", long=long)
        assert {r["k"]: r["text"] for r in got.collect()} == want and got.count() == len(want)
    assert R.ordered_concat(df.limit(0), ["k"], "o", "x").count() == 0
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(old, ("false", "8")):
            spark.conf.set(k, v)
        big = spark.range(120_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("o"), F.col("id").cast("string").alias("x"))
        text = R.ordered_concat(big, ["k"], "o", "x").where("k = -1").first()["text"]
        assert text == " ".join(map(str, range(0, 120_000, 3)))
        hot = big.where("k = -1").repartitionByRange("k", "o", "x").groupBy(F.spark_partition_id().alias("r")).count().collect()
        assert len(hot) >= 6 and max(r["count"] for r in hot) < 12_000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_columns_that_clash(spark):
    a = spark.createDataFrame([(1, "x", 0), (2, "y", 5)], "k int, _new string, count int").withColumns({"_hit": F.lit(1), "_member": F.lit("m"), "_k": F.lit(2), "_r": F.lit(3), "_n": F.lit(4)})
    b = spark.createDataFrame([(1, "z"), (1, "z")], "k int, _new string").withColumn("_hit", F.lit(7))
    assert {r["k"]: (r["_new"], r["applied"], r["_hit"]) for r in R.override(a, b.distinct(), ["k"], "_new").collect()} == {1: ("z", 1, 1), 2: ("y", 0, 1)}
    assert {r["k"]: (r["_member"], r["f"]) for r in R.membership_flag(a, b, ["k"], "f").collect()} == {1: ("m", 1), 2: ("m", 0)}
    assert {r["k"]: (r["count"], r["_k"]) for r in R.fill_counts(a, b.withColumnRenamed("k", "c"), "k", "c", "count").collect()} == {1: (2, 2), 2: (5, 2)}
    assert [tuple(r) for r in R.declared_vs_actual(a, b.withColumnRenamed("k", "c"), "k", "c", "count").collect()] == [(1, 0, 2)]
    assert R.last_wins(a, ["k"], "count").columns == a.columns and R.last_wins(a, ["_r"], "count").first()["k"] == 2
    m = spark.createDataFrame([(1, 1)], "_lo int, _n int")
    spans = S.expand_markers_by_interval(a.withColumn("_lo", F.col("k")).withColumn("_bucket", F.lit("b")), m, "_lo", "_n", "_i", 8)
    assert {r["k"]: (r["_i"], r["_bucket"], r["_n"]) for r in spans.collect()} == {1: (1, "b", 4), 2: (1, "b", 4)}
