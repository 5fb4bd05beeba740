"""The language model against loops over all pairs, and its sequences against sorted lists."""

import math
import random
import re
import zlib
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lectern.llm import lm_trie as L


@pytest.mark.parametrize("values", [[], [0], [5], [0, 1, 2, 3], [7, 7 << 40, (7 << 40) + 1], [2**63 + 5, 2**64 - 1], list(range(0, 3000, 3)), [x * 2**32 + y for x in (0, 5, 6) for y in range(0, 900, 7)]])
def test_monotone_sequences(values):
    rng = random.Random(1)
    values = sorted({*values, *(rng.randrange(2**50) for _ in range(500))}) if len(values) > 900 else values
    e = L.EliasFano.of(np.array(values, np.uint64))
    asked = sorted({x + d for x in values for d in (-1, 0, 1) if 0 <= x + d < 2**64} | {0, 17, 2**64 - 1} | {rng.randrange(2**51) for _ in range(50)})
    q = np.array(asked, np.uint64)
    assert e.successor(q).tolist() == [bisect_left(values, x) for x in asked]
    assert e.find(q).tolist() == [values.index(x) if x in values else -1 for x in asked]
    assert e.at(np.arange(len(values))).tolist() == values
    if values:
        assert e.low.nbytes <= len(values) * 8 + 16


def corpus(n=400):
    rng = random.Random(4)
    words = ["The", "the", "house", "Über", "ÜBER", "x\x85y", "a.b", "日本", "|"] + [f"w{i}" for i in range(300)]
    texts = [rng.choice(("", " ", "\t\n")).join(rng.choice(words[: rng.choice((3, 9, 309))]) + rng.choice((" ", "\n", "  \x0b", " the house ")) for _ in range(rng.randrange(30))) for _ in range(n)]
    texts += ["the house"] * 90 + [None, "", " ", "only", "zzz yyy", "The\x00 the"]
    rows = [(i if i % 50 else None, t) for i, t in enumerate(texts)]
    return rows + rows[3:8] + [(900_000 + i, "held qqq") for i in range(8)]


def held(i):
    return zlib.crc32(str("" if i is None else i).encode()) % 7 == 2


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + [None]


def plain(rows):
    q = lambda x: round((math.log10(x) + L.FLOOR) * L.STEPS)
    c, pairs = Counter(), Counter()
    for i, t in rows:
        if not held(i):
            w = tokens(t)
            c.update(w)
            pairs.update(zip([0, *w], w))
    total, distinct = sum(c.values()), len(c)
    out = []
    for i, t in rows:
        w = tokens(t)
        p1 = [(c[x] + 1) / (total + distinct + 1) for x in w]
        context = [c[None] if v == 0 else c[v] for v in [0, *w[:-1]]]
        score = sum(q(pairs[v, x] + L.WEIGHT * p) - q(n + L.WEIGHT) for v, x, p, n in zip([0, *w], w, p1, context))
        out.append((i, held(i), len(w), sum(c[x] > 0 for x in w), total, round(sum(map(math.log10, p1)), 6), round(score / L.STEPS, 9)))
    return out


@pytest.mark.parametrize("block, defer, shards", [(8 << 20, 32, 3), (600, 3, 7), (600, 10**9, 50)])
def test_scores_against_loops(spark, monkeypatch, block, defer, shards):
    """With and without deferred pairs, hot words, and blocks of any size."""
    rows = corpus()
    for name, value in (("BLOCK", block), ("DEFER", defer)):
        monkeypatch.setattr(L, name, value)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(shards))
    try:
        docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, block string, train int").repartition(3)
        got = L.score_documents(docs)
        assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        got = [(*r[:5], round(r[5], 6), round(r[6], 9)) for r in got.collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(got, key=key) == sorted(plain(rows), key=key)


def test_model_is_a_table_of_levels(spark):
    """Saved levels, read again, know every trained word once and give each pair's numerator."""
    rows = corpus(120)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tries = [L.mapped(bytes(r["levels"])) for r in L.fit(docs).collect()]
    c, pairs = Counter(), Counter()
    for i, t in rows:
        if not held(i):
            w = tokens(t)
            c.update(w)
            pairs.update(zip([0, *w], w))
    total, distinct = sum(c.values()), len(c)
    name = lambda w: L._hash(L.START if w == 0 else L.END if w is None else w.encode())
    for w in c:
        counts = [int(t.counts[at]) for t in tries if (at := t.find(np.array([name(w)], np.uint64))[0]) >= 0]
        assert counts and set(counts) == {c[w]}
    for (v, w), n in pairs.items():
        p1 = (c[w] + 1) / (total + distinct + 1)
        want = round((math.log10(n + L.WEIGHT * p1) + L.FLOOR) * L.STEPS)
        got = set()
        for t in tries:
            at = t.find(np.array([name(w)], np.uint64))
            if at[0] >= 0:
                got.add(int(t.pairs(at, np.array([name(v) >> 32], np.uint32))[0]))
        assert want in got


def test_probabilities_add_up():
    c, v = {"a": 5, "b": 2, None: 3}, Counter({"a": 2, "b": 1})
    total, distinct = sum(c.values()), len(c)
    p1 = [(n + 1) / (total + distinct + 1) for n in (*c.values(), 0)]
    assert math.isclose(sum(p1), 1)
    assert math.isclose(sum((v[w] + L.WEIGHT * p) / (sum(v.values()) + L.WEIGHT) for w, p in zip((*c, "unknown"), p1)), 1)


def test_edges(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert L.score_documents(none).count() == 0 and L.fit(none).count() == 0
    only_held = [(i, "x y") for i in range(40) if held(i)]
    got = L.score_documents(spark.createDataFrame(only_held, "doc_id long, text string")).collect()
    assert len(got) == len(only_held) and all(r["held_out"] and r["n_known"] == 0 and r["train_tokens"] == 0 and r["base_score"] == 0 for r in got)
    texts = pa.array(["a  b", "", "A"])
    [(_, offsets, data)] = L.slices(texts)
    t, n, hashes = L._vocabulary(data, offsets)
    assert n.tolist() == [3, 1, 2] and len(hashes) == 3 and t.tolist() == [1, 2, 0, 0, 1, 0]


def test_a_task_has_one_shard(spark, monkeypatch):
    """So what a task holds at once does not grow with the shards that a hash of their numbers puts together."""
    monkeypatch.setattr(L, "SHARD_TOKENS", 100)
    docs = spark.createDataFrame([(i, " ".join(f"w{i * k % 97}" for k in range(60))) for i in range(60)], "doc_id long, text string")
    tasks = [r["count"] for r in L.fit(docs).groupBy(F.spark_partition_id()).count().collect()]
    assert len(tasks) > 20 and set(tasks) == {1}


def test_answers_in_slices(monkeypatch):
    lists = {"words": [[1, 5], [5], [1]], "n_contexts": [[2, 1], [3], [1]], "contexts": [[7, 8, 7], [7, 8, 9], [8]], "trained": [[2, 1, 1], [0, 2, 1], [3]], "n_docs": [[1, 0, 2], [1, 1, 1], [1]], "ask": [[0, 1, 0], [0, 0, 0], [0]], "docs": [[0, 0, 1], [0, 1, 0], [4]], "times": [[2, 1, 1], [1, 2, 3], [3]]}
    rows = [pa.RecordBatch.from_pydict({"block": pa.array([3, 4, 9])} | {c: pa.array(x, pa.list_(L._SENT[c])) for c, x in lists.items()})]
    none = np.empty(0, np.uint64)
    trie = L.mapped(L.shard_levels(rows, none, none.astype(np.int64), 10, 2))
    whole = [{c: np.asarray(v).tolist() for c, v in x.items()} for x in L.shard_answers(rows, trie, 10, 2)]
    monkeypatch.setattr(L, "TOGETHER", 2)
    assert [x.num_rows for x in L._few(rows)] == [1, 1, 1]
    assert [{c: np.asarray(v).tolist() for c, v in x.items()} for x in L.shard_answers(rows, trie, 10, 2)] == whole and [x["block"] for x in whole] == [3, 4, 9]
