"""The pipeline against a version in plain Python that uses the operators' own brute-force rules."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from lectern.llm import mixing
from test_native import base
from test_python import slow_print, smallest_reachable


def test_pipeline(spark, tmp_path):
    rng = random.Random(11)
    words = [f"word{i}" for i in range(40)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    texts = [text(rng.randint(25, 90)) for _ in range(60)]
    texts += [t.replace(" ", "\n", 1) for t in texts[:10]]  # equal but for white space
    texts += ["short text", "", None, "again and again " * 40]
    texts += [(t := text(400)), t + " end", t.replace("word1 ", "word2 ", 1)]
    rows = [(i, t, "en", f"src{i % 3}" if i % 7 else None, len(t or "")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()

    keep = [r for r in rows if not base(r[1])[5]]  # of one vocabulary, so the base rules decide
    first = {}
    for r in keep:
        first.setdefault(" ".join(r[1].split()), r[0])
    keep = [r for r in keep if r[0] in first.values()]
    heads = set(smallest_reachable([slow_print(r[1]) for r in keep], [r[0] for r in keep]))
    assert {r["doc_id"] for r in out} == heads
    assert [r for r in rows if r[0] in heads] and len(heads) < len(keep) < len(rows)


def test_each_stage_returns_documents_and_passes_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string"
    docs = spark.createDataFrame([], schema)
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 0
        if name != "tokens":
            assert out.columns == docs.columns
            docs = out


def test_stages_keep_columns_of_any_name(spark, tmp_path):
    from test_native import CLASH, clashing, mine

    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = clashing(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and mine(out), name
        docs = out
    last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert last.columns == ["doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256", "mix_slot", "mix_position"] and last.count() == docs.count()


def test_mix_stage_orders_by_the_schedule(spark):
    rows = [(i, "x", f"src{i % 2}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = mixing.mix(docs).withColumn("_k", F.struct("mix_slot", "mix_position")).orderBy("_k")
    got = corpus_pipeline.mix_sources(spark, docs, "")
    assert [r["doc_id"] for r in got.collect()] == [r["doc_id"] for r in want.collect()]


def test_run_follows_the_schedule_over_several_files(spark, tmp_path, monkeypatch):
    rng = random.Random(12)
    text = lambda: " ".join(f"w{rng.randrange(400)}" for _ in range(rng.choice([25, 60, 900])))
    rows = [(i, text(), f"src{i * i % 5}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[-2:])
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes")}
    try:
        for k, v in zip(old, ("false", "1", "20000")):
            spark.conf.set(k, v)
        out = corpus_pipeline.run(spark, str(tmp_path))
        assert len(out.inputFiles()) > 1
        want = [(r["doc_id"], r["mix_slot"], r["mix_position"]) for r in mixing.in_order(mixing.mix(docs)).collect()]
        assert [(r["doc_id"], r["mix_slot"], r["mix_position"]) for r in out.collect()] == want
        # the files by name, and the rows in each, are in this order too
        files = [spark.read.parquet(f).collect() for f in sorted(out.inputFiles())]
        assert [r["doc_id"] for rows in files for r in rows] == [d for d, *_ in want]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
