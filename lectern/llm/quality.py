"""Quality rules: word and line statistics, then a hashed n-gram log-likelihood ratio.

Words and pairs of neighbouring words of a document fall by hash into BUCKETS buckets.
One multinomial over the buckets is counted from trusted documents, one from all
documents. A document's score is the sum over its n-grams of the log of the ratio of the
two, divided by their number. SMOOTHING is added to a bucket's trusted count and to what
the raw counts let expect of it, so rare buckets say little and the score means the same
at any corpus size. The document is kept if no base rule fails and the score reaches a
fixed threshold. The weights are whole millionths, so the sum does not depend on its order.

Only built-in column functions are used. The documents are read twice and never
shuffled: counting combines per task to a row per bucket at most, and the weights, BUCKETS
whole numbers, go through the driver into the plan as a constant. The ids of trusted documents
are a bounded sample (TRUSTED_DOCS, those with the smallest hashes of their ids), so their
broadcast has a fixed bound; the raw counts cover all documents.

Edge cases: columns of docs are kept by keep() whatever their names, while score() leaves out those
that are named like one of its results. A null text is empty and fails the base rules, as does any text with under
MIN_WORDS words. A null id is never trusted; repeated rows count each. Without trusted
documents both multinomials are alike for the purpose: all weights are 0 and the base
rules decide. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ._shared import SPACE, column, own_columns, unused_prefix, whole_text

BUCKETS = 1 << 16
SMOOTHING = 8
TRUSTED_DOCS = 20_000
WINDOW = 8
MIN_WORDS, MAX_REPEATED_PERCENT = 20, 30
#: Mean log ratio, in nats, below which a document is dropped.
THRESHOLD = -0.15
UNIT = 1_000_000
RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")


def _pairs(values: str, step: int, combine) -> Column:
    """combine(x[i], x[i + step]) for all i."""
    n = F.greatest(F.size(values) - step, F.lit(0))
    return F.zip_with(F.slice(values, F.lit(1), n), F.slice(values, F.lit(step + 1), n), combine)


def _hashed(docs: DataFrame, p: str, text: Column) -> DataFrame:
    """Adds, with prefix p: words, h1 (their hashes) and h2 (of pairs)."""
    return (
        docs.withColumn(f"{p}words", F.array_remove(F.split(text, f"[{SPACE}]+"), ""))
        .withColumn(f"{p}h1", F.transform(f"{p}words", lambda w: F.xxhash64(w)))
        .withColumn(f"{p}h2", _pairs(f"{p}h1", 1, lambda a, b: F.xxhash64(a, b)))
    )


def _bucket(h: Column) -> Column:
    return F.pmod(h, F.lit(BUCKETS).cast("long")).cast("int")


def trusted_sample(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """At most TRUSTED_DOCS ids of documents labelled good and not toxic."""
    return labels.where("quality = 1 AND toxic = 0").select(column(id_col).alias("_trusted")).where("_trusted IS NOT NULL").distinct().orderBy(F.xxhash64("_trusted"), "_trusted").limit(TRUSTED_DOCS)


def weights(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row with the array `weights`: for each bucket the log ratio in millionths."""
    flagged = docs.select(column(id_col).alias("_id"), whole_text(text_col).alias("_t")).join(F.broadcast(trusted), F.col("_id") == F.col("_trusted"), "left")
    grams = _hashed(flagged, "_", F.col("_t")).select(F.when(F.col("_trusted").isNotNull(), 1).otherwise(0).alias("_in"), F.explode(F.concat("_h1", "_h2")).alias("_g"))
    counts = grams.groupBy(_bucket(F.col("_g")).alias("_b")).agg(F.count(F.lit(1)).alias("_raw"), F.sum("_in").alias("_target"))
    filled = docs.sparkSession.range(0, BUCKETS, 1, 1).select(F.col("id").cast("int").alias("_b")).join(counts, "_b", "left").select("_b", F.coalesce("_raw", F.lit(0)).alias("_raw"), F.coalesce("_target", F.lit(0)).alias("_target"))
    row = filled.agg(F.array_sort(F.collect_list(F.struct("_b", "_raw", "_target"))).alias("_all"), F.sum("_raw").alias("_r"), F.sum("_target").alias("_t"))
    expected = lambda x: x["_raw"] * (F.col("_t") / F.col("_r"))
    ratio = F.when(F.col("_t") > 0, F.transform("_all", lambda x: F.round(F.log((x["_target"] + SMOOTHING) / (expected(x) + SMOOTHING)) * UNIT).cast("long")))
    return row.select(F.coalesce(ratio, F.array_repeat(F.lit(0).cast("long"), BUCKETS)).alias("weights"))


def _repeated_words(df: DataFrame, p: str) -> DataFrame:
    """Adds repeated, with prefix p: how many words stand in a window of WINDOW words that the text has twice or more.

    Hashes of windows find texts that may have one; there the windows themselves are compared.
    """
    longs = F.array().cast("array<int>")
    strings = F.array().cast("array<struct<s:string,i:int>>")
    hashes = F.array().cast("array<struct<h:bigint,i:int>>")
    c = lambda name: f"{p}{name}"
    # Of two neighbours in a sorted list that agree, both places; doubles go.
    places = lambda name, field: F.array_sort(F.array_distinct(F.flatten(F.filter(_pairs(name, 1, lambda a, b: F.when(a[field] == b[field], F.array(a["i"], b["i"]))), lambda x: x.isNotNull()))))
    following = F.slice(c("at"), F.lit(2), F.greatest(F.size(c("at")) - 1, F.lit(0)))
    gaps = F.zip_with(c("at"), following, lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    return (
        df.withColumn(c("h4"), _pairs(c("h2"), 2, lambda a, b: F.xxhash64(a, b)))
        .withColumn(c("h8"), _pairs(c("h4"), 4, lambda a, b: F.xxhash64(a, b)))
        .withColumn(c("sorted"), F.when(F.size(c("h8")) > F.size(F.array_distinct(c("h8"))), F.array_sort(F.transform(c("h8"), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(hashes))
        .withColumn(c("maybe"), F.when(F.size(c("sorted")) > 0, places(c("sorted"), "h")).otherwise(longs))
        .withColumn(c("windows"), F.when(F.size(c("maybe")) > 0, F.array_sort(F.transform(c("maybe"), lambda i: F.struct(F.array_join(F.slice(c("words"), i + 1, F.lit(WINDOW)), " ").alias("s"), i.alias("i"))))).otherwise(strings))
        .withColumn(c("at"), F.when(F.size(c("windows")) > 0, places(c("windows"), "s")).otherwise(longs))
        .withColumn(c("n_repeat_words"), F.when(F.size(c("at")) > 0, F.aggregate(gaps, F.lit(0), lambda x, n: x + n)).otherwise(0).cast("long"))
    )


def _scored(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str, threshold: float) -> tuple[DataFrame, str]:
    """(docs with the results and more under a prefix that no column of docs has, that prefix)."""
    p = unused_prefix(docs)
    c = lambda name: F.col(f"{p}{name}")
    fitted = weights(docs, trusted, id_col, text_col).first()["weights"]  # BUCKETS whole numbers
    table = F.split(F.lit(",".join(map(str, fitted))), ",").cast("array<bigint>")  # folded into one constant
    text = whole_text(text_col)
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    total = lambda name: F.aggregate(c(name), F.lit(0).cast("long"), lambda x, h: x + F.get(table, _bucket(h)))
    failed = (c("n_words") < MIN_WORDS) | (c("n_repeat_words") * 100 > c("n_words") * MAX_REPEATED_PERCENT)
    # The condition is always true. As it isn't deterministic, a filter on one of these columns stays
    # above what it is computed from, instead of being pushed down with copies of all those expressions.
    fixed = lambda name: F.when(F.spark_partition_id() >= 0, c(name))
    scored = (
        _repeated_words(_hashed(docs, p, text), p)
        .withColumn(f"{p}lines", lines)
        .withColumns({
            f"{p}n_words": F.size(c("words")).cast("long"),
            f"{p}word_chars": F.length(F.array_join(c("words"), "")).cast("long"),
            f"{p}n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
            f"{p}n_dup_lines": (F.size(c("lines")) - F.size(F.array_distinct(c("lines")))).cast("long"),
            f"{p}score": F.coalesce((total("h1") + total("h2")) / F.nullif(F.size(c("h1")) + F.size(c("h2")), F.lit(0)) / UNIT, F.lit(0.0)),
        })
        .withColumn(f"{p}base_failed", failed)
        .withColumn(f"{p}kept", ~c("base_failed") & (c("score") >= threshold))
        .withColumns({f"{p}{name}": fixed(name) for name in RESULTS})
    )
    return scored, p


def score(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs with the columns of RESULTS."""
    scored, p = _scored(docs, trusted, id_col, text_col, threshold)
    return scored.select(*(column(x) for x in docs.columns if x.lower() not in RESULTS), *(F.col(f"{p}{name}").alias(name) for name in RESULTS))


def keep(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that the rules and the score let pass, with their own columns."""
    scored, p = _scored(docs, trusted, id_col, text_col, threshold)
    return scored.where(F.col(f"{p}kept")).select(*own_columns(docs))
