"""Secret scanning over an incremental ledger of content-addressed blobs.

Every version of every path is addressed by the SHA-256 of its content. A ledger holds,
for each blob and each rule with its version, the spans that were found. A run scans only
the pairs of blob and rule version that the ledger lacks, once for all paths that share
the blob, and joins the spans back to all paths.

The ledger can be a table that runs append to (open_ledger, scan_into). Batches of a run, such
as the versions of one date after another, then each scan only what no earlier batch had.

Shuffles: one of the contents (copies are combined before it, as the content is part of the
grouping key), a second one of those that lack something if the ledger knows some and more than
BROADCAST_BLOBS lack something, and small ones of hashes. Paths of a blob that very many paths
share meet its findings by broadcast (at most 2,000 blobs can be that frequent).

Edge cases: a null content is empty and has no findings. Repeated rows each get their
findings; of repeated ledger rows one counts. No rows give no rows and no ledger entries. Columns
other than path_cols and the content are ignored.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ._shared import column, join_groups, materialise, shared_dir, whole_text

SPAN = "struct<kind:string,start:int,end:int>"
#: Most blobs that are broadcast (2 MB).
BROADCAST_BLOBS = 20_000
LEDGER = f"blob string, rule string, spans array<{SPAN}>"


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of pattern whose group has at least `least` characters.

    hint is a pattern that every text with a finding has; only where it is found are all
    matches listed. Nothing is decided by it; without one it is the pattern itself.
    """

    kind: str
    pattern: str
    group: int
    least: int
    version: int = 1
    hint: str | None = None

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: The base rules.
RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, hint=r"AKIA[A-Z0-9]{14}"),
    Rule("hex", r"[0-9a-f]+", 0, 16, hint=r"[0-9a-f]{16}"),
)


#: Matches whose places are added up at a time; lists of places are copied within such a run only.
RUN = 256


def _bound(value: Column, use) -> Column:
    """use(value), with value worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def find_spans(text: Column, rule: Rule) -> Column:
    """The spans of a rule in a text, in code points: what stands between the matches gives their places.

    Places are added up in runs of RUN matches, from 0 in each, and the runs' lengths after that, so
    the time grows with the text also where it is full of matches.
    """
    pattern, none = F.lit(rule.pattern), F.array().cast(f"array<{SPAN}>")
    length = lambda c: F.coalesce(F.length(c), F.lit(0))
    span = lambda start, end: F.struct(F.lit(rule.kind).alias("kind"), start.alias("start"), end.alias("end")).cast(SPAN)
    matches = F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("all"), F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("part"))

    def run(part: Column) -> Column:
        return F.aggregate(
            part,
            F.struct(F.lit(0).alias("at"), none.alias("out")),
            lambda acc, x: F.struct(
                (acc["at"] + F.length(x["gap"]) + length(x["all"])).alias("at"),
                F.when(F.length(x["part"]) >= rule.least, F.concat(acc["out"], F.array(span(acc["at"] + F.length(x["gap"]), acc["at"] + F.length(x["gap"]) + F.length(x["all"]))))).otherwise(acc["out"]).alias("out"),
            ),
        )

    def placed(runs: Column) -> Column:
        starts = F.aggregate(
            runs,
            F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
            lambda acc, r: F.struct((acc["at"] + r["at"]).alias("at"), F.concat(acc["starts"], F.array(acc["at"])).alias("starts")),
        )["starts"]
        return F.flatten(F.zip_with(runs, starts, lambda r, start: F.transform(r["out"], lambda s: span(s["start"] + start, s["end"] + start))))

    in_runs = lambda all_: F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / RUN).cast("int")), lambda i: run(F.slice(all_, i * RUN + 1, RUN)))
    found = _bound(matches, lambda all_: _bound(in_runs(all_), placed))
    return F.when(F.rlike(text, F.lit(rule.hint or rule.pattern)), found).otherwise(none)


def open_ledger(spark: SparkSession, path: str | None = None) -> str:
    """The path of a ledger, an empty one in the shared folder if none is given."""
    path = path or f"{shared_dir(spark)}/ledger-{uuid.uuid4().hex}"
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(path)
    return path


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(path)


def _missing(versions: DataFrame, ledger: DataFrame | None, rules: tuple[Rule, ...], content_col: str) -> DataFrame:
    """(blob, rule, spans) of all pairs of a blob of versions and a rule version that the ledger lacks.

    Which blobs lack which rules is found by hashes alone. Where they are few, they are
    broadcast and no other content is shuffled.
    """
    text = whole_text(content_col)
    keys, none = [r.key for r in rules], F.array().cast("array<string>")
    rows = versions.select(F.sha2(text, 256).alias("blob"), text.alias("_text"))
    distinct = lambda df: df.groupBy("blob", "_text").agg(F.lit(1).alias("_one"))
    if ledger is None or ledger.isEmpty():
        todo = distinct(rows).withColumn("_done", none)
    else:
        done = ledger.where(F.col("rule").isin(keys)).groupBy("blob").agg(F.collect_set("rule").alias("_done"))
        lacking = rows.select("blob").distinct().join(done, "blob", "left").select("blob", F.coalesce("_done", none).alias("_done")).where(F.size("_done") < len(keys))
        lacking = materialise(lacking, "lacking")
        if lacking.count() <= BROADCAST_BLOBS:
            todo = distinct(rows.join(F.broadcast(lacking.select("blob")), "blob", "left_semi")).join(F.broadcast(lacking), "blob")
        else:
            todo = distinct(rows).join(lacking, "blob")
    found = F.array(*(F.when(~F.array_contains("_done", r.key), F.struct(F.lit(r.key).alias("rule"), find_spans(F.col("_text"), r).alias("spans"))) for r in rules))
    return todo.select("blob", F.explode(found).alias("_f")).where("_f IS NOT NULL").select("blob", "_f.rule", "_f.spans")


def findings_of(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES, path_cols: tuple[str, ...] = ("path", "version"), content_col: str = "content") -> DataFrame:
    """path_cols, blob and spans (array of kind, start, end; by start, then in the rules' order) of each row of versions.

    The findings are those that the ledger has; a row whose blob it lacks has none.
    """
    order = F.create_map(*(x for i, r in enumerate(rules) for x in (F.lit(r.key), F.lit(i))))
    paths = materialise(versions.select(*map(column, path_cols), F.sha2(whole_text(content_col), 256).alias("blob")), "paths")
    sizes = paths.groupBy("blob").agg(F.count(F.lit(1)).alias("_size"))
    one = ledger.where(F.col("rule").isin([r.key for r in rules])).groupBy("blob", "rule").agg(F.max("spans").alias("spans"))  # of repeated entries one counts
    placed = F.transform("spans", lambda s: F.struct(s["start"].alias("a"), order[F.col("rule")].alias("b"), s.alias("s")))
    by_blob = one.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list(placed))).alias("spans"))  # one entry a rule
    by_blob = by_blob.select("blob", F.transform("spans", lambda x: x["s"]).alias("spans"))
    known = sizes.join(by_blob, "blob", "left").select("blob", "_size", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans"))
    return join_groups(paths, materialise(known, "findings"), ["blob"], "_size").select(*map(column, path_cols), "blob", "spans")


def scan(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, path_cols: tuple[str, ...] = ("path", "version"), content_col: str = "content") -> tuple[DataFrame, DataFrame]:
    """(findings, new ledger rows): the findings of each row of versions, and the rows, written, to be appended to the ledger."""
    new = materialise(_missing(versions, ledger, rules, content_col), "ledger")
    known = new if ledger is None else new.unionByName(ledger.select("blob", "rule", "spans"))
    return findings_of(versions, known, rules, path_cols, content_col), new


def scan_into(path: str, versions: DataFrame, rules: tuple[Rule, ...] = RULES, content_col: str = "content") -> None:
    """Appends to the ledger at path what it lacks for versions."""
    spark = versions.sparkSession
    _missing(versions, read_ledger(spark, path), rules, content_col).write.mode("append").parquet(path)


def digest_rows(findings: DataFrame, id_col: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """A row per row of findings: the number of spans of each base kind, a digest of the base spans, and all spans as text."""
    base = [r.kind for r in RULES]
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    own = F.filter("spans", lambda s: s["kind"].isin(base))
    return findings.select(column(id_col), *(count(k).alias(f"n_{k}") for k in dict.fromkeys(r.kind for r in rules)), F.sha2(listed(own), 256).alias("base_sha256"), listed("spans").alias("spans"))
