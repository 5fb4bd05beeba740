"""Mixing sources to target shares with a Pfair schedule.

Each source's documents are dealt into blocks of a fixed number of documents, in a fixed
pseudo-random order. With integer shares a_i of a total W, block j = 0, 1, ... of source i
is released at slot floor(j * W / a_i) and must be placed before slot
ceil((j + 1) * W / a_i). In each slot the released block with the earliest deadline goes
next (ties: the source listed first). Such a schedule meets all deadlines, so after
each slot each source is less than one block away from its share.

The shares are a parameter, so the schedule is worked out on the driver: it repeats after
W slots, and when a source is used up the others go on by their own shares in a new phase.
What the driver gets from the documents is one count per listed source; what it sends
back is a table of at most (number of shares) * W rows, broadcast for its size bound.

No document is dropped. Numbering the documents of a source takes no task with all its
rows: counts per (source, range of the order key) are summed first.

Edge cases: a null source, and every source that isn't listed, belongs to the entry
OTHERS. A null doc_id sorts first; rows with equal ids are ordered by their other columns. Rows
that repeat are numbered one by one. No rows give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import DataFrame, Window, functions as F

from ._shared import column, materialise, sortable, unused_prefix

OTHERS = "*"
#: Target shares; the entry OTHERS takes what isn't listed.
SHARES = {"src0": 5, **{f"src{i}": 3 for i in range(1, 10)}, **{f"src{i}": 2 for i in range(10, 20)}, OTHERS: 1}
BLOCK_DOCS = 16
RESULTS = ("mix_source", "mix_block", "mix_release", "mix_deadline", "mix_slot", "mix_position")
#: Hexadecimal digits of the order key that name a range: 4096 ranges, so a source with 10^10 documents has 2.5 million in each.
RANGE_DIGITS = 3


@dataclass(frozen=True)
class Phase:
    """From slot `start`, source i takes a_i of each W slots, beginning with its block first[i]."""

    start: int
    total: int
    first: dict[str, int]
    blocks: dict[str, int]  # placed in this phase
    places: dict[str, list[int]]  # slots within the first W slots
    shares: dict[str, int]


def _one_period(shares: dict[str, int]) -> dict[str, list[int]]:
    """Earliest deadline first among the released blocks, for W slots."""
    total = sum(shares.values())
    places: dict[str, list[int]] = {s: [] for s in shares}
    for slot in range(total):
        ready = [(-(-(len(places[s]) + 1) * total // a), i, s) for i, (s, a) in enumerate(shares.items()) if len(places[s]) * total // a <= slot and len(places[s]) < a]
        places[min(ready)[2]].append(slot)
    return places


def plan(blocks: dict[str, int], shares: dict[str, int]) -> list[Phase]:
    """The phases until all blocks are placed."""
    left, placed, start, phases = {s: n for s, n in blocks.items() if n}, dict.fromkeys(blocks, 0), 0, []
    while left:
        own = {s: shares[s] for s in shares if s in left}
        total, places = sum(own.values()), _one_period(own)
        ends = {s: (n - 1) // own[s] * total + places[s][(n - 1) % own[s]] + 1 for s, n in left.items()}  # the slot after its last block
        length = min(ends.values())
        took = {s: length // total * own[s] + sum(p < length % total for p in places[s]) for s in left}
        phases.append(Phase(start, total, {s: placed[s] for s in left}, took, places, own))
        for s, n in took.items():
            placed[s] += n
            left[s] -= n
        left = {s: n for s, n in left.items() if n}
        start += length
    return phases


def deviation(phases: list[Phase]) -> Fraction:
    """The largest distance of any source from its share after any slot, in blocks (for tests)."""
    worst = Fraction(0)
    for p in phases:
        for s, slots in p.places.items():
            for slot in range(p.total):
                worst = max(worst, abs(Fraction(p.shares[s] * (slot + 1), p.total) - sum(x <= slot for x in slots)))
    return worst


def mix(docs: DataFrame, shares: dict[str, int] | None = None, block_docs: int = BLOCK_DOCS, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """docs with mix_source, mix_block (from 0), mix_release, mix_deadline, mix_slot and mix_position (from 0).

    mix_slot orders the blocks and mix_position the documents of a block; release and
    deadline are slots of the whole schedule. Columns of docs that are named like one of these are left out.
    """
    shares = SHARES if shares is None else shares
    if any(not isinstance(a, int) or a < 1 for a in shares.values()) or OTHERS not in shares:
        raise ValueError(f"shares must be whole numbers from 1 and have an entry {OTHERS!r}")
    p = unused_prefix(docs)
    own = [c for c in docs.columns if c.lower() not in RESULTS]
    source = F.coalesce(column(source_col).cast("string"), F.lit(OTHERS))
    listed = F.when(source.isin(list(shares)), source).otherwise(OTHERS)
    keyed = docs.select(*map(column, own), column(id_col).alias(f"{p}id"), listed.alias(f"{p}source"), F.md5(F.coalesce(column(id_col).cast("string"), F.lit(""))).alias(f"{p}key"))
    keyed = keyed.withColumn(f"{p}range", F.conv(F.substring(f"{p}key", 1, RANGE_DIGITS), 16, 10).cast("int"))
    group = [f"{p}source", f"{p}range"]
    sizes = materialise(keyed.groupBy(*group).agg(F.count(F.lit(1)).alias(f"{p}size")), "sizes")  # a row per share and range at most: 4096 ranges
    counts = {r[0]: r[1] for r in sizes.groupBy(f"{p}source").agg(F.sum(f"{p}size")).collect()}  # a row per share at most
    before = Window.partitionBy(f"{p}source").orderBy(f"{p}range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*group, F.coalesce(F.sum(f"{p}size").over(before), F.lit(0)).alias(f"{p}before"))
    nth = F.row_number().over(Window.partitionBy(*group).orderBy(f"{p}key", F.col(f"{p}id").asc_nulls_first(), *sortable(docs.select(*map(column, own)))))
    numbered = keyed.withColumn(f"{p}nth", nth - 1).join(starts.hint("merge"), group)  # dealt by the same keys already
    numbered = numbered.withColumn(f"{p}nth", F.col(f"{p}before") + F.col(f"{p}nth"))
    numbered = numbered.withColumn(f"{p}block", F.floor(F.col(f"{p}nth") / block_docs).cast("long"))

    phases = plan({s: -(-n // block_docs) for s, n in counts.items()}, shares)
    table = [(s, x.first[s], x.first[s] + n, x.start, x.total, x.shares[s], x.places[s]) for x in phases for s, n in x.blocks.items() if n]
    # at most (number of shares)^2 rows and (number of shares) * W places, which are parameters
    schedule = docs.sparkSession.createDataFrame(table, f"{p}of string, {p}from long, {p}to long, {p}start long, {p}total long, {p}share long, {p}places array<long>")
    block, share, total = F.col(f"{p}block"), F.col(f"{p}share"), F.col(f"{p}total")
    j = block - F.col(f"{p}from")
    whole = lambda a, b: F.call_function("div", a, b)
    return numbered.join(F.broadcast(schedule), (F.col(f"{p}source") == F.col(f"{p}of")) & (block >= F.col(f"{p}from")) & (block < F.col(f"{p}to"))).select(
        *map(column, own),
        F.col(f"{p}source").alias("mix_source"),
        block.alias("mix_block"),
        (F.col(f"{p}start") + whole(j * total, share)).alias("mix_release"),
        (F.col(f"{p}start") + whole((j + 1) * total + share - 1, share)).alias("mix_deadline"),
        (F.col(f"{p}start") + whole(j, share) * total + F.get(f"{p}places", (j % share).cast("int"))).alias("mix_slot"),
        (F.col(f"{p}nth") % block_docs).cast("long").alias("mix_position"),
    )


def in_order(mixed: DataFrame) -> DataFrame:
    """The rows of mix() in the order of the schedule, across and within partitions."""
    return mixed.orderBy("mix_slot", "mix_position")


def ordered(docs: DataFrame, **how) -> DataFrame:
    """docs, all their columns and no others, in the order of the schedule."""
    p = unused_prefix(docs)
    safe = docs.select(*(column(c).alias(f"{p}{i}") for i, c in enumerate(docs.columns)))
    at = {k: f"{p}{docs.columns.index(how.get(k, d))}" for k, d in (("id_col", "doc_id"), ("source_col", "source"))}
    return in_order(mix(safe, **{**how, **at})).select(*(F.col(f"{p}{i}").alias(c) for i, c in enumerate(docs.columns)))
