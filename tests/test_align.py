"""Alignment of many pairs at once against difflib, pair by pair."""

import difflib
import random
import time

import numpy as np
from pyspark.sql import functions as F

from lectern.operators import align
from lectern.operators.align import ABOVE, CARRIER, graft, graft_all, matching_blocks


def joined(blocks):
    """Blocks that touch on both sides are one."""
    out = []
    for i, j, n in blocks:
        if out and out[-1][0] + out[-1][2] == i and out[-1][1] + out[-1][2] == j:
            out[-1] = (*out[-1][:2], out[-1][2] + n)
        else:
            out.append((i, j, n))
    return out


def by_difflib(a, b):
    return [tuple(x) for x in difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks()[:-1]]


def plain_graft(text, reference, only_needed):
    """The rule on difflib's opcodes."""
    out, added = "", 0
    for tag, i, j, k, m in difflib.SequenceMatcher(None, text, reference, autojunk=False).get_opcodes():
        out += text[i:j]
        run = reference[k:m]
        if tag in ("insert", "replace") and set(run) == {CARRIER} and (not only_needed or align._needs_carrier(text, i)):
            out, added = out + run, added + len(run)
    return out, added


def pairs(count, alphabet, longest, seed):
    rng = random.Random(seed)
    for _ in range(count):
        a = "".join(rng.choices(alphabet, k=rng.randint(0, longest)))
        b = list(a)
        for _ in range(rng.randint(0, 6)):
            at = rng.randint(0, len(b))
            b[at : at + rng.randint(0, 3)] = rng.choices(alphabet, k=rng.randint(0, 3))
        yield a, "".join(b) if rng.random() < 0.7 else "".join(rng.choices(alphabet, k=rng.randint(0, longest)))


def test_blocks_are_those_of_difflib():
    some = [*pairs(5000, "ab", 30, 1), *pairs(3000, "abcdef", 60, 2), *pairs(2000, f"xy{CARRIER}{ABOVE}\U0001f600", 40, 3)]
    texts, references = zip(*some)
    assert [joined(x) for x in matching_blocks(texts, references)] == [by_difflib(a, b) for a, b in some]


def test_grafts_follow_the_rule():
    some = [*pairs(2000, f"by{CARRIER}{ABOVE}\u0670", 40, 4), ("", CARRIER), ("a", ""), ("", "")]
    texts, references = zip(*some)
    for only_needed in (True, False):
        assert graft_all(texts, references, only_needed) == [plain_graft(a, b, only_needed) for a, b in some]


def test_carriers_behind_every_one_of_some_characters(monkeypatch):
    """Known without an alignment; and what is nearly so is aligned."""
    rng = random.Random(8)
    known = nearly = 0
    for _ in range(6000):
        text = "".join(rng.choices(f"ab{ABOVE}xy"[: rng.randint(1, 5)], k=rng.randint(0, 30)))
        marked = rng.choice(["a", "ab", "x", ABOVE, "b" + ABOVE])
        reference = CARRIER * rng.randint(0, 1) + "".join(c + CARRIER * rng.choice((1, 1, 2)) if c in marked else c for c in text)
        if rng.random() < 0.3 and reference:
            at = rng.randrange(len(reference))
            reference = reference[:at] + reference[at + 1 :]
        for only_needed in (True, False):
            got = align._spelled_out(text, reference, only_needed)
            assert graft_all([text], [reference], only_needed) == [plain_graft(text, reference, only_needed)]
            known, nearly = known + (got is not None), nearly + (got is None)
    assert known > 3000 and nearly > 500
    assert align._spelled_out("ababab", f"ab{CARRIER}abab", False) is None  # its longest piece stands elsewhere in the text, too
    monkeypatch.setattr(align, "_align", None)
    assert graft_all(["beten"] * 9, [f"be{CARRIER}te{CARRIER}n"] * 9, False) == [(f"be{CARRIER}te{CARRIER}n", 2)] * 9


def test_no_pairs_and_hashes_that_fail(monkeypatch):
    assert matching_blocks([], []) == []
    assert matching_blocks(["", "abc", ""], ["", "xbcx", "a"]) == [[], [(1, 1, 2)], []]
    some = list(pairs(200, "abcdefgh", 40, 5))
    with monkeypatch.context() as m:  # bad bases first: hashes by which nearly all windows look equal
        m.setattr(align.np.random, "default_rng", lambda seed: type("Bad", (), {"integers": lambda *a: np.array([1, 1])})() if seed < 2 else np.random.Generator(np.random.PCG64(seed)))
        assert [joined(x) for x in matching_blocks(*zip(*some))] == [by_difflib(a, b) for a, b in some]


def test_a_megabyte_in_seconds():
    rng = random.Random(6)
    a = "".join(rng.choices("abcdefghij ", k=1_000_000))
    b = a
    for at in sorted(rng.sample(range(len(a)), 300), reverse=True):
        b = b[:at] + CARRIER + b[at:]
    began = time.time()
    assert graft_all([a], [b], False) == [(b, 300)]
    assert time.time() - began < 90


def test_column(spark):
    rows = [(None, "x"), ("x", None), (f"y{ABOVE}", f"y{CARRIER}{ABOVE}"), ("y", f"y{CARRIER}"), ("", "")] * 3
    df = spark.createDataFrame(rows, "t string, r string")
    got = [tuple(r["g"]) for r in df.select(graft(F.col("t"), F.col("r")).alias("g")).collect()]
    assert got == [(None, 0), ("x", 0), (f"y{CARRIER}{ABOVE}", 1), ("y", 0), ("", 0)] * 3


def query_like(count, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices("etaoin shrdlu.,", k=rng.randint(0, 300))) for _ in range(count)]


def test_pairs_of_graft_needed_carriers_are_not_aligned(monkeypatch):
    """aligned, they took 150 bytes a character in each worker."""
    texts = [t.replace("e", "e" + ABOVE).replace("o", "o\u064e") for t in query_like(300, 11)]
    references = [t.replace("e", "e" + CARRIER).replace("o", "o" + CARRIER) for t in texts]
    by_rule = [plain_graft(a, b, True) for a, b in zip(texts[:60], references)]
    monkeypatch.setattr(align, "_align", None)
    got = graft_all(texts, references, True)
    assert got == [(t.replace("e", "e" + CARRIER), t.count("e")) for t in texts] and got[:60] == by_rule


def test_pairs_of_graft_carriers_take_no_time():
    """aligned, these 4 MB had not ended after most of a minute."""
    texts = query_like(60, 12) + ["e".join(query_like(300, 13)) * 90]
    references = [t.replace("e", "e" + CARRIER) for t in texts]
    by_rule = [plain_graft(a, b, False) for a, b in zip(texts[:60], references)]
    began = time.process_time()
    got = graft_all(texts, references, False)
    assert time.process_time() - began < 5
    assert got == [(r, t.count("e")) for t, r in zip(texts, references)] and got[:60] == by_rule
