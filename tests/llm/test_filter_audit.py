"""The filter audit against a plain loop over documents and orders."""

import random
from itertools import permutations

import numpy as np
import pyarrow as pa

from lectern.llm import filter_audit

GAPS = " \t\n\x0b\x0c\r"


def split(text):
    return "".join(" " if c in GAPS else c for c in text).split(" ")


def plain_masks(rows):
    out = []
    for i, text, _ in rows:
        t = text or ""
        w = [x for x in split(t) if x]
        fails = [len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t), any(c in "#$%&*|" for c in t)]
        out.append([*fails, i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows)])
    return out


def plain_audit(rows, labels):
    good, toxic = ({i for i, *x in labels if x[k] == 1 and i is not None} for k in (0, 1))
    fails, out = plain_masks(rows), {}
    parts = {r[2] or "" for r in rows}
    for part in parts:
        for order in map("".join, permutations("ABCDE")):
            for step, letter in enumerate(order, 1):
                got = dict.fromkeys(("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"), 0)
                for (i, _, lang), f in zip(rows, fails):
                    if (lang or "") != part:
                        continue
                    fail, gone = f["ABCDE".index(letter)], any(f["ABCDE".index(x)] for x in order[: step - 1])
                    got["kept"] += not fail and not gone
                    got["removed"] += fail and not gone
                    got["redundant"] += fail and gone
                    got["unique_fails"] += fail and sum(f) == 1
                    got["good_lost"] += fail and not gone and i in good
                    got["toxic_lost"] += fail and not gone and i in toxic
                out[part, order, step] = got
    for (part, order, step), got in out.items():
        got["shapley"] = sum(x["removed"] for (p, o, s), x in out.items() if p == part and o[s - 1] == order[step - 1])
    return out


def corpus():
    rng = random.Random(3)
    text = lambda n, many: " ".join(rng.choice(("w", "É", "AB", "x#", "ｗ")) * (k % 2 + 1) + str(rng.randrange(many)) for k in range(n))
    texts = [text(rng.choice((3, 199, 200, 260)), rng.choice((20, 5000))) for _ in range(30)]
    texts += ["plain words here", "tab\tand\x0bmore\x0c\r\n", "", None, " ", "\x1c\x85 \xa0", "ABC", "a" * 97 + "BCD", "a" * 96 + "BCD", "x|y", " ".join(f"n{i}" for i in range(210))]
    texts += texts[:6] + texts[-3:]
    rows = [(i if i % 11 else None, t, [None, "", "en", "fr"][i % 4]) for i, t in enumerate(texts)]
    return rows + rows[5:9]


def test_audit_against_loops(spark):
    rows = corpus()
    labels = [(i, rng % 2, rng % 3 - 1) for i, rng in zip(range(0, 40), range(7, 47))] + [(3, 1, 1), (3, 0, 0), (None, 1, 1), (999, 1, 1), (5, None, None)]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, lang string, mask string, n int")
    marks = spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, part string")
    want = plain_audit(rows, labels)
    got = {(r["part"], r["filter_order"], r["step"]): {k: r[k] for k in r.asDict() if k not in ("part", "filter_order", "step")} for r in filter_audit.audit(docs, marks).collect()}
    assert got == want and len(got) == 3 * 600
    assert filter_audit.audit(docs.limit(0), marks).count() == 0


def test_words_that_share_a_hash(monkeypatch):
    texts = ["a b a c b", "", "x x x", "long words are longer than short words", "b a"] * 3
    want = [len({w for w in t.split(" ") if w}) for t in texts]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    first, stop = filter_audit.words(data, offsets)
    for hashes in (filter_audit.word_hashes(data, first, stop), np.zeros(len(first), np.uint64), (stop - first).astype(np.uint64)):
        assert filter_audit.distinct_words(data, offsets, first, stop, hashes).tolist() == want


def test_slices_do_not_matter(monkeypatch):
    texts = [t or "" for _, t, _ in corpus()] + ["long " * 3000]
    want = filter_audit.masks(pa.array(texts)).tolist()
    assert want[:-1] == [sum(x << k for k, x in enumerate(m[:4])) for m in plain_masks(corpus())]
    real = filter_audit.slices
    monkeypatch.setattr(filter_audit, "slices", lambda t: real(t, 50))
    assert filter_audit.masks(pa.array(["cut", *texts], pa.string()).slice(1)).tolist() == want
