"""The alignment of two tokenizers against loops over tokens."""

import hashlib
import random
from collections import Counter

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from lectern.llm import alignment  # noqa: E402

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def ends(pieces):
    at, out = 0, []
    for p in pieces:
        at += len(p)
        out.append(at)
    return out


def plain(texts):
    """Rows by text, in the order of texts."""
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    raw = {}

    def bytes_a(i):  # the byte of each letter of the vocabulary, by the library's own decoder of single letters
        if not raw:
            from tokenizers.pre_tokenizers import ByteLevel as Letters

            for c in range(256):
                try:
                    name = Letters(add_prefix_space=False, use_regex=False).pre_tokenize_str(bytes([c]).decode())[0][0]
                    raw[name] = c
                except UnicodeDecodeError:
                    pass
            left = iter(sorted(set(Letters.alphabet()) - set(raw), key=ord))
            own = [c for c in range(256) if c > 127]
            printable = [c for c in own if chr(c) in Letters.alphabet() and c != 0xAD and c > 0xA0]
            raw.update({chr(c): c for c in printable})
            left = [x for x in sorted(Letters.alphabet(), key=ord) if x not in raw]
            raw.update(zip(left, [c for c in own if c not in printable]))
        return bytes(raw[c] for c in t.id_to_token(i))

    every, counts = [], Counter()
    for text in texts:
        a = t.encode(" " + text, add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        pa_, pb = [bytes_a(i) for i in a], [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(pa_) != (" " + text).encode() or b"".join(pb) != (" " + text).encode():
            every.append(None)
            continue
        ea, eb = ends(pa_), ends(pb)
        links = [(x, y) for x, i in zip(a, ea) for y, j in zip(b, eb) if i == j]
        both = sorted(set(ea) & set(eb))
        groups, low = [], 0
        for stop in both:
            groups.append(",".join(str(x) for x, i in zip(a, ea) if low < i <= stop) + "|" + ",".join(str(y) for y, j in zip(b, eb) if low < j <= stop))
            low = stop
        counts.update(links)
        every.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return [(0, 0, 0, 0, 0, 0, "") if r is None else (*r[:3], len(r[3]), sum(counts[x] == most[x[1]] for x in r[3]), sum(counts[x] for x in r[3]), r[4]) for r in every]


def corpus():
    rng = random.Random(5)
    words = ["the", "house", "Straße", "über", "naïve", "日本語", "🙂", "x1y2", "don't", "<|endoftext|>", "</s>", "<unk>", "́e", "…", "foo_bar", "12345", "ﬁ", "\xa0"]
    texts = [rng.choice(("", " ", "\n")) + "".join(rng.choice(words) + rng.choice((" ", "  ", "\n", "\t", "", ", ", ".\n\n")) for _ in range(rng.randrange(1, 25))) for _ in range(120)]
    return texts + [None, "", " ", "  ", "\n", "a", "a▁b", "▁", "the " * 3000, "the", "the", "\x00", "a\r\nb", "x" * 500, "é" * 300, "▁▁ x"]


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("shares, block, step", [(400, 8 << 20, 1_000_000), (3, 900, 40), (1, 200, 7)])
def test_alignment_against_loops(spark, monkeypatch, shares, block, step):
    """Blocks and batches of any size, ids of B split or not."""
    texts = corpus()
    want = {i: w for i, w in enumerate(plain(texts))}
    rows = [(i if i != 4 else None, t, 1, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, b int, block string").repartition(3)
    for name, value in (("BLOCK", block), ("STEP", step), ("HELD", 50 * step)):
        monkeypatch.setattr(alignment, name, value)
    table = alignment.blocks(docs, A, B)
    if block < 1000:  # workers have their own copy of the module, so blocks are made here as well
        assert table.where("b IS NOT NULL").count() > 0
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in alignment.align_documents(docs, A, B, shares=shares).collect()}
    assert got.pop(None) == want[4]
    assert got == {i: w for i, w in want.items() if i != 4}


def test_small_batches_in_one_process(monkeypatch):
    """The streams without Spark: count lists before posting lists, cut anywhere."""
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(alignment, "STEP", 2)
    monkeypatch.setattr(alignment, "HELD", 3)
    rng = np.random.default_rng(1)
    links = [(int(rng.integers(2)), int(rng.integers(3)), int(rng.integers(4)), int(rng.integers(3))) for _ in range(60)]  # block, document, a, b
    counts = Counter((a, b) for *_, a, b in links)
    most = {b: max(n for (_, y), n in counts.items() if y == b) for _, b in counts}
    rows = []
    for block in (0, 1):
        d, a, b = (np.array(x) for x in zip(*[x[1:] for x in links if x[0] == block]))
        lists = {k: v.to_pylist() for k, v in alignment.posting_lists(d, a, b, 4).items()}
        for i, y in enumerate(lists["b"]):
            rows.append((y, 0, 0, block, lists["a"][i], lists["totals"][i], None, None, None))
            rows.append((y, 0, 1, block, lists["a"][i], None, lists["runs"][i], lists["docs"][i], lists["times"][i]))
    rows.sort(key=lambda r: r[:4])
    schema = pa.schema([("b", pa.int32()), ("slot", pa.int32()), ("kind", pa.int32()), ("block", pa.int64()), *((n, alignment._POSTINGS[n]) for n in ("a", "totals", "runs", "docs", "times"))])
    for cut in (1, 3, 100):
        batches = [pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows[k : k + cut]], schema=schema) for k in range(0, len(rows), cut)]
        best, total = Counter(), Counter()
        for out in alignment._contribute(iter(batches)):
            for r in out.to_pylist():
                for d, x, y in zip(r["docs"], r["best"], r["total"]):
                    best[r["block"], d] += x
                    total[r["block"], d] += y
        for block, d in total:
            own = [(a, b) for k, e, a, b in links if (k, e) == (block, d)]
            assert (best[block, d], total[block, d]) == (sum(counts[x] == most[x[1]] for x in own), sum(counts[x] for x in own))


def test_no_documents(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    got = alignment.align_documents(none, A, B)
    assert got.count() == 0 and got.columns == ["doc_id", *COLUMNS]
    only = spark.createDataFrame([(1, None), (1, ""), (None, "▁")], "doc_id long, text string")
    assert sorted((r["doc_id"] or 0, *(r[c] for c in COLUMNS)) for r in alignment.align_documents(only, A, B).collect()) == [(0, 0, 0, 0, 0, 0, 0, ""), (1, 0, 0, 0, 0, 0, 0, ""), (1, 0, 0, 0, 0, 0, 0, "")]
