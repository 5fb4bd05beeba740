"""Work that op2 does once a slice or once a piece."""

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

from lectern.llm import token_shards  # noqa: E402

BPE = public_tokenizers.path("byte_bpe_50k.json")


def batch(sizes):
    return pa.RecordBatch.from_arrays([pa.array(["x" * n for n in sizes]), pa.array([str(k) for k in range(len(sizes))])], names=["text", "key"])


def test_slices_are_equal_and_leave_no_small_rest(monkeypatch):
    """What is remembered is searched once a slice, so a rest of some bytes costs as much as a slice."""
    monkeypatch.setattr(token_shards, "SLICE", 1000)
    rng = np.random.default_rng(3)
    for total in (1030, 1400, 2100, 2990, 7450):
        sizes = rng.multinomial(total, [1 / 60] * 60).tolist()
        got = [(sum(map(len, texts.to_pylist())), keys.to_pylist()) for texts, keys in token_shards._slices(batch(sizes))]
        assert [k for _, keys in got for k in keys] == [str(k) for k in range(60)]
        assert len(got) == round(total / 1000) and min(n for n, _ in got) > 500 and max(n for n, _ in got) < 1600
    for sizes in ([], [0], [0, 0, 0], [5000, 0, 1], [1, 5000, 0], [0, 999, 2500, 3, 0]):
        got = [keys.to_pylist() for _, keys in token_shards._slices(batch(sizes))]
        assert sum(got, []) == [str(k) for k in range(len(sizes))] and all(got)


def test_pieces_are_looked_up_with_their_repeats():
    """One look-up takes pieces with repeats, and each new one has one entry."""
    own = token_shards.TextEncoder(BPE)
    names = pa.array(["abc", "\nabc", "abc", " ,", "z" * 50, "été", " ,", "abc"], pa.large_string())
    entry, stay = own._entries(names)
    assert entry[0] == entry[2] == entry[7] and entry[3] == entry[6] and len(set(entry.tolist())) == 5
    assert len(own.length) == 6 and stay == 5 and entry[4] == 5  # the long piece is last and may not stay
    assert own.hits[1:].tolist() == [1] * 5
    for name, at in zip(names.to_pylist(), entry.tolist()):
        text = name if name[0] == "\n" else name[1:] if name[0] == " " else " " + name
        first = int(own.length[:at].sum())
        assert own.flat[first : first + int(own.length[at])].tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids
    again, _ = own._entries(names)
    assert (again[[0, 1, 3, 5]] == entry[[0, 1, 3, 5]]).all()


def test_chosen_pairs_are_found_where_slots_are_shared():
    rng = np.random.default_rng(4)
    for kind in (np.uint32, np.uint64):
        pair = rng.integers(0, 1 << 20, 400_000).astype(kind) * kind(4099)
        chosen = np.unique(rng.choice(pair, 30_000))
        at, which = token_shards._places(chosen, pair)
        assert (at == np.flatnonzero(np.isin(pair, chosen))).all() and (chosen[which] == pair[at]).all()
