"""Grafting a carrier character from a reference text, by alignment.

The alignment is the one that difflib defines: the longest common block (of equal ones the
first in the text, then the first in the reference) splits a pair into what stands before and
behind it, and so on. Its ties are part of the result, so this operator is an Arrow UDF.

All pairs of a batch are aligned together, a level of splitting at a time, in NumPy: the length of
each part's longest block is found by bisection, as a common block has common blocks of all lesser
lengths, and whether there is one of some length is asked by sorting the windows' hashes.
A found block is compared character by character. A false equality of hashes can only
make a block too long or put it in a wrong place, so a block that holds is the right one; where one doesn't, the
batch starts again with other hashes. Time is that of sorting the characters, times the
levels and the logarithm of the longest block; texts alike in most places have few levels.

Where a reference is the text with carriers behind every one of some characters and nowhere else, and the text has
no carrier, no alignment is worked out, as it is known: a common block lies in a piece between carriers, and all but the
last piece end with such a character and have no other one. So wherever in the text a longest piece is found, it is a
whole piece; the first of them is the block, and what stands before and behind it is of the same kind.

Edge cases: a null text stays null, a null reference changes nothing, empty texts have no blocks.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F

CARRIER, ABOVE = "\u0640", "\u0653"
RESULT = "text string, grafted int"

#: Characters of texts and references that are aligned together, at least one pair. At some 150 bytes each.
TOGETHER = 1 << 20

#: Largest primes below 2^31, so products of two residues fit 63 bits.
_PRIMES = (2147483647, 2147483629)
_BITS = 62


class _Collision(Exception):
    """Windows with equal hashes differ."""


class _Windows:
    """Hashes of the windows of one long text."""

    def __init__(self, codes: np.ndarray, powers: list[np.ndarray]):
        self.codes, self.powers = codes, powers
        self.sums = [np.concatenate(([0], np.cumsum(codes * w[: len(codes)] % p))) for w, p in zip(powers, _PRIMES)]

    def keys(self, lo: np.ndarray, hi: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(starts, keys) of all windows within [lo, hi) of each part; a key has the part's number and as much of the hash as fits."""
        parts, starts = _spread(lo, hi - lo - length + 1)
        ends, out = starts + length[parts], np.zeros(len(starts), np.int64)
        for sums, w, p in zip(self.sums, self.powers, _PRIMES):
            out = out << 31 | (sums[ends] - sums[starts]) % p * w[len(w) - 1 - starts] % p
        used = _used(len(lo))
        return starts, parts << (_BITS - used) | out >> used


def _used(parts: int) -> int:
    return max(parts - 1, 0).bit_length()


def _spread(lo: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, lo[number] + 0, 1, ...) for count values of each number."""
    parts = np.repeat(np.arange(len(lo)), count)
    return parts, np.arange(len(parts)) - (np.cumsum(count) - count)[parts] + lo[parts]


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    out, step = np.ones(1, np.int64), base
    while len(out) < n:
        out, step = np.concatenate((out, out * step % prime)), step * step % prime
    return out[:n]


def _among(keys: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    at = np.searchsorted(ordered, keys)
    return ordered[np.minimum(at, len(ordered) - 1)] == keys


def _longest(a: _Windows, b: _Windows, parts: np.ndarray, most: np.ndarray) -> np.ndarray:
    """The length, up to most, of the longest block that each part's ranges (columns alo, ahi, blo, bhi) have in common."""
    least, live = np.zeros(len(parts), np.int64), np.arange(len(parts))
    while len(live):
        length = (least[live] + most[live] + 1) // 2
        alo, ahi, blo, bhi = parts[live].T
        here, there = np.sort(a.keys(alo, ahi, length)[1]), np.sort(b.keys(blo, bhi, length)[1])
        found = np.zeros(len(live), bool)
        found[here[_among(here, there)] >> (_BITS - _used(len(live)))] = True
        least[live[found]], most[live[~found]] = length[found], length[~found] - 1
        live = live[least[live] < most[live]]
    return least


def _places(a: _Windows, b: _Windows, parts: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the first common block of this length starts in each part."""
    alo, ahi, blo, bhi = parts.T
    starts, here = a.keys(alo, ahi, length)
    others, there = b.keys(blo, bhi, length)
    order = np.argsort(there, kind="stable")
    common = np.flatnonzero(_among(here, there[order]))
    first = common[np.unique(here[common] >> (_BITS - _used(len(parts))), return_index=True)[1]]
    i, j = starts[first], others[order[np.searchsorted(there[order], here[first])]]
    if not np.array_equal(a.codes[_spread(i, length)[1]], b.codes[_spread(j, length)[1]]):
        raise _Collision
    return i, j


def _align(a_codes: np.ndarray, b_codes: np.ndarray, parts: np.ndarray, seed: int) -> np.ndarray:
    bases = np.random.default_rng(seed).integers(1 << 21, 1 << 30, len(_PRIMES))
    powers = [_powers(int(base), p, max(len(a_codes), len(b_codes)) + 1) for base, p in zip(bases, _PRIMES)]
    a, b = _Windows(a_codes, powers), _Windows(b_codes, powers)
    most, blocks = np.full(len(parts), len(a_codes)), []
    while True:
        some = np.minimum(most, np.minimum(parts[:, 1] - parts[:, 0], parts[:, 3] - parts[:, 2]))
        parts, some = parts[some > 0], some[some > 0]
        length = _longest(a, b, parts, some)
        parts, length = parts[length > 0], length[length > 0]
        if not len(parts):
            return np.concatenate([np.zeros((0, 3), np.int64), *blocks])
        i, j = _places(a, b, parts, length)
        blocks.append(np.stack((i, j, length), 1))
        before, behind = np.stack((parts[:, 0], i, parts[:, 2], j), 1), np.stack((i + length, parts[:, 1], j + length, parts[:, 3]), 1)
        parts, most = np.concatenate((before, behind)), np.concatenate((length, length))  # no later block is longer


def _codes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts, where each begins and the last ends)."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return codes, np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))


def matching_blocks(texts: Sequence[str], references: Sequence[str]) -> list[list[tuple[int, int, int]]]:
    """For each pair the blocks (place in the text, place in the reference, length), in order; those that touch are not joined."""
    if not texts:
        return []
    (a, at), (b, bt) = _codes(texts), _codes(references)
    parts = np.stack((at[:-1], at[1:], bt[:-1], bt[1:]), 1)
    seed = 0
    while True:
        try:
            blocks = _align(a, b, parts, seed)
            break
        except _Collision:
            seed += 1
    blocks = blocks[np.argsort(blocks[:, 0])]
    row = np.searchsorted(at, blocks[:, 0], "right") - 1  # a block has a character, so no empty text takes it
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for r, i, j, n in zip(row.tolist(), (blocks[:, 0] - at[row]).tolist(), (blocks[:, 1] - bt[row]).tolist(), blocks[:, 2].tolist()):
        out[r].append((i, j, n))
    return out


def _needs_carrier(text: str, at: int) -> bool:
    """Whether the combining marks from this place include ABOVE."""
    for c in map(text.__getitem__, range(at, len(text))):
        if not unicodedata.combining(c) or c == ABOVE:
            return c == ABOVE
    return False


def _spelled_out(text: str, reference: str, only_needed: bool) -> tuple[str, int] | None:
    """The graft where the reference has carriers behind every one of some characters and is the text otherwise; None where it isn't."""
    if CARRIER in text or reference.replace(CARRIER, "") != text:
        return None
    *pieces, last = reference.split(CARRIER)
    ends = [p[-1] for p in pieces if p]
    if sum(map(text.count, set(ends))) != len(ends):
        return None
    if not only_needed:
        return reference, len(pieces)
    out, added, at = [], 0, 0
    for piece in pieces:  # of a run of carriers all but the first stand behind an empty piece
        at += len(piece)
        out.append(piece)
        if _needs_carrier(text, at):
            out.append(CARRIER)
            added += 1
    return "".join([*out, last]), added


def graft_all(texts: Sequence[str], references: Sequence[str], only_needed: bool) -> list[tuple[str, int]]:
    """Runs that a reference inserts, or has in place of something, are taken over if they are carriers only."""
    out = [_spelled_out(text, reference, only_needed) for text, reference in zip(texts, references)]
    rest = [at for at, row in enumerate(out) if row is None]
    texts, references = [texts[at] for at in rest], [references[at] for at in rest]
    for row, text, reference, blocks in zip(rest, texts, references, matching_blocks(texts, references)):
        pieces, added, done, i, k = [], 0, 0, 0, 0
        for j, m, size in [*blocks, (len(text), len(reference), 0)]:
            run = reference[k:m]
            if run and not run.strip(CARRIER) and (not only_needed or _needs_carrier(text, i)):
                pieces += [text[done:j], run]  # what stood there stays before the run
                added, done = added + len(run), j
            i, k = j + size, m + size
        out[row] = "".join([*pieces, text[done:]]), added
    return out


def graft(text: Column, reference: Column, only_needed: bool = True) -> Column:
    """struct(text, grafted): null texts stay null, a null reference changes nothing."""

    def run(texts: pd.Series, references: pd.Series) -> pd.DataFrame:
        rows: list[tuple[str | None, int]] = [(t, 0) for t in texts]
        group, held = [], 0

        def settle() -> None:
            for at, row in zip(group, graft_all([texts.iat[g] for g in group], [references.iat[g] for g in group], only_needed)):
                rows[at] = row
            group.clear()

        for at, (t, r) in enumerate(zip(texts, references)):
            if t is not None and r is not None and CARRIER in r:
                if group and held + len(t) + len(r) > TOGETHER:
                    settle()
                    held = 0
                group.append(at)
                held += len(t) + len(r)
        settle()
        return pd.DataFrame(rows, columns=["text", "grafted"])

    return F.pandas_udf(run, RESULT)(text, reference)
