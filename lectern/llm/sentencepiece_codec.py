"""SentencePiece BPE encoding by backtracking, and decoding.

A text is the merge result exactly when each two adjacent tokens, put together and merged
again, give the same two tokens. So no merge queue over the whole text is needed: an
Aho-Corasick automaton gives all pieces at each position, the encoder takes the longest
one, checks it against its left neighbour by re-merging the two, and otherwise takes the
next shorter one or steps back. A bitfield holds the positions that were found to fail,
so none is tried twice and the time stays linear.

Re-merging two tokens means undoing their merges from the last to the first and looking
whether the two parts that then meet would have merged earlier.

A text is cut where no piece spans the two characters: before a run of spaces, and between
a Latin letter and another character. Both are checked against the model when it is loaded, and
a model with pieces that span such a place gets no cut there. Each worker remembers the
results of short chunks; the memory has a fixed bound.

Edge cases: a null text is an empty text, which has only the end id (if asked for).
Characters that no piece has become byte pieces, or the unknown id if the model has none.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ._shared import whole_text

MARK = "▁"
#: A run of Latin letters; other characters, letters of other scripts too, count as the other kind.
LETTER = re.compile(r"[A-Za-zÀ-ÖØ-öø-ɏ]+")
OTHER = r"[^A-Za-zÀ-ÖØ-öø-ɏ▁]+"
#: Results of chunks that a worker remembers in each of two generations, the same for pairs, and the longest such chunk.
MEMORY, PAIRS, LONGEST = 500_000, 200_000, 40
#: Ids that a worker holds before it passes rows on.
HELD = 500_000


class SentencePieceCodec:
    """Encoder and decoder of one BPE model file."""

    def __init__(self, model_path: str, memory: int = MEMORY):
        from sentencepiece import sentencepiece_model_pb2 as proto

        with open(model_path, "rb") as f:
            model = proto.ModelProto.FromString(f.read())
        kinds = proto.ModelProto.SentencePiece
        if model.trainer_spec.model_type != proto.TrainerSpec.BPE:
            raise ValueError("not a BPE model")
        spec = model.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models whose normaliser keeps the text are supported")
        if any(p.type == kinds.USER_DEFINED for p in model.pieces):
            raise ValueError("user-defined pieces are not supported")
        self.memory = memory
        self.prefix = MARK if spec.add_dummy_prefix else ""
        self.rank: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.bytes: list[bytes] = []
        self.byte_ids: dict[int, int] = {}
        self.unknown, self.end = 0, model.trainer_spec.eos_id
        for i, p in enumerate(model.pieces):
            if p.type == kinds.BYTE:
                self.byte_ids[int(p.piece[3:5], 16)] = i
                self.bytes.append(bytes([int(p.piece[3:5], 16)]))
            elif p.type == kinds.NORMAL:
                self.rank[p.piece], self.id[p.piece] = -p.score, i
                self.bytes.append(p.piece.replace(MARK, " ").encode())
            elif p.type == kinds.UNKNOWN:
                self.unknown = i
                self.bytes.append(model.trainer_spec.unk_surface.encode())
            else:
                self.bytes.append(b"")
        self.chars = {c for c in self.rank if len(c) == 1}
        self.marked = [p.startswith(MARK) for p in (x.piece for x in model.pieces)]
        self.automaton = ahocorasick.Automaton()
        self.halves: dict[str, tuple[str, str]] = {}  # of each piece, the two parts of its last merge
        for piece in self.rank:
            steps: list[tuple[str, str]] = []
            if self._merge(piece, steps) == [piece]:  # the others are never made by merging
                self.automaton.add_word(piece, len(piece))
                if steps:
                    self.halves[piece] = steps[-1]
        self.automaton.make_automaton()
        ranks = [r for p, r in self.rank.items() if len(p) > 1 and p.strip(MARK)]
        self.distinct = len({*ranks}) == len(ranks)  # else pairs are always merged again in full
        self.cuts = not any(MARK in p.lstrip(MARK) for p in self.rank)
        word = not any(LETTER.search(p) and not LETTER.fullmatch(p.lstrip(MARK)) for p in self.rank)
        self.chunks = re.compile(f"{MARK}*(?:{LETTER.pattern}|{OTHER})|{MARK}+" if word else f"{MARK}*[^{MARK}]+|{MARK}+")
        self.digits = [str(i) for i in range(len(self.bytes))]
        self.pairs: dict[tuple[str, str], bool] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def _merge(self, text: str, steps: list | None = None) -> list[str]:
        """The definition, for a few characters: merge the best pair, the leftmost of equals, until none is left."""
        parts = list(text)
        while True:
            best = min(((self.rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.rank), default=None)
            if best is None:
                return parts
            pair = parts[best[1]], parts[best[1] + 1]
            parts[best[1] : best[1] + 2] = ["".join(pair)]
            if steps is not None:
                steps.append(pair)

    def _stays(self, left: str, right: str) -> bool:
        """Whether merging left + right gives left and right again."""
        if not (self.distinct and left.strip(MARK) and right.strip(MARK)):  # runs of marks have equal ranks
            return self._merge(left + right) == [left, right]
        rank, halves, before, also = self.rank, self.halves, float("inf"), False
        while True:
            meet = rank.get(left + right)
            if meet is not None and (meet < before or also and meet == before):
                return False
            a, b = halves.get(left), halves.get(right)
            if b and (not a or rank[left] <= rank[right]):  # the merge that made right came last; an equal one further left would have come first
                before, also, right = rank[right], True, b[0]
            elif a:
                before, also, left = rank[left], False, a[1]
            else:
                return True

    def _span(self, text: str) -> list[str]:
        """The pieces of a text all of whose characters are pieces."""
        n = len(text)
        starts: list[list[int]] = [[] for _ in range(n)]
        for last, length in self.automaton.iter(text):
            starts[last - length + 1].append(length)  # shorter ones end earlier, so the last is the longest
        failed = 0 if n < 64 else bytearray(n // 8 + 1)
        tokens: list[str] = []
        tries: list[list[int]] = []  # for each token, the lengths left to try
        pairs = self.pairs
        at, left = 0, starts[0]
        while True:
            while left:
                end = at + left.pop()
                if (failed >> end if n < 64 else failed[end >> 3] >> (end & 7)) & 1:
                    continue
                token = text[at:end]
                if not tokens:
                    break
                key = tokens[-1], token
                fits = pairs.get(key)
                if fits is None:
                    if len(pairs) >= PAIRS:
                        pairs.clear()
                    fits = pairs[key] = self._stays(*key)
                if fits:
                    break
            else:
                if not tokens:
                    raise ValueError("no encoding")
                if n < 64:
                    failed |= 1 << at
                else:
                    failed[at >> 3] |= 1 << (at & 7)
                at -= len(tokens.pop())
                left = tries.pop()
                continue
            tokens.append(token)
            if end == n:
                return tokens
            tries.append(left)
            at, left = end, starts[end].copy()

    def _chunk(self, text: str) -> list[int]:
        if self.chars.issuperset(text):
            return [*map(self.id.__getitem__, self._span(text))]
        ids: list[int] = []
        at, n = 0, len(text)
        while at < n:
            end = at
            while end < n and text[end] in self.chars:
                end += 1
            if end > at:
                ids += map(self.id.__getitem__, self._span(text[at:end]))
            while end < n and text[end] not in self.chars:
                if self.byte_ids:
                    ids += (self.byte_ids[b] for b in text[end].encode())
                elif not ids or ids[-1] != self.unknown:
                    ids.append(self.unknown)  # neighbours merge into one
                end += 1
            at = end
        return ids

    def _fetch(self, chunk: str) -> tuple[int, ...]:
        got = self.older.get(chunk)
        if got is None:
            got = tuple(self._chunk(chunk))
        if len(chunk) <= LONGEST:
            if len(self.known) >= self.memory:
                self.older, self.known = self.known, {}
            self.known[chunk] = got
        return got

    def _ids(self, text: str) -> list[int]:
        ids: list[int] = []
        if text:
            text = self.prefix + text.replace(" ", MARK)
            known = self.known.get
            for c in self.chunks.findall(text) if self.cuts else [text]:
                got = known(c)
                if got is None:
                    got = self._fetch(c)
                    known = self.known.get
                ids += got
        return ids

    def forget(self) -> None:
        self.known, self.older = {}, {}
        self.pairs.clear()

    def encode(self, text: str, add_end: bool = False) -> list[int]:
        ids = self._ids(text)
        return [*ids, self.end] if add_end else ids

    def decimals(self, ids: list[int]) -> str:
        """The ids as decimals joined by a space."""
        return " ".join(map(self.digits.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        raw = b"".join(map(self.bytes.__getitem__, ids))
        first = next((i for i in ids if self.bytes[i]), None)  # control ids give nothing
        if self.prefix and first is not None and self.marked[first]:
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:  # each byte that is part of no character becomes U+FFFD
            out, at = [], 0
            while at < len(raw):
                for n in (1, 2, 3, 4):
                    try:
                        out.append(raw[at : at + n].decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    n = 1
                at += n
            return "".join(out)


_loaded: dict[str, SentencePieceCodec] = {}


def codec(model_path: str) -> SentencePieceCodec:
    """The worker's codec for this file."""
    if model_path not in _loaded:
        _loaded[model_path] = SentencePieceCodec(model_path)
    return _loaded[model_path]


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = True, memory: int = MEMORY, forget: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """id, ids (only if asked for), n_tokens, ids_sha256, decoded_sha256 of each row. Nothing is shuffled.

    memory: chunks that a worker remembers in each generation; forget: whether it gives them
    up after each task, for jobs in which other stages follow in the same workers; keep: whole
    numbers of docs, never null, that are passed on. Rows keep their order.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(model_path)
        c.memory = memory
        for batch in batches:
            rows, held, first = [], 0, 0

            def out() -> pd.DataFrame:
                return pd.DataFrame(rows, columns=names).assign(**{k: batch[k].values[first : first + len(rows)] for k in keep})

            for key, text in zip(batch["key"], batch["text"]):
                if held > HELD:
                    yield out()
                    rows, held, first = [], 0, first + len(rows)
                got = c.encode(text, add_end=True)
                held += len(got)
                rows.append((key, *([got] if ids else []), len(got), hashlib.sha256(c.decimals(got).encode()).hexdigest(), hashlib.sha256(c.decode(got).encode()).hexdigest()))
            yield out()
        if forget:
            c.forget()

    names = [id_col, *(["ids"] if ids else []), "n_tokens", "ids_sha256", "decoded_sha256"]
    schema = f"`{id_col}` string, {'ids array<int>, ' if ids else ''}n_tokens long, ids_sha256 string, decoded_sha256 string{''.join(f', `{k}` long' for k in keep)}"
    rows = docs.select(F.col(id_col).cast("string").alias("key"), whole_text(text_col).alias("text"), *keep)  # as a string: pandas has no whole numbers beside nulls
    return rows.mapInPandas(run, schema).withColumn(id_col, F.col(f"`{id_col}`").cast(kind))
