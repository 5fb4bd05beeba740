"""Language identification: known words first, then ever shorter character n-grams.

Training counts, per language, whole words and the n-grams (4 down to 1 characters, word
ends marked) of about TRAIN_DOCS labelled documents a language: those whose hashed id is
below a bound that the language's row count gives. Counts and bounds are a row per language, which is
broadcast behind a check of their number, so of the labelled texts only the sample moves. The
most frequent WORDS words and GRAMS n-grams of each length are kept per language.

A known word scores its log frequency in each language. An unseen word scores, at each
place, the longest known n-gram that starts there, and counts as the mean over its
places. The language with the highest sum wins (ties: the first by name); the score is its share
when the sums are turned into probabilities.

The model keeps, for each word and n-gram, only the languages that have it; the others share
a floor per language. More than MAX_ENTRIES of these, or more than MAX_LANGUAGES languages, are an error
and not cut: use smaller vocabularies or a cleaner label column.

Rows with crc32(id as text) mod 3 = 1 are held out: nothing is learned from them.

Edge cases: a null text or one without letters gives "und" with score 0, and so does
every text if there is nothing to learn from. A null id is neither learned from nor held
out. A null language is not learned from. Texts in unknown scripts get some learned
language with a low score. Repeated rows count each. Other columns are ignored. No rows give no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ._shared import column, materialise, quoted

TRAIN_DOCS = 1000
WORDS, GRAMS, LENGTHS = 30_000, 10_000, (4, 3, 2, 1)
ALPHA = 0.5
#: Most languages, and most (language, word or n-gram) entries, of a model.
MAX_LANGUAGES, MAX_ENTRIES = 1000, 3_000_000
#: Scores of unseen words that a worker remembers, over all languages: 16 MB.
MEMORY = 2_000_000

_WORD = re.compile(r"[^\W\d_]+")


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(column(id_col).cast("string")) % 3 == 1, F.lit(False))


def _grams(word: str, n: int) -> list[str]:
    marked = f"_{word}_"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        words: Counter = Counter()
        for lang, text in zip(batch["lang"], batch["text"]):
            words.update((lang, w) for w in _WORD.findall(text.lower()))
        all_counts = {(lang, 0, w): c for (lang, w), c in words.items()}
        for (lang, w), c in words.items():
            for n in LENGTHS:
                for g in _grams(w, n):
                    all_counts[lang, n, g] = all_counts.get((lang, n, g), 0) + c
        yield pd.DataFrame([(*k, c) for k, c in all_counts.items()], columns=["lang", "n", "gram", "c"])


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", train_docs: int = TRAIN_DOCS, words: int = WORDS, grams: int = GRAMS) -> DataFrame:
    """(lang, n, gram, c, total): n is 0 for words; total is the sum of c over all of that n, kept or not."""
    rows = docs.select(column(lang_col).cast("string").alias("lang"), column(text_col).cast("string").alias("text"), column(id_col).alias("_id"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("_id").isNotNull() & ~held_out("_id"))
    bound = materialise(rows.groupBy("lang").count().select("lang", (F.lit(train_docs) / F.col("count")).alias("_share")), "bounds")  # a row per language
    if (n := bound.count()) > MAX_LANGUAGES:
        raise ValueError(f"{n} languages, at most {MAX_LANGUAGES} are supported")
    sample = rows.join(F.broadcast(bound), "lang").where((F.xxhash64("_id").cast("double") / 2.0**64 + 0.5) < F.col("_share")).select("lang", "text")
    counts = sample.mapInPandas(_count, "lang string, n int, gram string, c long").groupBy("lang", "n", "gram").agg(F.sum("c").alias("c"))
    by = Window.partitionBy("lang", "n")  # of the sample, which has a bound
    ranked = counts.withColumn("total", F.sum("c").over(by)).withColumn("_r", F.row_number().over(by.orderBy(F.desc("c"), "gram")))
    return ranked.where(F.col("_r") <= F.when(F.col("n") == 0, words).otherwise(grams)).drop("_r")


class LanguageModel:
    """Scores texts; rows are those of learn()."""

    def __init__(self, rows: list[tuple]):
        self.langs = sorted({r[0] for r in rows})
        number = {lang: i for i, lang in enumerate(self.langs)}
        width, classes = max(len(self.langs), 1), (0, *LENGTHS)
        total = np.zeros((len(classes), width))
        entries: dict[tuple[int, str], list[tuple[int, int]]] = {}
        for lang, n, gram, c, t in rows:
            total[classes.index(n), number[lang]] = t
            entries.setdefault((classes.index(n), gram), []).append((number[lang], c))
        keys = sorted(entries)
        self.words = {g: i for i, (k, g) in enumerate(keys) if k == 0}
        self.grams = {g: i for i, (k, g) in enumerate(keys) if k}  # of all lengths
        self.kind = np.array([k for k, _ in keys], np.int64)
        sizes = np.bincount(self.kind, minlength=len(classes))
        self.floor = np.log(ALPHA) - np.log(total + ALPHA * (sizes[:, None] + 1))  # of a language that has not got it
        self.first = np.cumsum([0, *(len(entries[k]) for k in keys)])
        self.lang = np.array([i for k in keys for i, _ in entries[k]], np.int64)
        self.above = np.log(np.array([c for k in keys for _, c in entries[k]]) + ALPHA) - np.log(ALPHA)
        self.rows = max(MEMORY // width, 5000)
        # Made by the worker, not sent: words and, numbered on from the entries, unseen words with their scores.
        self.index: dict[str, int] = {}
        self.unseen, self.memory = 0, None

    def _sums(self, ids: np.ndarray, owner: np.ndarray, owners: int) -> np.ndarray:
        """For each owner, the sum of its entries' log frequencies by language."""
        n, width, kinds = self.first[ids + 1] - self.first[ids], len(self.langs), len(self.floor)
        at = np.repeat(self.first[ids] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        above = np.bincount(np.repeat(owner, n) * width + self.lang[at], self.above[at], owners * width)
        return above.reshape(owners, width) + np.bincount(owner * kinds + self.kind[ids], minlength=owners * kinds).reshape(owners, kinds) @ self.floor

    def _remember(self, words: list[str]) -> None:
        """Scores unseen words: the mean, over the places of a word, of the longest known n-gram there; nothing where none is known."""
        get, ids, owner = self.grams.get, [], []
        for k, word in enumerate(words):
            marked = f"_{word}_"
            for i in range(len(word) + 1):
                for n in LENGTHS:
                    got = get(marked[i : i + n]) if i + n <= len(marked) else None
                    if got is not None:
                        ids.append(got)
                        owner.append(k)
                        break
        places = np.array([len(w) + 1 for w in words])[:, None]
        first = self.unseen
        self.memory[first : first + len(words)] = self._sums(np.array(ids, np.int64), np.array(owner, np.int64), len(words)) / places
        self.index.update(zip(words, range(len(self.kind) + first, len(self.kind) + first + len(words))))
        self.unseen += len(words)

    def predict(self, text: str | None) -> tuple[str, float]:
        words = _WORD.findall(text.lower()) if text and self.langs else []
        if not any(c.isalpha() for w in words for c in w):
            return "und", 0.0
        if self.memory is None:
            self.index, self.memory = dict(self.words), np.zeros((self.rows, len(self.langs)))
        sums = np.zeros(len(self.langs))
        for k in range(0, len(words), 4096):
            block = words[k : k + 4096]
            if self.unseen + len(block) > self.rows:
                self.index, self.unseen = dict(self.words), 0
            at = [*map(self.index.get, block)]
            if None in at:
                self._remember([*dict.fromkeys(w for w, i in zip(block, at) if i is None)])
                at = [*map(self.index.get, block)]
            ids = np.array(at, np.int64)
            old = ids < len(self.kind)
            known = ids[old]
            sums += self._sums(known, np.zeros(len(known), np.int64), 1)[0]
            if len(known) < len(ids):
                sums += self.memory[ids[~old] - len(self.kind)].sum(0)
        best = int(sums.argmax())
        return self.langs[best], float(1 / math.fsum(math.exp(max(s - sums[best], -700)) for s in sums.tolist()))


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, lang_pred and score of each row; only the text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # MAX_ENTRIES entries at most
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = [shared.value.predict(t) for t in batch["text"]]
            out = pd.DataFrame(got, columns=["lang_pred", "score"])
            out[id_col], out["held_out"] = batch["key"].values, batch["out"].values
            yield out[[id_col, "held_out", "lang_pred", "score"]]

    rows = docs.select(column(id_col).cast("string").alias("key"), held_out(id_col).alias("out"), column(text_col).cast("string").alias("text"))
    return rows.mapInPandas(run, f"{quoted(id_col)} string, held_out boolean, lang_pred string, score double").withColumn(id_col, column(id_col).cast(kind))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **how) -> DataFrame:
    """Learns from docs (how: see learn) and predicts all of docs."""
    rows = materialise(learn(docs, id_col, text_col, lang_col, **how), "languages")
    if (n := rows.count()) > MAX_ENTRIES:
        raise ValueError(f"{n} words and n-grams of all languages, at most {MAX_ENTRIES} are supported")
    return predict(docs, LanguageModel([tuple(r) for r in rows.collect()]), id_col, text_col)
