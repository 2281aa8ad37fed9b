"""Language identification: known words first, then shorter n-grams.

A word is a run of letters, in lower case.  A known word counts with its log
frequency in every language; an unseen word backs off to its character
n-grams, longest first: the first length of which any n-gram is known gives
the word's score, the mean over those n-grams.  A text's scores are summed
over all its words; the prediction is the best language, its score the
posterior under equal priors (0 to 1).

The model is fitted on a bounded sample of the labelled documents (about
``SAMPLE`` of them, chosen by a hash of the id, not by order) and keeps about
``UNITS`` words and as many n-grams, so it can be sent to every task.  Both
bounds are shared out evenly: each language gives up to its share of the
sample and its own most frequent units, so a rare one is learned as well as a
frequent one (with very many languages each still has ``LEAST_SAMPLE`` and
``LEAST_UNITS``, and the bounds grow).  Counting is a Spark aggregation, partial counts first, of words and then
of the n-grams of distinct words; prediction is one pass without a shuffle.

Cases: null text, text without a letter, or a model without languages gives
``und`` and 0; ties go to the language that sorts first; rows without a
language, a text or an id are not learned from; any other column is ignored,
those with the names of results are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.llm.store import saved, small_batches
from runlens.llm.vocab import slices

SAMPLE = 20_000
UNITS = 30_000
LEAST_SAMPLE, LEAST_UNITS = 1_000, 1_000  # of each language
BROADCAST_LANGUAGES = 10_000
LONGEST = 4
UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")
RESULT = ("lang_pred", "score")


def letters(text: str | None) -> list[str]:
    found = WORD.findall(text.lower()) if text else []
    if all(map(str.isalpha, found)):
        return found
    # numerals other than digits (fractions, circled and Roman numbers) are no letters
    return [x for w in found for x in "".join(c if c.isalpha() else " " for c in w).split()]


def grams(word: str, n: int) -> list[str]:
    padded = f"^{word}$" if n > 1 else word
    return [padded[i:i + n] for i in range(len(padded) - n + 1)]


@dataclass
class Model:
    languages: list[str]
    words: dict[str, tuple]
    grams: dict[str, tuple]

    def word_score(self, word: str) -> tuple:
        """Log frequencies by language, less their mean (what tells the
        languages apart); zeros where nothing of the word is known."""
        known = self.words.get(word)
        if known is not None:
            return known
        for n in range(LONGEST, 0, -1):
            found = [g for g in (self.grams.get(x) for x in grams(word, n)) if g is not None]
            if found:
                return tuple(sum(c) / len(found) for c in zip(*found))
        return (0.0,) * len(self.languages)


def _log_table(rows: list, languages: list[str]) -> dict[str, tuple]:
    place = {x: i for i, x in enumerate(languages)}
    counts: dict[str, np.ndarray] = {}
    for unit, lang, n in rows:
        counts.setdefault(unit, np.zeros(len(languages)))[place[lang]] += n
    total = sum(counts.values(), np.zeros(len(languages)))
    out = {}
    for unit, c in counts.items():
        log = np.log((c + 0.5) / (total + 0.5 * len(counts)))
        out[unit] = tuple((log - log.mean()).tolist())
    return out


def _grams(word_col: str) -> Column:
    """All n-grams of a word, as ``grams`` gives them for every length."""
    word = F.col(word_col)
    padded = F.concat(F.lit("^"), word, F.lit("$"))

    def of(text: Column, n: int) -> Column:
        last = F.char_length(text) - (n - 1)
        starts = F.when(last >= 1, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.substring(text, i, n))

    return F.concat(of(word, 1), *(of(padded, n) for n in range(2, LONGEST + 1)))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE,
        units: int = UNITS) -> Model:
    """Model from the labelled documents among ``docs``."""
    small_batches(docs)
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    labelled = labelled.select(F.col(id_col).cast("string").alias("id"), F.col(lang_col).cast("string").alias("lang"),
                               F.col(text_col).alias("text"))
    sizes = saved(labelled.groupBy("lang").agg(F.count("*").alias("of")))
    languages = sizes.count()
    drawn = max(-(-sample // max(1, languages)), min(sample, LEAST_SAMPLE))
    kept = max(-(-units // max(1, languages)), min(units, LEAST_UNITS))
    # the hash against the share of its whole 64-bit range
    limit = F.when(F.col("of") <= drawn, F.lit((1 << 63) - 1)).otherwise(
        ((F.lit(2.0 * drawn) / F.col("of") - 1.0) * F.lit(2.0 ** 63)).cast("long"))
    sizes = sizes.select("lang", limit.alias("limit"))
    if languages <= BROADCAST_LANGUAGES:
        sizes = F.broadcast(sizes)
    chosen = labelled.join(sizes, "lang").where(F.xxhash64("id") <= F.col("limit")).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words: dict[str, Counter] = {}
            for part in slices(batch):
                for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                    words.setdefault(lang, Counter()).update(letters(text))
            rows = [(word, lang, k) for lang, count in words.items() for word, k in count.items()]
            cols = list(zip(*rows)) or [[]] * 3
            yield pa.record_batch({"unit": pa.array(cols[0], pa.string()), "lang": pa.array(cols[1], pa.string()),
                                   "n": pa.array(cols[2], pa.int64())})

    # texts are read once; n-grams are counted from the distinct words
    words = saved(chosen.mapInArrow(run, "unit string, lang string, n long").groupBy("unit", "lang").agg(F.sum("n").alias("n")))
    pieces = words.select(F.explode(_grams("unit")).alias("unit"), "lang", "n").groupBy("unit", "lang").agg(F.sum("n").alias("n"))
    tables = []
    for counted in (words, pieces):
        rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "unit"))
        best = counted.withColumn("rank", rank).where(F.col("rank") <= kept).select("unit").distinct()
        tables.append([(r.unit, r.lang, r.n) for r in counted.join(best, "unit").orderBy("unit", "lang").collect()])
    languages = sorted({lang for t in tables for _, lang, _ in t})
    return Model(languages, _log_table(tables[0], languages), _log_table(tables[1], languages))


class _Known(dict):
    """Words met so far and the place of their scores."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = place = len(self)
        self.fresh.append(word)
        return place


def predict(docs: DataFrame, model: Model, text_col: str = "text", remember: int = 150_000) -> DataFrame:
    """Input columns plus ``lang_pred`` and ``score``."""
    small_batches(docs)
    docs = docs.drop(*RESULT)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, table = _Known(), np.zeros((0, len(model.languages)))
        for batch in batches:
            said: list[str] = []
            score: list[float] = []
            for part in slices(batch):
                parts = [letters(t) for t in part.column(text_col).to_pylist()]
                count = np.array([len(p) for p in parts], dtype=np.int64)
                langs, values = [UNKNOWN] * len(parts), [0.0] * len(parts)
                if model.languages and count.sum():
                    if len(known) > remember:
                        known, table = _Known(), table[:0]
                    at = np.fromiter(map(known.__getitem__, chain.from_iterable(parts)), np.int64, int(count.sum()))
                    fresh, known.fresh = known.fresh, []
                    table = np.concatenate([table, np.array([model.word_score(w) for w in fresh]).reshape(-1, table.shape[1])])
                    some = np.flatnonzero(count)
                    sums = np.add.reduceat(table[at], (np.cumsum(count) - count)[some], axis=0)
                    share = np.exp(sums - sums.max(axis=1, keepdims=True))
                    share /= share.sum(axis=1, keepdims=True)
                    for i, k, s in zip(some.tolist(), share.argmax(axis=1).tolist(), share.max(axis=1).tolist()):
                        langs[i], values[i] = model.languages[k], s
                said += langs
                score += values
            yield pa.record_batch({**{c: batch.column(c) for c in names}, "lang_pred": pa.array(said, pa.string()),
                                   "score": pa.array(score, pa.float64())})

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{ddl}, lang_pred string, score double")
