"""Language identification by rank-order n-gram profiles.

Training counts character n-grams (lengths 1 to 3, letters in lower case, words padded by one
boundary) of every labelled text, in Arrow batches and then by one aggregation; a language's
profile is its most frequent n-grams in order. A text is given to the language whose profile has
the least out-of-place distance to the text's own most frequent n-grams: the sum of rank
differences, an n-gram that a profile lacks counting as the profile's length.

Defined results: a text that is null or has no letter is ``und`` with score 0, as is every text
if nothing was learned; ties go to the language that sorts first; n-grams of equal count are
ranked by their code points; whole texts are counted, in chunks of bounded memory when learning.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: N-grams in a profile.
PROFILE = 300
_BITS = 21
_lower: list[np.ndarray] = []


def _lower_letters() -> np.ndarray:
    """Code point -> that of its lower-case letter, or 0 if it is no letter (once per process)."""
    if not _lower:
        table = np.zeros(sys.maxunicode + 1, np.int64)
        for cp in range(sys.maxunicode + 1):
            c = chr(cp)
            if c.isalpha():
                low = c.lower()
                table[cp] = ord(low) if len(low) == 1 else cp
        _lower.append(table)
    return _lower[0]


def grams(text: str) -> np.ndarray:
    """All n-grams of a text as numbers (three 21-bit code points, 0 as boundary); empty without a letter."""
    cps = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = np.zeros(len(cps) + 2, np.int64)
    letters[1:-1] = _lower_letters()[cps]
    inner = letters != 0
    keep = inner.copy()
    keep[:-1] |= inner[1:]  # one boundary before a word; the next word's is also this one's end
    s = np.append(letters[keep], 0)
    if len(s) < 3:
        return np.empty(0, np.int64)
    one = s[s != 0]
    two = (s[:-1] << _BITS) | s[1:]
    two = two[(s[:-1] != 0) | (s[1:] != 0)] | (1 << 62)
    mid = s[1:-1] != 0
    three = ((s[:-2] << 2 * _BITS) | (s[1:-1] << _BITS) | s[2:])[mid] | (-1 << 63)
    return np.concatenate((one, two, three))


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values = np.sort(values)
    at = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return values[at], np.diff(np.append(at, len(values)))


def ranked(values: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The ``size`` most frequent n-grams, most frequent first, equal counts by value."""
    found, counts = _counted(values)
    if len(found) > size:  # all that could be among the first, ties included
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        found, counts = found[counts >= least], counts[counts >= least]
    return found[np.lexsort((found, -counts))][:size]


def learn(docs: DataFrame, size: int = PROFILE, lang_col: str = "lang", text_col: str = "text",
          chunk_chars: int = 1 << 20) -> dict[str, np.ndarray]:
    """Profiles of all languages with a text, from every row with a language.

    Counts are made in Spark; only the profiles come to the driver: ``size`` n-grams a language.
    """
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[str, list[np.ndarray]] = {}
            sizes: dict[str, int] = {}

            def counts(lang: str) -> pa.RecordBatch:
                values, n = _counted(np.concatenate(held.pop(lang)))
                sizes.pop(lang)
                return pa.RecordBatch.from_arrays([pa.array([lang] * len(values)), pa.array(values), pa.array(n.astype(np.int64))],
                                                  ["lang", "gram", "n"])

            for lang, text in zip(batch.column(0), batch.column(1)):
                lang, text = lang.as_py(), text.as_py()
                found = grams(text)
                if len(found):
                    held.setdefault(lang, []).append(found)
                    sizes[lang] = sizes.get(lang, 0) + len(found)
                    if sizes[lang] > chunk_chars:
                        yield counts(lang)
            for lang in list(held):
                yield counts(lang)

    total = rows.mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = W.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = total.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
    found: dict[str, list[tuple[int, int]]] = {}
    for lang, gram, rank in best.select("lang", "gram", "rank").collect():
        found.setdefault(lang, []).append((rank, gram))
    return {lang: np.array([g for _, g in sorted(pairs)], np.int64) for lang, pairs in found.items()}


class Profiles:
    """Profiles laid out for one lookup per text."""

    def __init__(self, profiles: dict[str, np.ndarray], size: int = PROFILE) -> None:
        self.langs, self.size = sorted(profiles), size
        self.known = np.unique(np.concatenate([profiles[x] for x in self.langs])) if profiles else np.empty(0, np.int64)
        self.rank = np.full((len(self.langs), len(self.known) + 1), -1, np.int64)
        for k, lang in enumerate(self.langs):
            self.rank[k, np.searchsorted(self.known, profiles[lang])] = np.arange(len(profiles[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score: 1 for no rank out of place, 0 for no common n-gram."""
        values = grams(text) if text else ()
        if not len(values) or not self.langs:
            return "und", 0.0
        own = ranked(values, self.size)
        at = np.minimum(np.searchsorted(self.known, own), len(self.known) - 1)
        at = np.where(self.known[at] == own, at, len(self.known))
        ranks = self.rank[:, at]
        away = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(own)))).sum(axis=1)
        best = int(away.argmin())
        return self.langs[best], float(1 - away[best] / (self.size * len(own)))


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], size: int = PROFILE, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) for every row of ``docs``; only the text is looked at."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(profiles)  # size n-grams a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Profiles(shared.value, size)
        for batch in batches:
            said = [model.predict(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([a for a, _ in said], pa.string()),
                                              pa.array([b for _, b in said], pa.float64())], ["id", "lang_pred", "score"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, lang_pred string, score double")
