"""Ranked lexical search: one Aho-Corasick automaton of all items' terms scans every document.

No index of the documents is built. The distinct terms of a block of items become the patterns of an
automaton, each guarded by a boundary on both sides; one scan of a text finds how often every term
stands in it. The scan works on the UTF-8 bytes: all characters that end a term are ASCII, so one
byte table lower-cases A-Z and turns every other ASCII character into the boundary, and a guarded
pattern then matches whole terms only. Per document the scan leaves its length and (term, count)
pairs; document frequencies, the number of documents and their total length are summed from these.
A second pass turns counts into scores in Arrow batches: the automaton's outputs map to items
through a term -> items table, and each task keeps the best ``top`` documents of an item.

The items are the query set. Their terms are taken in blocks of at most ``MAX_TERMS`` distinct terms
(an item with more is a block of its own), so what is broadcast is bounded, whatever the number of
items; every block scans all documents.

Defined results: null and empty texts have no terms and are not documents of the statistics; items
without a term get no rows; repeated documents and repeated items are rows of their own; of equal
scores the smaller id ranks first, a missing id last; empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from metricwatch.llm.common import checkpoint

#: Distinct terms of one automaton (some 100 MB in a worker at ten letters a term).
MAX_TERMS = 200_000
#: Scores held, and (document, term, item) entries summed, at once.
CELLS, ENTRIES = 1 << 20, 1 << 21
ROWS_AT_ONCE = 512
#: A-Z to a-z; other ASCII characters than letters and digits to a blank; all other bytes stay.
FOLD = bytes(ord(chr(b).lower()) if chr(b).isalnum() and b < 128 else b if b > 127 else 32 for b in range(256))

#: The words and the automaton that this worker built last.
_held: list = [None, None]


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8: maximal runs of ASCII letters, digits and all characters from U+0080 on."""
    return text.translate(FOLD).split()


def automaton(words: list[bytes]) -> ahocorasick.Automaton:
    """Patterns `` word `` (a blank on both sides) with the word's number; bytes are read as Latin-1 characters."""
    out = ahocorasick.Automaton()
    for k, word in enumerate(words):
        out.add_word(f" {word.decode('latin-1')} ", k)
    out.make_automaton()
    return out


def counts(scan: ahocorasick.Automaton, text: bytes) -> tuple[int, Counter]:
    """Number of terms of a text, and how often each pattern's word is one of them."""
    folded = text.translate(FOLD)
    found = Counter([k for _, k in scan.iter(f" {folded.decode('latin-1')} ")])
    return len(folded.split()), found


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    """floor(1000 * ln((2N + 2) / (2 df + 1))) of every document frequency."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)


def scan_documents(docs: DataFrame, words: Broadcast, id_col: str, text_col: str) -> DataFrame:
    """(id, n, term, tf): a row per document with at least one term; term and tf are arrays in step."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text")).where("text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = None
        for whole in batches:
            if scan is None:
                if _held[0] is not words.value:  # one automaton a worker
                    _held[:] = words.value, automaton(words.value)
                scan = _held[1]
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                keep, n, term, tf = [], [], [], []
                for k, text in enumerate(batch.column(1)):
                    size, found = counts(scan, text.as_py())
                    if size:
                        keep.append(k)
                        n.append(size)
                        term.append(list(found.keys()))
                        tf.append(list(found.values()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(keep, pa.int32())), pa.array(n, pa.int64()),
                     pa.array(term, pa.list_(pa.int32())), pa.array(tf, pa.list_(pa.int32()))], ["id", "n", "term", "tf"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n bigint, term array<int>, tf array<int>")


def document_frequencies(scans: DataFrame, n_terms: int) -> np.ndarray:
    """How many documents hold each term: summed in every task first, then over tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=n_terms)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held])], ["term", "n"])

    each = scans.select("term").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    out = np.zeros(n_terms, np.int64)
    for row in each.toLocalIterator():  # at most one row per term of the block
        out[row[0]] = row[1]
    return out


class Postings:
    """term -> items of a block, as flat arrays."""

    def __init__(self, items: list[list[int]], n_terms: int) -> None:
        pairs = sorted((t, k) for k, of in enumerate(items) for t in of)
        self.item = np.array([k for _, k in pairs], np.int64)
        self.start = np.searchsorted(np.array([t for t, _ in pairs], np.int64), np.arange(n_terms + 1))
        self.items = len(items)

    def scores(self, doc: np.ndarray, term: np.ndarray, worth: np.ndarray, n_docs: int) -> np.ndarray:
        """Exact sums of ``worth`` for every document and item, from (document, term, worth) entries."""
        size = self.start[term + 1] - self.start[term]
        first = np.repeat(self.start[term] - np.concatenate(([0], np.cumsum(size)[:-1])), size)
        cell = np.repeat(doc, size) * self.items + self.item[first + np.arange(len(first))]
        out = np.zeros(n_docs * self.items, np.int64)
        np.add.at(out, cell, np.repeat(worth, size))
        return out.reshape(n_docs, self.items)


def best_documents(scans: DataFrame, shared: Broadcast, n_docs: int, total: int, top: int) -> DataFrame:
    """(item, id, score): of every task the ``top`` best documents of each item of the block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        postings, weight = shared.value
        rows = max(1, min(CELLS // postings.items, ENTRIES // len(postings.item)))
        best: list[list] = [[] for _ in range(postings.items)]
        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                batch = whole.slice(at, rows)
                ids, lists, tf = batch.column(0).to_pylist(), batch.column(2), batch.column(3).flatten().to_numpy(zero_copy_only=False)
                size = np.diff(lists.offsets.to_numpy()[:len(ids) + 1])
                doc, term = np.repeat(np.arange(len(ids)), size), lists.flatten().to_numpy(zero_copy_only=False)
                m = np.array([10 + 90 * n * n_docs // total for n in batch.column(1).to_pylist()], np.int64)
                worth = weight[term] * (1_000_000_000 * tf.astype(np.int64) // (1000 * tf.astype(np.int64) + 8 * m[doc]))
                score = postings.scores(doc, term.astype(np.int64), worth, len(ids))
                floor = np.array([b[-1][0] if len(b) == top else 1 for b in best])
                for d, k in zip(*np.nonzero(score >= floor)):
                    held = best[k]
                    held.append((int(score[d, k]), ids[d]))
                    if len(held) >= 8 * top:
                        best[k] = leading(held, top)
                best = [leading(b, top) for b in best]
        flat = [(k, i, s) for k, b in enumerate(best) for s, i in b]
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in flat], pa.int32()), pa.array([x[1] for x in flat], id_type),
                                          pa.array([x[2] for x in flat], pa.int64())], ["item", "id", "score"])

    kind = scans.schema["id"].dataType
    id_type = to_arrow_type(kind)
    return scans.select("id", "n", "term", "tf").mapInArrow(run, f"item int, id {kind.simpleString()}, score bigint")


def leading(held: list[tuple], top: int) -> list[tuple]:
    """The ``top`` best (score, id), highest first, of equal scores the smaller id, a missing id last."""
    return sorted(held, key=lambda x: (-x[0], x[1] is None, x[1] if x[1] is not None else 0))[:top]


def _blocks(items: DataFrame, item_col: str, text_col: str, max_terms: int) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Items with terms, in blocks: (item ids, their distinct terms)."""
    rows = items.select(F.col(item_col), F.col(text_col).cast("string").cast("binary")).where(F.col(text_col).isNotNull())
    ids, lists, held = [], [], set()
    for row in rows.toLocalIterator():
        found = sorted(set(terms(bytes(row[1]))))
        if ids and len(held) + sum(t not in held for t in found) > max_terms:
            yield ids, lists
            ids, lists, held = [], [], set()
        if found:
            ids.append(row[0])
            lists.append(found)
            held.update(found)
    if ids:
        yield ids, lists


def _search_block(docs: DataFrame, ids: list, lists: list[list[bytes]], items: DataFrame, top: int, item_col: str,
                  id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    words = sorted({t for found in lists for t in found})
    number = {t: k for k, t in enumerate(words)}
    scans = checkpoint(scan_documents(docs, spark.sparkContext.broadcast(words), id_col, text_col))
    n_docs, total = scans.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).head()
    weight = weights(document_frequencies(scans, len(words)), n_docs)
    postings = Postings([[number[t] for t in found] for found in lists], len(words))
    found = best_documents(scans, spark.sparkContext.broadcast((postings, weight)), n_docs, max(total, 1), top)
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    # a task's best first, then of some tasks, then of all: no task gets more than a bounded part of an item's rows
    part = F.pmod(F.xxhash64("id", "score"), F.lit(64))
    some = found.withColumn("part", part).withColumn("at", F.row_number().over(W.partitionBy("item", "part").orderBy(*order)))
    last = some.where(F.col("at") <= top).withColumn("rank", F.row_number().over(W.partitionBy("item").orderBy(*order)))
    kinds = f"item int, {item_col} {items.schema[item_col].dataType.simpleString()}"
    named = spark.createDataFrame(list(enumerate(ids)), kinds)  # at most an item per term of the block
    return checkpoint(last.where(F.col("rank") <= top).join(F.broadcast(named), "item")
                      .select(item_col, "rank", F.col("id").alias(id_col), "score"))


def ranked_documents(docs: DataFrame, items: DataFrame, top: int = 10, item_col: str = "item_id", id_col: str = "doc_id",
                     text_col: str = "text", item_text: str = "text", max_terms: int = MAX_TERMS) -> DataFrame:
    """For every item its ``top`` documents with a score above 0: item id, rank (from 1), document id, score.

    A term's weight is w = floor(1000 ln((2N + 2) / (2 df + 1))); a document of n terms has
    m = 10 + (90 n N) div L; its score sums w * ((10^9 tf) div (1000 tf + 8 m)) over the item's distinct terms.
    """
    parts = [_search_block(docs, ids, lists, items, top, item_col, id_col, text_col)
             for ids, lists in _blocks(items, item_col, item_text, max_terms)]
    if parts:
        return reduce(DataFrame.unionByName, parts)
    kind = lambda df, c: f"{c} {df.schema[c].dataType.simpleString()}"
    return docs.sparkSession.createDataFrame([], f"{kind(items, item_col)}, rank int, {kind(docs, id_col)}, score bigint")
