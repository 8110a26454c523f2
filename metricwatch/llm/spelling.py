"""Spelling variant grouping by a trie-node pair dictionary.

Words are counted in Arrow batches and summed. The distinct words, sorted, make a trie whose nodes
are numbered in order; the reversed words make a second one. Every place in a word then is a pair of
integers: the node of the prefix before it and the (reversed) node of the suffix after it. A pair
that skips one code point and a pair that skips none (a place where one could be inserted) go into one dictionary:

* two words with the same skipping pair differ by one replaced code point;
* a word with a plain pair equal to another's skipping pair differs from it by one inserted code point.

Node numbers stand for whole prefixes and suffixes, so the join is exact and needs no check of letters.
An entry holds at most as many words as the alphabet has letters and one plain word, whatever the
data. No pairs of words are emitted: an entry tells each of its words how many near words it adds and
the most frequent of them, and these are summed by word.

Both tries are numbered where the words lie: tasks hold ranges of the sorted words, and a node is new
where a word leaves the path of the word before it. Only the last path of every task goes to the
driver, which tells the next tasks the numbers of the prefixes that reach over their borders.

Defined results: null and empty texts have no words; a missing document id counts as an empty id in
the draw; repeated documents count again; a word has no form if its near words are too rare; of
equally frequent near words the smallest in code-point order is the form.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricwatch.llm.common import checkpoint

LEAST_LENGTH, LEAST_COUNT, TIMES = 7, 2, 10
#: A run in 31 loses one letter (the draw is fixed by document and run).
DRAW = 31
#: Distinct words that a task counts before it puts them out.
COUNTED_AT_ONCE = 200_000
#: Node numbers: task * TASK_NODES + number in the task. Number 0 of task 0 is the root.
TASK_NODES = 1 << 42


def misspelt(run: str, doc_id: str) -> str:
    """The run, without one of its letters if the draw says so."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % DRAW:
        return run
    return run[:h % len(run)] + run[h % len(run) + 1:]


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """(word, n): words of at least ``least_length`` letters that occur at least ``least_count`` times."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                       F.col(text_col).cast("string").cast("binary").alias("text")).where("text is not null")
    runs = re.compile(rf"[a-zÀ-ÿ]{{{least_length},}}").findall  # shorter runs stay shorter

    def batch_of(counted: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counted.keys(), pa.string()), pa.array(counted.values(), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for word, n in Counter(runs(text.as_py().lower().decode())).items():  # bytes.lower is A-Z only
                    word = misspelt(word, doc_id)
                    if len(word) >= least_length:
                        counted[word] += n
                if len(counted) >= COUNTED_AT_ONCE:
                    yield batch_of(counted)
                    counted.clear()
        yield batch_of(counted)

    return (rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least_count))


def shared_start(a: str, b: str) -> int:
    """How many code points two words share at the start."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def paths(words: Iterator[str]) -> Iterator[np.ndarray]:
    """For sorted words the nodes on each one's way, numbered from 1 in the order in which they are made."""
    before, path, made = "", np.zeros(0, np.int64), 0
    for word in words:
        keep = shared_start(before, word)
        new = len(word) - keep
        path = np.concatenate((path[:keep], np.arange(made + 1, made + new + 1)))
        before, made = word, made + new
        yield path


def trie_nodes(words: DataFrame, word: str, out: str) -> DataFrame:
    """``words`` plus ``out``: the trie nodes of the empty prefix, of the first code point, ... of the whole word.

    ``words`` holds distinct words. Equal prefixes have equal numbers, in whatever tasks their words lie.
    """
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # written once: the ranges are drawn by sampling, and both passes must meet the same ones
    lying = checkpoint(words.repartitionByRange(parts, word).sortWithinPartitions(word))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        made: list[str] = []

        def each() -> Iterator[str]:
            nonlocal first, last
            for batch in batches:
                for x in batch.column(0).to_pylist():
                    first, last = first if first is not None else x, x
                    yield x

        path = np.zeros(0, np.int64)
        for path in paths(each()):
            pass
        if first is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([first]), pa.array([last]),
                                              pa.array([path], pa.list_(pa.int64()))], ["task", "first", "last", "path"])

    borders = sorted(lying.select(word).mapInArrow(ends, "task int, first string, last string, path array<bigint>").collect())
    carried: dict[int, np.ndarray] = {}  # of a task whose first word goes on from the last word of the task before: the numbers it shares
    before, path = "", np.zeros(0, np.int64)
    for task, first, last, own in borders:  # a row per task
        carry = carried[task] = path[:shared_start(before, first)]
        before, path = last, numbered(np.array(own, np.int64), carry, task)
    shared = words.sparkSession.sparkContext.broadcast(carried)  # at most a path per task

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        kept: list[pa.RecordBatch] = []

        def each() -> Iterator[str]:
            for batch in batches:
                if batch.num_rows:
                    kept.append(batch)
                    yield from batch.column(at).to_pylist()

        found: list[np.ndarray] = []
        for path in paths(each()):
            found.append(np.concatenate(([0], numbered(path, shared.value[task], task))))
            if len(found) == kept[0].num_rows:
                batch = kept.pop(0)
                flat = pa.array(np.concatenate(found))
                offsets = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in found]))), pa.int32())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, flat)], [*batch.schema.names, out])
                found = []

    at = words.columns.index(word)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in words.schema)
    return lying.mapInArrow(number, f"{kinds}, `{out}` array<bigint>")


def numbered(path: np.ndarray, carry: np.ndarray, task: int) -> np.ndarray:
    """A task's own numbers made unique; its first ones are nodes that earlier tasks have numbered."""
    out = path + task * TASK_NODES
    old = path <= len(carry)
    out[old] = carry[path[old] - 1]
    return out


def pair_dictionary(words: DataFrame) -> DataFrame:
    """words (id, n, word, pre, suf) -> dictionary entries (pre, suf, id, n, skips, leads).

    ``skips``: the pair skips a code point. ``leads``: no equal code point stands before it, so that of
    the ways to take one letter out of a run of equal ones a single way counts.
    """
    size = F.size("pre") - 1
    pre, suf = lambda i: F.get("pre", i), lambda i: F.get("suf", i)
    letter = lambda i: F.substring("word", i + 1, F.lit(1))
    entry = lambda p, s, skips, leads: F.struct(p.alias("pre"), s.alias("suf"), skips.alias("skips"), leads.alias("leads"))
    skipping = F.transform(F.sequence(F.lit(0), size - 1), lambda i: entry(
        pre(i), suf(size - 1 - i), F.lit(True), (i == 0) | (letter(i) != letter(i - 1))))
    plain = F.transform(F.sequence(F.lit(0), size), lambda i: entry(pre(i), suf(size - i), F.lit(False), F.lit(False)))
    return (words.select("id", "n", F.explode(F.concat(skipping, plain)).alias("e"))
            .select("e.pre", "e.suf", "id", "n", "e.skips", "e.leads"))


def near_words(entries: DataFrame) -> DataFrame:
    """(id, n_near, best): how many near words a word has, and the most frequent (n, -id) of them.

    An entry of the dictionary is a bounded group: at most one word per letter of the alphabet, and one plain word.
    """
    groups = (entries.groupBy("pre", "suf").agg(F.collect_list(F.struct("n", (-F.col("id")).alias("minus"), "skips", "leads")).alias("all"))
              .where("size(all) > 1"))
    groups = groups.select(F.filter("all", lambda e: e["skips"]).alias("skipping"), F.filter("all", lambda e: e["skips"] & e["leads"]).alias("leading"),
                           F.get(F.filter("all", lambda e: ~e["skips"]), F.lit(0)).alias("plain"))
    rank = lambda e: F.struct(e["n"].alias("n"), e["minus"].alias("minus"))
    groups = groups.select("*", F.reverse(F.array_sort(F.transform("skipping", rank))).alias("order"),
                           F.array_max(F.transform("leading", rank)).alias("longer"))
    first, second, one = F.get("order", F.lit(0)), F.get("order", F.lit(1)), F.col("plain")

    def of_skipping(e: Column) -> Column:
        replaced = F.when(rank(e) == first, second).otherwise(first)
        shorter = e["leads"] & one.isNotNull()
        return F.struct((-e["minus"]).alias("id"), (F.size("order") - 1 + shorter.cast("int")).alias("found"),
                        F.greatest(replaced, F.when(shorter, rank(one))).alias("best"))

    of_plain = F.struct((-one["minus"]).alias("id"), F.size("leading").alias("found"), F.col("longer").alias("best"))
    told = F.concat(F.transform("skipping", of_skipping), F.when(one.isNotNull(), F.array(of_plain)).otherwise(F.array()))
    each = groups.select(F.explode(told).alias("t")).select("t.id", "t.found", "t.best").where("found > 0")
    return each.groupBy("id").agg(F.sum("found").cast("bigint").alias("n_near"), F.max("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(id, form) -> (id, root): forms followed to the last one, by jumps that double.

    A form is at least ``TIMES`` times as frequent, so ways are as long as the logarithm of the counts.
    """
    now = checkpoint(forms.select("id", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("id").alias("at"), F.col("root").alias("next"))
        moved = now.join(ahead, now["root"] == ahead["at"], "left").select(
            "id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("went"))
        now = checkpoint(moved)
        if now.where("went").isEmpty():
            return now.select("id", "root")
        now = now.select("id", "root")


def spelling_variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, times: int = TIMES,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    ``form`` is the word's most frequent near word (one code point inserted, deleted or replaced) if that is at
    least ``times`` as frequent, ``root`` the last of the forms that follow from it (the word itself if it has none).
    """
    counted = word_counts(docs, least_length, least_count, id_col, text_col)
    # ids in word order, so that the smallest of equally frequent words has the least id
    forward = trie_nodes(counted, "word", "pre").select(F.monotonically_increasing_id().alias("id"), "word", "n", "pre")
    back = trie_nodes(forward.withColumn("back", F.reverse("word")), "back", "suf")
    words = checkpoint(back.select("id", "word", "n", "pre", "suf"))
    near = near_words(pair_dictionary(words))
    near = checkpoint(near.join(words.select("id", "n"), "id").select(
        "id", "n_near", F.when(F.col("best.n") >= times * F.col("n"), -F.col("best.minus")).alias("form"), F.col("best.n").alias("form_n")))
    last = roots(near.where("form is not null"))
    found = near.join(last, "id", "left").select(F.col("id").alias("of"), "n_near", "form", "root", "form_n")
    named = words.select("id", "word", "n").join(found, F.col("id") == F.col("of"), "left")
    names = words.select(F.col("id").alias("at"), F.col("word").alias("name"))
    with_form = named.join(names.withColumnRenamed("name", "form_word"), F.col("form") == F.col("at"), "left").drop("at")
    with_root = with_form.join(names.withColumnRenamed("name", "root_word"), F.col("root") == F.col("at"), "left")
    return with_root.select("word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n",
                            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
                            F.when(F.col("form").isNotNull(), F.col("form_n")).alias("form_n"))
