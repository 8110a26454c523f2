"""Best-fit packing of documents into token sequences.

Documents are tokenized in Arrow batches, cut where they are longer than a sequence, and placed by
best-fit decreasing. Lengths are whole numbers up to the capacity, so documents of one length are
interchangeable and the order of the method depends on the histogram of lengths alone (at most one
row per possible length, whatever the corpus). ``best_fit_plan`` runs the method over that
histogram: a segment tree over remaining capacities finds the tightest open bin for the longest
documents left, and equal documents take equal bins in one step. Its steps ("these ranks of this
length go into these bins at this offset") are a bounded table; each piece finds its own place from
its rank among pieces of its length, counted in two phases so that a common length is no hot key.

Defined results: null and empty texts are one piece with the end id only; repeated rows are
documents of their own; ties between equal lengths go by id, piece and digest.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from metricwatch.llm.common import checkpoint

#: Distinct words whose ids a Python worker remembers, in each of two generations (about 200 bytes each).
REMEMBERED_WORDS = 500_000
_blanks = re.compile("[ \t\n\r]+").split
#: Characters at which str.split cuts, or might cut, though the tokenizer does not.
_odd_blank = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]").search
#: A run of Latin-1 letters (all of them composed, each with a lower case of one letter) and then stops or commas.
_plain = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]*)").fullmatch
_workers: dict[str, "WordTokenizer"] = {}
# The rules of the public word vocabulary, under which a text's ids are its words' ids in order.
WORD_RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
    "post_processor": None, "truncation": None, "padding": None}
WORD_MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>",
              "fuse_unk": False, "byte_fallback": False, "ignore_merges": False}


def _byte_letters() -> list[str]:
    """The character that byte-level BPE writes for each byte: itself where printable, else one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return [chr(b) if b in printable else chr(256 + others.index(b)) for b in range(256)]


def has_word_rules(spec: dict) -> bool:
    """Whether a tokenizer file has the rules of the public word vocabulary: every rule, and no added token with a blank or of plain words."""
    added = [t["content"] for t in spec["added_tokens"]]
    return (all(spec[k] == v for k, v in WORD_RULES.items()) and all(spec["model"].get(k) == v for k, v in WORD_MODEL.items())
            and not any(_plain(t) or t.split() != [t] or not t.startswith("<|") for t in added))


class WordTokenizer(dict):
    """Ids of texts, word by word where the tokenizer file has the rules of the public word vocabulary: word -> its ids as bytes.

    Exact: such a tokenizer drops white space and cuts there, so a text's ids are its words' ids in
    order. A word is encoded when it is first met and remembered, in two generations so that the
    memory is bounded and frequent words stay. Plain words skip the normalizer: their lower-case
    letters go straight to the tokenizer's own BPE model, as its rules would pass them on. With a file of
    any other rules every text is encoded whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.encoder = Tokenizer.from_file(path)
        self.letters, self.old, self.tails = _byte_letters(), {}, {"": b""}
        with open(path, encoding="utf-8") as file:
            self.by_words = has_word_rules(json.load(file))

    @classmethod
    def of(cls, path: str) -> "WordTokenizer":
        """One per worker process and file."""
        if path not in _workers:
            _workers[path] = cls(path)
        return _workers[path]

    def _ids(self, text: str) -> bytes:
        return np.array(self.encoder.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _plain_ids(self, word: str) -> bytes | None:
        parts = _plain(word)
        if not parts:
            return None
        head, tail = parts[1].lower(), parts[2]
        if not head.isascii():
            head = "".join(map(self.letters.__getitem__, head.encode()))
        if tail not in self.tails:
            self.tails[tail] = self._ids(tail)
        return b"".join([t.id.to_bytes(4, "little") for t in self.encoder.model.tokenize(head)]) + self.tails[tail]

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self._plain_ids(word) or self._ids(word)
        if len(self) >= REMEMBERED_WORDS:
            self.old = dict(self)
            self.clear()
            self.tails = {"": b""}
        self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a text."""
        if not self.by_words:
            return self._ids(text)
        return b"".join(map(self.__getitem__, _blanks(text) if _odd_blank(text) else text.split()))


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0,
                 id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32 and, if asked for, the ids themselves.

    A document is its ids and then ``end_id``; only documents longer than ``capacity`` are cut.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = WordTokenizer.of(tokenizer_path)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                row, piece, start, length, crc, ids = [], [], [], [], [], []
                for k, text in enumerate(batch.column(1)):
                    data = tok.encode(text.as_py()) + end
                    for n, first in enumerate(range(0, len(data), 4 * capacity)):
                        part = data[first:first + 4 * capacity]
                        row.append(k)
                        piece.append(n)
                        start.append(first // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        if with_ids:
                            ids.append(np.frombuffer(part, "<u4").astype(np.int32))
                cols = [batch.column(0).take(pa.array(row, pa.int32())), pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
                           + ", ids array<int>" * with_ids)


class CapacityTree:
    """Segment tree over remaining capacities 0..capacity; a leaf counts the open bins that have it."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, remaining: int, bins: int) -> None:
        at = remaining + self.size
        while at:
            self.count[at] += bins
            at >>= 1

    def tightest(self, need: int) -> int | None:
        """The least remaining capacity of at least ``need`` that an open bin has."""
        at = need + self.size
        if self.count[at]:
            return need
        while at > 1:  # the first subtree to the right with an open bin
            if not at & 1 and self.count[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.count[2 * at] else 2 * at + 1
                return at - self.size
            at >>= 1
        return None


def best_fit_plan(histogram: dict[int, int], capacity: int) -> np.ndarray:
    """Steps of best-fit decreasing: rows (length, first rank, first bin, documents a bin, offset in the bin).

    Documents of one length are equal, so the tightest bin takes as many of them as fit before the
    next bin is asked, and all bins with that remaining capacity are dealt with in one step.
    """
    tree, runs, steps, bins = CapacityTree(capacity), {}, [], 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room = capacity
                new = -(-left // (capacity // length))
                runs.setdefault(room, []).append((bins, new))
                tree.add(room, new)
                bins += new
            first, open_bins = runs[room].pop()
            each = room // length
            used = min(open_bins, left // each)
            if not used:  # the last bin gets fewer documents than fit
                used, each = 1, left
            steps.append((length, rank, first, each, capacity - room))
            tree.add(room, -used)
            if used < open_bins:
                runs[room].append((first + used, open_bins - used))
            tree.add(room - each * length, used)
            runs.setdefault(room - each * length, []).append((first, used))
            rank += used * each
            left -= used * each
    return np.array(steps, np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int = 2048, length_col: str = "length", order: tuple[str, ...] = ("id", "piece", "start", "ids_crc32"),
         rows_per_block: int = 1_000_000) -> DataFrame:
    """``pieces`` plus sequence_id and offset; every piece is at most ``capacity`` long.

    ``pieces`` should be a checkpointed or stored table, as it is read twice.
    """
    spark = pieces.sparkSession
    # bounded by the number of possible lengths, 1..capacity
    histogram = {r[0]: r[1] for r in pieces.groupBy(length_col).count().collect()}
    steps = best_fit_plan(histogram, capacity)
    steps = steps[np.lexsort((steps[:, 1], steps[:, 0]))]
    keys = (steps[:, 0] << 44) | steps[:, 1]
    blocks = max(64, -(-sum(histogram.values()) // rows_per_block))
    block = F.pmod(F.xxhash64(*order), F.lit(blocks))
    rows = pieces.withColumn("pack_block", block)
    counts = rows.groupBy(length_col, "pack_block").agg(F.count("*").alias("pack_n"))
    before = counts.select(length_col, "pack_block", (F.sum("pack_n").over(
        W.partitionBy(length_col).orderBy("pack_block").rowsBetween(W.unboundedPreceding, 0)) - F.col("pack_n")).alias("pack_before"))
    within = F.row_number().over(W.partitionBy(length_col, "pack_block").orderBy(*order))
    ranked = (rows.withColumn("pack_rank", within).join(before, [length_col, "pack_block"])
              .withColumn("pack_rank", F.col("pack_before") + F.col("pack_rank") - 1))
    plan = spark.sparkContext.broadcast((keys, steps))  # a bounded table, see best_fit_plan

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, steps = plan.value
        for batch in batches:
            length = batch.column("pack_length").to_numpy(zero_copy_only=False)
            rank = batch.column("pack_rank").to_numpy(zero_copy_only=False)
            step = steps[np.searchsorted(keys, (length << 44) | rank, side="right") - 1]
            nth = rank - step[:, 1]
            keep = batch.schema.names[:-2]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(step[:, 2] + nth // step[:, 3]),
                 pa.array(step[:, 4] + nth % step[:, 3] * length)], [*keep, "sequence_id", "offset"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return (ranked.select(*pieces.columns, F.col(length_col).cast("bigint").alias("pack_length"), F.col("pack_rank").cast("bigint"))
            .mapInArrow(place, f"{kinds}, sequence_id bigint, offset bigint"))


def packed_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0,
                     id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their place: id, piece, start, length, ids_crc32[, ids], sequence_id, offset."""
    return pack(checkpoint(token_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col, with_ids)), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """Training sequences from packed pieces with ids: sequence_id, ids, piece lengths in order.

    A sequence has at most ``capacity`` ids, so its group is bounded.
    """
    parts: Column = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.length").alias("lengths"))
