"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprints are made in Arrow batches (XXH64 of every word shingle, bit majority by numpy). Equal
fingerprints are merged first, so a group of thousands of copies is one row from there on. Every
distinct fingerprint then emits all values within half the radius; two fingerprints within the
radius emit a common value. A bucket of one value holds at most as many distinct fingerprints as
the half ball has points (65 for radius 2), whatever the data. For an even radius all members of a
bucket are within the radius of each other, so one link to the least member loses nothing; for an
odd one the bounded bucket's pairs are checked one by one. All links are verified by bit distance.

Defined results: null and empty texts have fingerprint zero, which links like any other; texts with
fewer words than a shingle are one shingle; rows without an id take part but name no component;
repeated rows get equal results. ``keep_one`` leaves one row a component, whatever ids repeat or are missing.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricwatch.llm.common import checkpoint, fresh, text_of
from metricwatch.llm.components import components

#: Shingles whose bits are unpacked at once: bounds the memory of very long texts.
BITS_AT_ONCE = 1 << 15
SEED = 42


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash, signed. A bit is set if over half of the shingle hashes have it."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # on bytes: A-Z and the six ASCII blanks only
    if not words:
        return 0
    size = min(shingle, len(words))
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    n = len(words) - size + 1
    ends = (starts + lengths)[size - 1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends.tolist())), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, BITS_AT_ONCE):
        part = hashes[at:at + BITS_AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, sig, fp): one row per row of ``docs``; sig is a 64-bit hash of the text."""
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("sig"),
                       F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(x.as_py(), shingle) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps, pa.int64())],
                                             ["id", "sig", "fp"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, sig bigint, fp bigint")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def ball(radius: int) -> list[int]:
    """All 64-bit masks with at most ``radius`` bits."""
    return [_signed(sum(1 << b for b in bits)) for k in range(radius + 1) for bits in combinations(range(64), k)]


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """Distinct fingerprints (column fp) -> verified links (a, b), a > b, that connect all within ``max_bits``."""
    half = (max_bits + 1) // 2
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a few rows here are many below
    fps = fps.repartition(parts, "fp")
    masks = F.array(*[F.lit(m) for m in ball(half)])
    buckets = (fps.select("fp", F.explode_outer(F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m))).alias("value"))
               .groupBy("value").agg(F.collect_list("fp").alias("members")).where(F.size("members") > 1))
    if max_bits % 2 == 0:
        pairs = buckets.select(F.explode("members").alias("a"), F.array_min("members").alias("b"))
    else:
        pairs = (buckets.select(F.explode("members").alias("a"), "members")
                 .select("a", F.explode("members").alias("b")))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return pairs.where((F.col("a") > F.col("b")) & close).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (id, sig, fp, component), the component being the least id reachable."""
    rows = checkpoint(fingerprints(docs, shingle, id_col, text_col))
    distinct = checkpoint(rows.groupBy("fp").agg(F.min("id").alias("first")))
    found = components(links(distinct.select("fp"), max_bits))
    linked = distinct.join(found, distinct["fp"] == found["node"]).select("fp", "component", "first")
    named = linked.join(linked.groupBy("component").agg(F.min("first").alias("name")), "component").select("fp", "name")
    # written out, so that the last join is a plain one of two shuffles: a fingerprint of many copies can be split
    names = checkpoint(distinct.join(named, "fp", "left").select("fp", F.coalesce("name", "first").alias("component")))
    return rows.join(names, "fp").select("id", "sig", "fp", "component")


def hex_digits(fp: Column) -> Column:
    """A fingerprint as 16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``docs`` without near-duplicates: of each component exactly one row stays.

    It is the row with the least id (a missing id comes last), of those the one with the least text hash, and of
    rows equal in both the one whose JSON form is the least. Components are told by fingerprint, so unlike
    texts with one id are groups of their own. Only ids, hashes and fingerprints are grouped; texts are shuffled once, by id.
    """
    rows = fingerprints(docs, shingle, id_col, text_col)
    each = checkpoint(rows.groupBy("id", "sig", "fp").agg(F.count("*").alias("n")))
    heads = checkpoint(each.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "sig")).alias("head")))
    found = components(links(heads.select("fp"), max_bits))
    stay = (heads.join(found, heads["fp"] == found["node"], "left").groupBy(F.coalesce("component", "fp").alias("least"))
            .agg(F.min("head").alias("head")).select(F.col("head.id").alias("stay_id"), F.col("head.sig").alias("stay_sig")))
    mine, sig, text_sig, form = fresh(docs, "near_id", "near_sig", "text_sig", "near_form")
    stays = F.col("stay_sig").isNotNull()
    gone = checkpoint(each.join(stay, F.col("id").eqNullSafe(F.col("stay_id")) & (F.col("sig") == F.col("stay_sig")), "left")
                      .where(~stays | (F.col("n") > 1)).select(F.col("id").alias(mine), F.col("sig").alias(sig), stays.alias("stays")))
    signed = docs.withColumn(text_sig, F.xxhash64(text_of(text_col)))
    same = signed[id_col].eqNullSafe(F.col(mine)) & (F.col(text_sig) == F.col(sig))
    left = signed.join(gone, same, "left_anti").drop(text_sig)
    if gone.where("stays").isEmpty():  # no row that stays occurs twice
        return left
    again = signed.join(gone.where("stays"), same, "left_semi")
    whole = F.struct(*docs.columns)
    one = again.groupBy(id_col, F.col(text_sig).alias(sig)).agg(F.min_by(whole, F.to_json(whole)).alias(form))
    return left.unionByName(one.select(f"{form}.*"))
