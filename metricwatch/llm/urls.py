"""URL rules: a blocked Bloom filter of the listed canonical URLs, then an exact hash join.

A listed entry is a canonical host and path prefix (``example.com/en/``). A URL could fit as many
entries as it has host suffixes times listed prefix lengths; each such candidate is looked up in
the broadcast Bloom filter (one 512-bit block per lookup), and only possible hits are joined with
the list by equality, which removes the filter's false positives. The longest fitting entry wins.

Defined results: a null URL, or one without ``://``, has an empty host and path and fits nothing;
a URL that fits no entry gets the default verdict; an empty list gives everyone the default;
repeated rows are judged each; entries listed twice count once (block before allow).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricwatch.llm.common import checkpoint

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: 64-bit words in a block of the filter, and bits set for an entry.
BLOCK_WORDS, PROBES = 8, 8
BITS_PER_ENTRY = 16
#: Largest filter that is broadcast. Beyond it the filter gets denser (more false positives to join), never wrong.
MAX_FILTER_BYTES = 256 << 20
#: URLs whose candidates are tried at once.
URLS_AT_ONCE = 1024
#: Entries that fit more than this part of all hits are joined by a broadcast, all others by a shuffle.
HOT_PART = 1 / 1000


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _places(keys: list[bytes]) -> np.ndarray:
    """(keys, PROBES) places 0..511 in a block that entries set: 9 bits each of a second hash and of a mix of it."""
    second = np.fromiter((xxhash.xxh64_intdigest(k, 7) for k in keys), np.uint64, len(keys))
    more = second * np.uint64(0x9E3779B97F4A7C15)
    shifts = [(second, 9 * k) for k in range(4)] + [(more, 9 * k) for k in range(1, 5)]
    return np.stack([(h >> np.uint64(n)) & np.uint64(511) for h, n in shifts], 1).astype(np.int64).reshape(-1, PROBES)


class BlockedBloom:
    """Lookups in a filter whose blocks are the rows of a (blocks, 8) array of 64-bit words."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words.view(np.uint64)

    def may_hold(self, keys: list[bytes]) -> np.ndarray:
        """Whether each key may be an entry."""
        first = np.fromiter((xxhash.xxh64_intdigest(k, 42) for k in keys), np.uint64, len(keys)).view(np.int64)
        block, place = np.mod(first, len(self.words)), _places(keys)
        words = self.words[block[:, None], place >> 6]
        return ((words >> (place & 63).astype(np.uint64)) & np.uint64(1)).all(axis=1)


def build_filter(listed: DataFrame, key: str = "key") -> np.ndarray:
    """The filter of all entries: bits are set in Spark tasks and merged per block; only blocks come back."""
    n = listed.count()
    blocks = max(1, min(-(-n * BITS_PER_ENTRY // (64 * BLOCK_WORDS)), MAX_FILTER_BYTES // (8 * BLOCK_WORDS)))
    rows = listed.select(_block_of(F.col(key), blocks).alias("block"), F.col(key).alias("key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks = np.zeros((batch.num_rows, BLOCK_WORDS), np.uint64)
            places = _places([x.encode() for x in batch.column(1).to_pylist()])
            for k in range(PROBES):
                masks[np.arange(len(masks)), places[:, k] >> 6] |= np.uint64(1) << (places[:, k] & 63).astype(np.uint64)
            words = [pa.array(masks[:, w].view(np.int64)) for w in range(BLOCK_WORDS)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *words], ["block", *(f"w{w}" for w in range(BLOCK_WORDS))])

    set_bits = rows.mapInArrow(run, "block bigint, " + ", ".join(f"w{w} bigint" for w in range(BLOCK_WORDS)))
    merged = set_bits.groupBy("block").agg(*[F.bit_or(f"w{w}").alias(f"w{w}") for w in range(BLOCK_WORDS)])
    out = np.zeros((blocks, BLOCK_WORDS), np.int64)
    table = merged.toArrow()  # at most MAX_FILTER_BYTES
    at = table.column("block").to_numpy()
    for w in range(BLOCK_WORDS):
        out[at, w] = table.column(f"w{w}").to_numpy()
    return out.view(np.uint64)


def with_bloom_hits(urls: DataFrame, bloom: np.ndarray, lengths: list[int]) -> DataFrame:
    """(id, host, path) plus ``hits``: the candidate entries that the filter may hold."""
    shared = urls.sparkSession.sparkContext.broadcast(bloom)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = BlockedBloom(shared.value)
        for batch in (whole.slice(at, URLS_AT_ONCE) for whole in batches for at in range(0, whole.num_rows, URLS_AT_ONCE)):
            tried, owner = [], []
            for k, (host, path) in enumerate(zip(batch.column("host").to_pylist(), batch.column("path").to_pylist())):
                rest, starts = host, [path[:n] for n in lengths if n <= len(path)]
                while rest:
                    tried += [rest + s for s in starts]
                    owner += [k] * len(starts)
                    rest = rest.partition(".")[2]
            hits = [[] for _ in range(batch.num_rows)]
            for at in np.flatnonzero(held.may_hold([t.encode("utf-8", "surrogatepass") for t in tried])):
                hits[owner[at]].append(tried[at])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hits, pa.list_(pa.string()))], [*batch.schema.names, "hits"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in urls.schema)
    return urls.mapInArrow(run, f"{kinds}, hits array<string>")


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule (null if none fits), verdict.

    ``rules``: host, path, verdict (allow or block). A rule fits its host and all subdomains if the
    URL's path starts with the rule's; the longest rule wins. Path prefixes may have any length;
    the distinct lengths (not the rules) are gathered on the driver, at most one per character of
    the longest listed path.
    """
    listed = (rules.select(F.concat(F.translate("host", UPPER, LOWER), F.col("path")).alias("key"),
                           F.length("path").alias("path_length"), "verdict")
              .groupBy("key").agg(F.max("verdict").alias("verdict"), F.max("path_length").alias("path_length")))
    lengths = sorted(r[0] for r in listed.select("path_length").distinct().collect())
    bloom = build_filter(listed)
    rows = pages.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                        host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    hits = checkpoint(with_bloom_hits(rows, bloom, lengths))
    each = hits.select("row", F.explode("hits").alias("key"))
    said = checkpoint(listed.select("key", "verdict"))
    # entries that many URLs fit are joined where the URLs lie; there are fewer than 1 / HOT_PART of them
    many = each.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > max(1000, HOT_PART * each.count())).select("key")
    many = F.broadcast(checkpoint(said.join(many, "key", "left_semi")))
    rest = each.join(many.select("key"), "key", "left_anti").join(said, "key")
    found = each.join(many, "key").unionByName(rest)
    best = found.groupBy("row").agg(F.max(F.struct(F.length("key").alias("n"), "key", "verdict")).alias("best"))
    return hits.join(best, "row", "left").select(F.col("id").alias(id_col), "host", "path", F.col("best.key").alias("rule"),
                                                 F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"))
