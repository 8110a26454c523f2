"""Line dedup by content-defined chunks (built-in functions only).

The lines of a text are hashed, and polynomial rolling hashes run over the last line hashes. A cut is
named by the window of such a hash (one or two lines) and one of its lowest bits; it cuts a text
twice: once with a boundary at every line where the bit is 0, once where it is 1. So boundaries depend
on nearby lines alone, and a passage is cut alike wherever it stands. A chunk reaches from one boundary
line to the next, both included; two neighbouring lines that agree in any of the bits are a chunk
of their own, so that a passage of a few lines is seldom missed. Of a chunk that occurs again, anywhere,
the first occurrence (by id, text hash and place) stays whole: its lines stay. All other lines of repeated chunks go.

Chunks are first counted by a 64-bit digest of their lines' keys. Of those whose digest occurs again
the whole arrays of line keys are compared, fetched once a text. Bytes are compared by line: distinct
lines are grouped by key and whole line, so that a key stands for one line's bytes. Chunks with a
key that two lines share (none are expected below some 10^9 distinct lines) never go.

Whole texts and lines cross the network only where they may matter: a bit table of fixed size,
broadcast, holds the keys of the lines in repeated chunks, and another one those of the texts that lose
lines. Lines whose bit is not set are not compared, and texts whose bit is not set pass by the last
join. Bits that are set by chance cost some shuffle and never change a result; where keys by far
outnumber the bits, all lines and texts are shuffled as they would be without the tables.

Defined results: null texts stay null; chunks of fewer than ``min_lines`` lines, or without a word,
never go; a text may end up empty, its row stays; rows that repeat id and text are treated alike;
rows without an id sort first and are treated like others; texts without a repeat stay byte for byte.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricwatch.llm.common import checkpoint, fresh, hex_number, text_of

#: (window of the rolling hash in lines, bit of it) of each cut.
CUTS, MIN_LINES = ((1, 0), (1, 1), (1, 2), (1, 3), (2, 0)), 2
#: Modulus (a Mersenne prime) and base of the rolling hash.
PRIME, BASE = 2147483647, 1000003
#: 64-bit words of a bit table (16 million bits, some 12 MB where it is broadcast).
TABLE_WORDS = 1 << 18
#: A chunk's place is one number: first line * PLACE + last line.
PLACE = 1 << 32


def _first(span: Column) -> Column:
    return F.floor(span / PLACE).cast("int")


def _last(span: Column) -> Column:
    return (span % PLACE).cast("int")


def _part(array: str, span: Column) -> Column:
    return F.slice(array, _first(span) + 1, _last(span) - _first(span) + 1)


def digest(keys: Column) -> Column:
    """The number by which chunks are counted; equal digests are told apart by the keys."""
    return F.xxhash64(keys)


def line_keys(text: str) -> Column:
    return F.transform(F.split(text, "\n"), lambda s: F.xxhash64(s))


def bit_table(keys: DataFrame) -> DataFrame:
    """(word, mask): the bits of all keys (column key); at most TABLE_WORDS rows, whatever their number."""
    place, bit = _bit_of(F.col("key"))
    return keys.groupBy(place.alias("word")).agg(F.bit_or(bit).alias("mask"))


def _bit_of(key: Column) -> tuple[Column, Column]:
    """A key's word, and a number with its bit."""
    bit = F.pmod(F.shiftright(key, 32), F.lit(64)).cast("int")
    return F.pmod(key, F.lit(TABLE_WORDS)), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)


def with_bit(df: DataFrame, key: Column, table: DataFrame, out: str) -> DataFrame:
    """``df`` plus ``out``: whether the key may be one of the table's (true for all that are)."""
    place, bit = _bit_of(key)
    word, mask = fresh(df, "word", "mask")
    held = F.broadcast(table.select(F.col("word").alias(word), F.col("mask").alias(mask)))  # of bounded size, see bit_table
    found = F.coalesce(F.col(mask).bitwiseAND(bit) != 0, F.lit(False))
    return df.join(held, place == F.col(word), "left").withColumn(out, found).drop(word, mask)


def with_chunks(df: DataFrame, text: str, cuts: tuple = CUTS, min_lines: int = MIN_LINES) -> DataFrame:
    """Columns id and sig of ``df`` and chunks: array of (span, digest of the lines' keys, whether there is a word).

    The steps are separate selects because each uses the arrays of the one before several times.
    """
    out = df.select("id", "sig", line_keys(text).alias("keys"), F.split(text, "\n").alias("lines"))
    out = out.select("id", "sig", "keys", F.transform("lines", lambda s: hex_number(s)).alias("hashes"),
                     F.transform("lines", lambda s: s.rlike(r"[^\x20\x09-\x0D]")).alias("words"))

    def rolling(window: int) -> Column:
        def value_at(i: Column) -> Column:
            value = F.lit(0).cast("bigint")
            for back in range(window - 1, -1, -1):  # Horner's rule over the window, the oldest line first
                value = (value * BASE + F.coalesce(F.get("hashes", i - back), F.lit(0))) % PRIME
            return value
        return F.transform(F.sequence(F.lit(0), last), value_at)

    last = F.size("keys") - 1
    windows = sorted({window for window, _ in cuts})
    out = out.select("id", "sig", "keys", "words", *[rolling(w).alias(f"values{w}") for w in windows])

    def boundaries(window: int, bit: int, side: int) -> Column:
        here = lambda i: (F.shiftright(F.get(f"values{window}", i), bit) % 2 == side) | (i == last)
        return F.filter(F.sequence(F.lit(0), last), here)

    sides = [boundaries(window, bit, side) for window, bit in cuts for side in (0, 1)]
    names = [f"cut{k}" for k in range(len(sides))]
    out = out.select("id", "sig", "keys", "words", *[c.alias(n) for c, n in zip(sides, names)])

    def spans(cut: str) -> Column:
        begin = lambda k: F.coalesce(F.get(cut, k - 1), F.lit(0)).cast("bigint")
        ends = F.transform(cut, lambda end, k: F.when(end - begin(k) + 1 >= min_lines, begin(k) * PLACE + end))
        return F.filter(ends, lambda p: p.isNotNull())

    out = out.select("id", "sig", "keys", "words", F.array_distinct(F.flatten(F.array(*map(spans, names)))).alias("spans"))

    def chunk(span: Column) -> Column:
        return F.struct(span.alias("span"), digest(_part("keys", span)).alias("digest"),
                        F.array_contains(_part("words", span), True).alias("word"))

    return out.select("id", "sig", F.transform("spans", chunk).alias("chunks"))


def again_by_keys(base: DataFrame, each: DataFrame) -> DataFrame:
    """(id, sig, span, keys) of the chunks ``each`` whose digest occurs again; few others are left to tell apart."""
    twice = checkpoint(each.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest"))
    found = each.join(twice, "digest").groupBy("id", "sig").agg(F.collect_set("span").alias("spans"))
    found = found.select(F.col("id").alias("his"), F.col("sig").alias("her"), "spans")
    texts = base.select("id", "sig", line_keys("text").alias("all"))
    rows = texts.join(found, texts["id"].eqNullSafe(found["his"]) & (F.col("sig") == F.col("her")))
    rows = rows.select("id", "sig", "all", F.explode("spans").alias("span"))
    return checkpoint(rows.select("id", "sig", "span", _part("all", F.col("span")).alias("keys")))


def shared_keys(texts: DataFrame, text: str, asked: DataFrame) -> DataFrame:
    """Those of the keys ``asked`` (column key) that different lines share, found by comparing whole lines."""
    lines = texts.select(F.explode_outer(F.split(text, "\n")).alias("line")).where("line is not null")
    keyed = with_bit(lines.select(F.xxhash64("line").alias("key"), "line"), F.col("key"), bit_table(asked), "asked").where("asked")
    return (keyed.select("key", "line").distinct().groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"))


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cuts: tuple = CUTS,
                   min_lines: int = MIN_LINES) -> DataFrame:
    """(id, sig, gone): per text that loses lines the numbers of the lines that go; sig is the text's hash."""
    base = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("sig"), F.col(text_col).alias("text"))
    base = base.where(F.col("text").contains("\n"))  # others are no chunk of several lines
    each = (with_chunks(base, "text", cuts, min_lines).select("id", "sig", F.explode_outer("chunks").alias("c"))
            .where("c.word").select("id", "sig", F.col("c.span").alias("span"), F.col("c.digest").alias("digest")))
    each = again_by_keys(base, each)
    at = F.struct("id", "sig", "span")
    again = checkpoint(each.groupBy("keys").agg(F.min(at).alias("first"), F.count("*").alias("n"))
                       .where("n > 1").select("keys", "first"))
    asked = again.select("keys", F.explode("keys").alias("key"))
    unsure = asked.join(shared_keys(base, "text", asked), "key", "left_semi").select("keys").distinct()
    found = each.join(again.join(unsure, "keys", "left_anti"), "keys")
    stays = at.eqNullSafe(F.col("first"))
    lines = lambda spans: F.flatten(F.transform(spans, lambda p: F.sequence(_first(p), _last(p))))
    return (found.groupBy("id", "sig").agg(F.collect_set(F.when(~stays, F.col("span"))).alias("later"),
                                           F.collect_set(F.when(stays, F.col("span"))).alias("first"))
            .select("id", "sig", F.array_except(lines("later"), lines("first")).alias("gone")).where("size(gone) > 0"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars",
                cuts: tuple = CUTS, min_lines: int = MIN_LINES) -> DataFrame:
    """``docs`` without repeated passages in the text, and n_gone: how many lines it lost (its name is the last column's).

    If ``chars_col`` is a column it follows the new text's length.
    """
    gone = repeated_lines(docs, id_col, text_col, cuts, min_lines)
    sig, his, her, places, lines, new, n_gone, cut_too = fresh(
        docs, "l_sig", "l_id", "l_text_sig", "l_places", "l_lines", "l_new", "n_gone", "l_cut")
    gone = checkpoint(gone.select(F.col("id").alias(his), F.col("sig").alias(her), F.col("gone").alias(places)))
    table = checkpoint(bit_table(gone.select(F.xxhash64(his, her).alias("key"))))
    rows = docs.withColumn(sig, F.xxhash64(text_of(text_col)))
    rows = with_bit(rows, F.xxhash64(id_col, sig), table, cut_too)
    whole = rows.where(~F.col(cut_too)).select(*docs.columns, F.lit(0).alias(n_gone))
    rows = rows.where(cut_too)
    rows = rows.join(gone, rows[id_col].eqNullSafe(gone[his]) & (F.col(sig) == F.col(her)), "left")
    lossy = F.when(F.col(places).isNotNull(), F.col(text_col))  # other rows are not cut
    cut = rows.select("*", F.split(lossy, "\n").alias(lines))
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(places))
    left = F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")
    out = cut.select("*", F.when(F.col(places).isNull(), F.col(text_col)).otherwise(left).alias(new))
    length = lambda of: F.length(of).cast(docs.schema[chars_col].dataType).alias(chars_col)
    cols = [F.col(new).alias(c) if c == text_col else length(new) if c == chars_col else F.col(c) for c in docs.columns]
    whole = whole.select(*[length(text_col) if c == chars_col else F.col(c) for c in docs.columns], n_gone)
    return whole.unionByName(out.select(*cols, F.coalesce(F.size(places), F.lit(0)).alias(n_gone)))
