"""Mixing sources to target weights (built-in functions only): temperature mixing in block permutations.

Source weights are the source token shares raised to an exponent and normalised. The exponent is
bisected so that the mixture reaches a target entropy, and raised again as far as needed to keep
any source from being repeated more often than a limit. The weights become token budgets; a source
is passed over whole epochs and then in part. The documents of a source are dealt by hash into a
fixed number of blocks, each epoch visits the blocks in a hashed order of its own, and the last
epoch takes blocks until its budget is met (to the nearest block). Blocks are the unit of every
decision: a source of any size is a table of that many rows, its documents find their number of
copies by (source, block), and no source's rows meet in one task.

Without a budget the mixture is as small as it can be while every document appears at least once.

Defined results: a null source is a source of its own; sources without tokens stay as they are and
get weight 0; repeated rows are mixed each; with one source, or an empty table, nothing changes.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from metricwatch.llm.common import WORD, checkpoint, fresh, hex_number, text_of

#: Blocks a source is dealt into: budgets are met to about half of one part in this many.
BLOCKS = 1024
#: Production targets: entropy as a part of the largest possible, and how often a source may be passed over.
ENTROPY, MAX_REPEAT = 0.95, 1.5
_CUTS = 16  # an interval is cut into so many parts by one aggregation: four bisections
_ROUNDS = 8


def n_tokens(text_col: str = "text") -> Column:
    """Tokens of a document for mixing: its words."""
    return F.regexp_count(text_of(text_col), F.lit(WORD)).cast("bigint")


def source_key(source_col: str) -> Column:
    """A text for each source, null included."""
    return F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit(""))


def block_of(id_col: str, blocks: int, seed: int) -> Column:
    return F.pmod(hex_number(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(f":{seed}"))), F.lit(blocks))


def fit_exponent(shares: DataFrame, entropy: float, max_repeat: float, budget: float | None = None) -> float:
    """The exponent in [0, 1] for ``shares`` (column p, above 0), to six decimals.

    The largest one whose entropy is at least ``entropy`` (a part of the largest, log of the number
    of sources), or the least one that repeats no source more than ``max_repeat`` times, whichever
    is larger. ``budget`` is in units of the corpus' tokens. One small row per round reaches the driver.
    """
    def measure(low: float, high: float) -> list[tuple[float, float, float, int]]:
        points = [low + (high - low) * k / _CUTS for k in range(_CUTS + 1)]
        tried = shares.select("p", F.explode(F.array(*[F.lit(a) for a in points])).alias("a"))
        power = F.pow("p", F.col("a"))
        got = tried.groupBy("a").agg(F.sum(power).alias("z"), F.sum(power * F.ln("p")).alias("s"),
                                     F.max(F.pow("p", F.col("a") - 1)).alias("small"),
                                     F.max(F.pow("p", 1 - F.col("a"))).alias("large"), F.count("*").alias("k"))
        return sorted((r["a"], log(r["z"]) - r["a"] * r["s"] / r["z"],
                       r["small"] * (r["large"] if budget is None else budget / r["z"]), r["k"]) for r in got.collect())

    def bisect(good) -> tuple[float, float]:
        """Ends of the last interval: ``good`` holds at the lower end and not at the upper one."""
        low, high = 0.0, 1.0
        for _ in range(_ROUNDS):
            points = measure(low, high)
            fits = [good(*x) for x in points]
            if all(fits):
                return high, high
            if not fits[0]:
                return low, low
            at = fits.index(False)
            low, high = points[at - 1][0], points[at][0]
        return low, high

    flat = bisect(lambda a, h, rep, k: h >= entropy * log(k) - 1e-12)[0]
    rare = bisect(lambda a, h, rep, k: rep > max_repeat + 1e-12)[1]
    return round(max(flat, rare), 6)


def plan_blocks(docs: DataFrame, entropy: float, max_repeat: float, budget_tokens: int | None, blocks: int, seed: int,
                id_col: str, source_col: str, text_col: str) -> DataFrame:
    """(src, block, copies, weight): how often each block of each source is used."""
    sums = checkpoint(docs.select(source_key(source_col).alias("src"), block_of(id_col, blocks, seed).alias("block"),
                                  n_tokens(text_col).alias("t")).groupBy("src", "block").agg(F.sum("t").alias("t")))
    total = sums.agg(F.sum("t")).head()[0] or 0
    sources = sums.groupBy("src").agg(F.sum("t").alias("tokens"))
    if not total:
        return sums.select("src", "block", F.lit(1).alias("copies"), F.lit(0.0).alias("weight"))
    shares = checkpoint(sources.where("tokens > 0").withColumn("p", F.col("tokens") / F.lit(total)))
    a = fit_exponent(shares, entropy, max_repeat, None if budget_tokens is None else budget_tokens / total)
    powers = shares.withColumn("power", F.pow("p", F.lit(a)))
    z, least = powers.agg(F.sum("power"), F.max(F.col("tokens") / F.col("power"))).head()
    whole = z * least if budget_tokens is None else float(budget_tokens)
    passes = powers.select("src", "tokens", (F.col("power") / z).alias("weight"),
                           (F.col("power") / z * whole / F.col("tokens")).alias("passes"))
    passes = passes.select("src", "weight", F.floor(F.col("passes") + 1e-9).cast("int").alias("epochs"),
                           (F.greatest(F.col("passes") - F.floor(F.col("passes") + 1e-9), F.lit(0.0)) * F.col("tokens")).alias("rest"))
    order = W.partitionBy("src").orderBy(mix_key(F.col("src"), F.col("epochs"), F.col("block")), "block")
    done = F.sum("t").over(order.rowsBetween(W.unboundedPreceding, 0))
    part = F.when(2 * done - F.col("t") <= 2 * F.col("rest"), 1).otherwise(0)  # the block's middle is within the budget
    part = F.when(F.col("rest") > 1e-6, part).otherwise(0)
    used = sums.join(passes, "src").select("src", "block", (F.col("epochs") + part).cast("int").alias("copies"), "weight")
    idle = sums.join(passes.select("src"), "src", "left_anti").select("src", "block", F.lit(1).alias("copies"), F.lit(0.0).alias("weight"))
    return checkpoint(used.unionAll(idle))


def mix_key(src: Column, epoch: Column, block: Column) -> Column:
    """A hashed number; rows sorted by it come block by block in a permuted order."""
    return hex_number(F.concat_ws(":", src, epoch.cast("string"), block.cast("string")), 13)


def mixed(docs: DataFrame, entropy: float = ENTROPY, max_repeat: float = MAX_REPEAT, budget_tokens: int | None = None,
          blocks: int = BLOCKS, seed: int = 17, id_col: str = "doc_id", source_col: str = "source",
          text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` and mix_epoch, mix_block, mix_key, mix_weight (underscores added where taken).

    A document comes once per epoch that uses its block.
    """
    plan = plan_blocks(docs, entropy, max_repeat, budget_tokens, blocks, seed, id_col, source_col, text_col)
    out = fresh(docs, "mix_epoch", "mix_block", "mix_key", "mix_weight")
    src, block, copies, weight = fresh(docs.withColumns({c: F.lit(0) for c in out}), "mix_src", "mix_blk", "mix_copies", "mix_w")
    plan = plan.toDF(src, block, copies, weight)
    rows = docs.withColumns({src: source_key(source_col), block: block_of(id_col, blocks, seed)}).join(plan, [src, block])
    rows = rows.where(F.col(copies) > 0).select(
        *docs.columns, src, block, weight, F.explode(F.sequence(F.lit(0), F.col(copies) - 1)).alias(out[0]))
    return rows.select(*docs.columns, out[0], F.col(block).alias(out[1]),
                       mix_key(F.col(src), F.col(out[0]), F.col(block)).alias(out[2]), F.col(weight).alias(out[3]))
