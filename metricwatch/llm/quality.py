"""Quality rules: a table of thresholds compiled into one projection (built-in functions only).

Every text gives a few counts (one pass over its words and lines); a rule bounds one number made
of them. ``compile_rules`` turns the whole rule table into Columns of a single select, so the
verdict of all rules costs no shuffle and no Python.

Defined results: null and empty texts have zero words and fail the base rule; a ratio over zero
words or lines is 0; repeated rows are judged alike; texts of any length are judged whole.
The stop words are English, German, French and Spanish: nearly all texts in other languages fail
``stop_words``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricwatch.llm.common import fresh, text_of, words_of

#: Frequent function words of English, German, French and Spanish (common public lists).
STOP_WORDS = (
    "the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "was", "on", "with", "as", "be", "by", "this",
    "are", "at", "from", "or", "an", "not", "have", "has", "but", "which", "we", "you", "they",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "nicht", "dem",
    "ein", "eine", "als", "auch",
    "de", "la", "le", "et", "les", "en", "un", "du", "une", "que", "pour", "est", "par", "dans", "qui", "avec",
    "sur", "pas", "au",
    "el", "y", "los", "se", "del", "las", "por", "con", "no", "su", "una", "para", "es", "al", "lo",
)


@dataclass(frozen=True)
class Rule:
    """``low <= metric <= high`` must hold; a missing bound is open."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None


#: The production table. Bounds follow the usual published heuristics for web text, with room to spare.
RULES = (
    Rule("mean_word_length", "mean_word_length", 2.0, 14.0),
    Rule("symbols", "symbols_per_word", None, 0.1),
    Rule("stop_words", "stop_word_ratio", 0.02, None),
    Rule("repeated_lines", "dup_line_ratio", None, 0.5),
    Rule("cut_lines", "ellipsis_line_ratio", None, 0.3),
)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _starts_of_repeats(words: str, grams: str) -> Column:
    """Start positions, ascending, of the 3-word windows whose words occur in another window too.

    ``grams`` is sorted by (hash, position), so equal windows are neighbours: n log n, no pairs.
    Windows are compared by a 64-bit hash chained over their three words.
    """
    def again(x: Column, k: Column) -> Column:
        g = F.col(grams)
        same = lambda at: F.coalesce(F.get(g, at)["h"] == x["h"], F.lit(False))
        return same(k - 1) | same(k + 1)

    return F.sort_array(F.transform(F.filter(F.col(grams), again), lambda x: x["i"]))


def with_counts(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default all) plus a struct column of counts; its name is the last column's.

    The steps are separate selects because each uses the arrays of the one before several times.
    """
    keep = docs.columns if keep is None else keep
    words, lines, grams, starts, facts, text = fresh(docs, "q_words", "q_lines", "q_grams", "q_starts", "q_facts", "q_text")
    df = docs.select(*keep, text_of(text_col).alias(text))
    df = df.select("*", words_of(F.col(text)).alias(words),
                   F.filter(F.split(F.col(text), "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]")).alias(lines))
    w = F.col(words)
    window = lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i"))
    df = df.select("*", F.when(F.size(w) >= 3, F.sort_array(F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(w) - 3, F.lit(0))), window))).otherwise(F.array()).alias(grams))
    df = df.select("*", _starts_of_repeats(words, grams).alias(starts)).drop(grams)
    s = F.col(starts)
    span = F.transform(s, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(s, k + 1) - p, F.lit(3))))
    long = lambda c: c.cast("bigint")
    counts = F.struct(
        long(F.size(w)).alias("n_words"),
        long(F.length(F.array_join(w, ""))).alias("word_chars"),
        long(F.regexp_count(F.col(text), F.lit(r"[#*$%&|<>]"))).alias("n_symbols"),
        long(F.size(F.col(lines)) - F.size(F.array_distinct(F.col(lines)))).alias("n_dup_lines"),
        long(F.aggregate(span, F.lit(0), lambda a, b: a + b)).alias("n_repeat_words"),
        long(F.size(F.col(lines))).alias("n_lines"),
        long(F.size(F.filter(w, lambda x: F.lower(x).isin(*STOP_WORDS)))).alias("n_stop_words"),
        long(F.size(F.filter(F.col(lines), lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$")))).alias("n_ellipsis_lines"),
    )
    # one element in, one row out: a filter on the counts stays above this generator instead of being
    # rewritten in terms of the text, which would count everything again inside the filter
    return df.select(*keep, F.explode_outer(F.array(counts)).alias(facts))


def metrics(facts: str) -> dict[str, Column]:
    """The numbers a rule can bound, from the struct of counts."""
    f = F.col(facts)
    return {
        "n_words": f["n_words"],
        "mean_word_length": _ratio(f["word_chars"], f["n_words"]),
        "symbols_per_word": _ratio(f["n_symbols"], f["n_words"]),
        "stop_word_ratio": _ratio(f["n_stop_words"], f["n_words"]),
        "dup_line_ratio": _ratio(f["n_dup_lines"], f["n_lines"]),
        "ellipsis_line_ratio": _ratio(f["n_ellipsis_lines"], f["n_lines"]),
        "repeat_word_ratio": _ratio(f["n_repeat_words"], f["n_words"]),
    }


def compile_rules(rules, facts: str) -> tuple[list[Column], Column]:
    """One boolean Column per rule (true: passed) and their conjunction."""
    known = metrics(facts)
    passed = []
    for rule in rules:
        m = known[rule.metric]
        ok = F.lit(True)
        if rule.low is not None:
            ok = ok & (m >= F.lit(rule.low))
        if rule.high is not None:
            ok = ok & (m <= F.lit(rule.high))
        passed.append(ok)
    both = F.lit(True)
    for ok in passed:
        both = both & ok
    return passed, both


def base_failed(facts: str, min_words: int = 50) -> Column:
    """Fewer than ``min_words`` words, or over half of the words in repeated 3-word windows."""
    f = F.col(facts)
    return (f["n_words"] < min_words) | (100 * f["n_repeat_words"] > 50 * f["n_words"])


def judge(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and verdict of every row: id, counts, base_failed, failed_rules, kept."""
    df = with_counts(docs, text_col, [id_col])
    facts = df.columns[-1]
    passed, ok = compile_rules(rules, facts)
    failed = F.filter(F.array(*[F.when(~p, F.lit(r.name)) for p, r in zip(passed, rules)]), lambda x: x.isNotNull())
    return df.select(id_col, *[F.col(facts)[c].alias(c) for c in COUNTS], base_failed(facts).alias("base_failed"),
                     failed.alias("failed_rules"), (~base_failed(facts) & ok).alias("kept"))


def keep_good(docs: DataFrame, rules=RULES, text_col: str = "text") -> DataFrame:
    """The rows that pass, with the columns of ``docs``."""
    df = with_counts(docs, text_col)
    facts = df.columns[-1]
    _, ok = compile_rules(rules, facts)
    return df.where(~base_failed(facts) & ok).select(*docs.columns)
