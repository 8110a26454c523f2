"""Small documents with everything that operators must bear, and plain Python versions of what they compute."""

import random
import re

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, `key` string, component int, shard string, n_words double"
WORDS = "the of and to alpha beta gamma delta river stone light house walks slowly under bright morning sky".split()


def prose(seed, n, per_line=9):
    r = random.Random(seed)
    words = [r.choice(WORDS) for _ in range(n)]
    return "\n".join(" ".join(words[i:i + per_line]) for i in range(0, n, per_line))


def rows():
    base = prose(1, 80)
    texts = [base, base, base.replace("river", "RIVER"), None, "", "   \n ", "one", "one two", "a\x0bb\tc\nd", prose(2, 6000),
             "x" * 70000, "Été naïve 日本語 \x1c sep\xa0nb é", "#*$%&|<> " * 60, "same line here\n" * 30, prose(3, 60), prose(3, 60)]
    out = [(k, t, "en" if k % 2 else None, f"s{k % 3}" if k % 5 else None, None if t is None else len(t), "k", 1, "z", 2.0)
           for k, t in enumerate(texts)]
    out += [out[0], out[0], (None, base, None, None, 3, None, None, None, None), (None, None, None, None, None, None, None, None, None),
            (99, base, "en", "s1", 5, "q", 2, "y", 1.0), (99, prose(5, 70), "en", "s1", 5, "q", 2, "y", 1.0)]
    return out


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
