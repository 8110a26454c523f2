"""Ranked lexical search, HTML extraction and spelling variants against plain Python versions."""

import html
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from metricwatch.llm import lexical, queries, spelling, webtext
from tests.llm.data import frame, rows

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def plain_ranks(docs, items, top=10):
    """docs: (id, text), items: (id, text) -> sorted (item, rank, id, score)."""
    found = [(i, Counter(TERM.findall((t or "").translate(FOLD)))) for i, t in docs]
    found = [(i, c) for i, c in found if c]
    n_docs, total = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in found:
            m = 10 + 90 * sum(c.values()) * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in set(TERM.findall((text or "").translate(FOLD))) if t in c)
            if score > 0:
                scores.append((-score, i is None, i if i is not None else 0))
        out += [(item, k + 1, None if none else i, -s) for k, (s, none, i) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def ranks(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_terms_end_at_ascii_only():
    text = "Été naïve x AB-cd_e\x7ff 12\x00g 　"
    assert [t.decode() for t in lexical.terms(text.encode())] == TERM.findall(text.translate(FOLD))


def test_counts_are_of_whole_terms():
    words = [b"a", b"ab", b"b"]
    n, found = lexical.counts(lexical.automaton(words), "A ab,a;b abab  b\nb".encode())
    assert n == 7 and found == {0: 2, 1: 1, 2: 3}


@pytest.mark.parametrize("max_terms", [lexical.MAX_TERMS, 5])
def test_ranks_of_odd_rows(spark, max_terms):
    items = [(1, "The RIVER, the stone"), (2, None), (3, ""), (4, "日本語 naïve"), (4, "alpha beta gamma delta"), (None, "sky")]
    got = lexical.ranked_documents(frame(spark), spark.createDataFrame(items, "item_id int, text string"), max_terms=max_terms)
    assert got.dtypes == [("item_id", "int"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert ranks(got) == plain_ranks([(r[0], r[1]) for r in rows()], items)


def test_ranks_of_empty_tables(spark):
    docs, items = frame(spark), spark.createDataFrame([(1, "sky")], "item_id int, text string")
    assert lexical.ranked_documents(docs.limit(0), items).count() == 0
    assert lexical.ranked_documents(docs, items.limit(0)).count() == 0
    assert lexical.ranked_documents(docs, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]


def test_query_ranks(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()
    assert ranks(queries.op11_ranked_lexical_search(spark, SF)) == plain_ranks(docs, items)


PROSE = "It was the best of the stories that they have told in the house by the river, and it is long."
OTHER = "The reader of this page has to know that it is not the article but one of the notes to it."


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("   \n", ""), ("no tags at all", ""), (PROSE, PROSE),
    (f"<article><h1>Title</h1><p>{PROSE}</p><p>Be.</p></article>", f"Title {PROSE} Be."),
    ("<article><p>Be.</p></article>", "Be."),
    (f"<nav><a href=x>The</a></nav><div class=ad>{OTHER}</div><article><p>{PROSE}</article><footer>{OTHER}</footer>", PROSE),
    (f"<ul><li><a href=/>Home of the</a><li><a href=/b>All of the news</a></ul><div id=main><h2>Head</h2><p>{PROSE}<p>Short.<p>{PROSE}"
     f"</div><div id=footer>{OTHER}</div>", f"Head {PROSE} Short. {PROSE}"),
    (f"<main><p>{PROSE}</p><aside>{OTHER}</aside><form><p>{OTHER}</p></form><section id='comments'><p>{OTHER}</p></section></main>", PROSE),
    (f"<main><p>{PROSE}</p><div class='cookieNotice x'>{OTHER}</div><p style='display: none'>{OTHER}</p><p hidden>{OTHER}</p></main>", PROSE),
    (f"<div class='content has-sidebar'><p>{PROSE}</p></div><div class=sidebar>{OTHER}</div>", PROSE),
    (f"<body><p>{PROSE}<script>var t='</p><p>{OTHER}';</script><style>p{{}}</style><!-- <p>{OTHER}</p> --> Tail.", f"{PROSE} Tail."),
    ("<article><p>a &lt;b&gt; &amp;lt; &copy &#233;&nbsp;x\n\t y<br>z</p></article>", "a <b> &lt; © é x y z"),
    (f"<article><p><b>{PROSE}<br><p>One <i>two</i>three</p>", f"{PROSE} One twothree"),
    (f"<head><meta x><p>{PROSE}</p>", PROSE), (f"<article><p title=it's>{PROSE}</p><p class=\"x", PROSE),
    (f"<header><p>{OTHER}</p></header><article><header><h1>T</h1></header><p>{PROSE}</p></article>", f"T {PROSE}"),
    (f"<p>{PROSE}</p><p><a href=x>{OTHER}</a></p>", PROSE),
])
def test_main_text(page, text):
    assert webtext.main_text(page) == text


def test_inherited_labels():
    bad, none, good = webtext.BAD, webtext.UNDECIDED, webtext.GOOD
    plain = lambda labels: webtext.inherit(labels, [False] * len(labels))
    assert plain([bad, none, none, none, good]) == [bad, bad, bad, good, good]
    assert plain([good, none, none, good, none]) == [good] * 5
    assert plain([none, none]) == [none, none] and plain([]) == []
    assert webtext.inherit([bad, none, good], [False, True, False]) == [bad, good, good]


def test_deep_and_long_pages():
    assert webtext.main_text("<div>" * 20000 + PROSE + "</div>" * 20000) == PROSE
    assert webtext.main_text("<i>" * 20000 + PROSE) == PROSE
    assert webtext.main_text("<article>" + f"<p>{PROSE}" * 5000).count("stories") == 5000


def test_extract_rows(spark):
    got = webtext.extract_text(spark.createDataFrame(
        [(1, "u", f"<p>{PROSE}</p>", 5), (1, "u", f"<p>{PROSE}</p>", 5), (None, None, None, None), (2, "v", "é", 1)],
        "page_id bigint, url string, html string, text int"))
    assert got.dtypes == [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, "u", PROSE, len(PROSE))] * 2 + [(None, None, "", 0), (2, "v", "", 0)], key=str)
    assert webtext.extract_text(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_query_extracts_the_articles(spark):
    """The pages' articles, cut out by a pattern that fits these pages only."""
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in queries.op12_html_extraction(spark, SF).collect():
        article = re.search(r"<article>(.*?)(</article>|<footer>|$)", pages[r["page_id"]], re.S)[1]
        assert r["text"] == " ".join(html.unescape(re.sub("<[^>]*>", " ", article)).split()) and r["n_chars"] == len(r["text"])


def plain_words(docs):
    out = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def one_off(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def plain_variants(counts):
    by_length = defaultdict(list)
    for w in counts:
        by_length[len(w)].append(w)
    near = {w: [v for k in (-1, 0, 1) for v in by_length[len(w) + k] if one_off(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return sorted(out)


def variants(df):
    return sorted(map(tuple, df.collect()))


#: Words that share prefixes and suffixes, with runs of equal letters, on both sides of every border.
FAMILY = ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "aaaaaab", "aabaaaa", "abababa", "abababab", "bababab", "wanderer", "wandererr", "wandereer",
          "wandere", "wonderer", "wanderers", "wanderÿr", "étéétéét", "étéétéé", "zzzzzzz", "zzzzzzzz", "zzzzzzzy", "zzzzzz×z"]


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_variants_of_a_family(spark, parts):
    counts = {w: 2 * 11 ** (k % 4) for k, w in enumerate(FAMILY)}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        for at in range(0, len(FAMILY), 7):  # the draw depends on the id: take it from the plain count
            docs = [(at, " ".join(f"{w} " * n for w, n in counts.items()))]
            got = spelling.spelling_variants(spark.createDataFrame(docs, "doc_id int, text string"))
            assert variants(got) == plain_variants(plain_words(docs))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_nodes_are_equal_where_prefixes_are(spark):
    words = sorted(set(FAMILY))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        got = spelling.trie_nodes(spark.createDataFrame([(w,) for w in words], "word string"), "word", "pre").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    node = {}
    for r in got:
        assert len(r["pre"]) == len(r["word"]) + 1
        for k, x in enumerate(r["pre"]):
            assert node.setdefault(r["word"][:k], x) == x
    assert len(set(node.values())) == len(node) and len(got) == len(words)


def test_variants_of_odd_rows(spark):
    docs = [(r[0], r[1]) for r in rows()]
    got = spelling.spelling_variants(frame(spark))
    assert got.dtypes == [("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")]
    assert variants(got) == plain_variants(plain_words(docs))
    assert spelling.spelling_variants(frame(spark).limit(0)).count() == 0


def test_a_chain_of_forms(spark):
    """Each word is near the next, ten times as frequent one: all have the last as root."""
    chain = ["abcdefgh", "abcdefghi", "abcdefghij", "abcdefghijk"]
    docs = [(k, f"{w} ") for k, w in enumerate(w for i, w in enumerate(chain) for _ in range(2 * 12 ** i))]
    got = spelling.spelling_variants(spark.createDataFrame(docs, "doc_id int, text string"))
    assert variants(got) == plain_variants(plain_words(docs))
    assert {r["root"] for r in got.collect() if r["word"] in chain} == {chain[-1]}


def test_query_variants(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert variants(queries.op13_spelling_variants(spark, SF)) == plain_variants(plain_words(docs))
