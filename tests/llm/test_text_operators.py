import random
import re

import pytest
from pyspark.sql import functions as F

from metricwatch.llm import langid, licenses, mixing, quality, queries, urls
from tests.llm.data import frame, prose, rows, words

SF = "/root/testdata/sf0.001"


def plain_counts(text):
    w = words(text)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    again = {g for g in grams if grams.count(g) > 1} if len(grams) < 700 else None
    lines_ = [s for s in (text or "").split("\n") if words(s)]
    hit = None if again is None else {i + j for i, g in enumerate(grams) if g in again for j in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines_) - len(set(lines_)), hit if hit is None else len(hit))


def test_quality_counts_odd_documents(spark):
    out = quality.judge(frame(spark)).collect()
    assert len(out) == len(rows())
    got = sorted([(str(r["doc_id"]), *(r[c] for c in quality.COUNTS)) for r in out])
    for g, r in zip(got, sorted(((str(r[0]), r[1]) for r in rows()), key=lambda x: (x[0], *plain_counts(x[1])[:4]))):
        want = plain_counts(r[1])
        assert g[1:5] == want[:4] and (want[4] is None or g[5] == want[4])
    by = {r["doc_id"]: r for r in out}
    assert by[13]["base_failed"] and by[4]["base_failed"] and not by[12]["kept"] and by[0]["kept"]
    df = frame(spark)
    kept = quality.keep_good(df)
    assert kept.columns == df.columns and kept.count() == sum(r["kept"] for r in out)
    assert quality.judge(frame(spark, [])).collect() == []


def test_quality_keeps_clean_documents(spark):
    found = queries.op9_quality_rules(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").where("not base_failed").collect()
    assert all(r["kept"] for r in found if r["quality"] == 1)
    bad = [r["kept"] for r in found if r["quality"] == 0]
    assert sum(bad) < 0.2 * len(bad)


def test_language_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op7_language_id(spark, sf).join(queries.documents(spark, sf).select("doc_id", "lang", "text"), "doc_id").where("held_out").collect()
    sure = [r for r in got if len(r["text"]) > 100]
    assert sum(r["lang"] == r["lang_pred"] for r in sure) >= 0.98 * len(sure)
    assert all(0 <= r["score"] <= 1 for r in got)


def plain_ranks(text):
    low = re.findall(r"[^\W\d_]+", text.lower())
    counts = {}
    for w in low:
        padded = "\0" + w + "\0"
        for n in (1, 2, 3):
            for i in range(len(padded) - n + 1):
                g = padded[i:i + n]
                if g.strip("\0") and "\0" not in g[1:-1]:
                    counts[g] = counts.get(g, 0) + 1
    return counts


def test_language_grams_against_plain_python(spark):
    for text in ("The cat. The hat!", "Äpfel 12 x", "a", "日本 語", prose(4, 50)):
        found, n = langid._counted(langid.grams(text))
        assert sorted(n.tolist()) == sorted(plain_ranks(text).values())


def test_language_against_plain_profiles(spark):
    """Profiles, ranks, out-of-place distance and the nearest language, from the grams on."""
    docs = [(k, r["text"], r["lang"]) for k, r in enumerate(queries.documents(spark, SF).select("text", "lang").collect())]
    totals = {}
    for _, text, lang in docs[::2]:
        if lang is not None:
            for g, n in plain_ranks(text or "").items():
                totals.setdefault(lang, {})[g] = totals.get(lang, {}).get(g, 0) + n
    df = spark.createDataFrame(docs, "doc_id int, text string, lang string")
    profiles = langid.learn(df.where("doc_id % 2 = 0"))
    assert set(profiles) == set(totals)
    size = max(len(p) for p in profiles.values())
    for lang, counts in totals.items():
        kept = sorted(counts.values(), reverse=True)[:size]
        assert len(profiles[lang]) == len(kept)
    near = 0
    got = {r["id"]: r["lang_pred"] for r in langid.identify(df, profiles).collect()}
    for k, text, lang in docs[1::2]:
        if not plain_ranks(text or ""):
            assert got[k] == "und"
            continue
        near += got[k] == plain_language(text, totals, size)
    assert near >= 0.99 * len([1 for k, t, _ in docs[1::2] if plain_ranks(t or "")])  # equal counts may be ranked either way


def plain_language(text, totals, size):
    ranks = lambda counts: {g: k for k, (g, _) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:size])}
    own = ranks(plain_ranks(text))
    far = {lang: sum(abs(k - profile[g]) if g in profile else size for g, k in own.items())
           for lang, profile in ((lang, ranks(c)) for lang, c in totals.items())}
    return min(sorted(far), key=far.get)


def test_language_odd_documents(spark):
    df = frame(spark)
    profiles = langid.learn(df)
    assert set(profiles) == {"en"}
    got = {(r["id"], r["lang_pred"]) for r in langid.identify(df, profiles).collect()}
    assert {(3, "und"), (4, "und"), (12, "und"), (0, "en"), (9, "en"), (None, "und")} <= got
    assert {r["lang_pred"] for r in langid.identify(df, {}).collect()} == {"und"}
    assert langid.learn(frame(spark, [])) == {} and langid.identify(frame(spark, []), profiles).collect() == []


def test_mixing_odd_documents(spark):
    df = frame(spark)
    out = mixing.mixed(df)
    assert out.columns[:len(df.columns)] == df.columns and len(out.columns) == len(df.columns) + 4
    assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in df.collect()}  # each at least once
    assert mixing.mixed(frame(spark, [])).collect() == []
    assert mixing.mixed(frame(spark, [r for r in rows() if not r[1]])).count() == 3


def test_mixing_meets_its_targets(spark):
    data = [(k, "word " * 20, "src" + str(0 if k % 10 < 7 else k % 10)) for k in range(8000)]
    df = spark.createDataFrame(data, "doc_id bigint, text string, source string")
    for repeat, entropy in ((1.5, 0.95), (10.0, 0.9), (1.0, 0.95)):
        out = mixing.mixed(df, entropy=entropy, max_repeat=repeat).groupBy("source").agg(
            F.count("*").alias("n"), F.first("mix_weight").alias("w"), F.max("mix_epoch").alias("last")).collect()
        total = sum(r["n"] for r in out)
        assert all(abs(r["n"] / total - r["w"]) < 0.01 for r in out)
        assert max(r["n"] / (5600 if r["source"] == "src0" else 800) for r in out) <= repeat + 0.01
    budget = mixing.mixed(df, max_repeat=10.0, budget_tokens=80_000).count()
    assert abs(budget * 20 - 80_000) < 2_000


def all_wordings(own):
    """(template, first word, end, edits) of every passage close enough to a template, without compression or cues."""
    for k, (_, text, keys) in enumerate(licenses.TEMPLATES):
        template = licenses.words(text)
        keys, limit = set(keys.split()) & set(template), int(licenses.ALLOWED * len(template))
        if keys <= set(own):
            for first, end, edits in licenses.passages(template, keys, limit, own):
                yield k, first, end, edits


def plain_scan(text):
    """{(license, first word, end)} of the passages that the exhaustive search confirms, by the same order."""
    scanner, found, taken = licenses.Scanner(), [], []
    places = [m.span() for m in licenses._word.finditer(text)]
    for k, first, end, edits in set(all_wordings(licenses.words(text))):
        alone, with_it = scanner.sizes(text[places[first][0]:places[end - 1][1]], k)
        found.append((with_it - alone, edits, k, first, end))
    alone = lambda p, others: all(p[4] <= q[3] or q[4] <= p[3] for q in others)
    best = []
    for p in sorted(found, key=lambda p: (p[1], p)):  # the most exact ones of each template
        if alone(p, [q for q in best if q[2] == p[2]]):
            best.append(p)
    for p in sorted(best):
        if alone(p, taken):
            taken.append(p)
    return {(places[p[3]][0], places[p[4] - 1][1], licenses.TEMPLATES[p[2]][0], p[1]) for p in taken}


CUES = re.compile(licenses.CUE)


def scanned(text, scanner=None):
    return {r[:3] + (r[4],) for r in (scanner or licenses.Scanner()).scan(text, CUES)}


def test_licenses(spark):
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
           "files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, "
           "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
           "Software is furnished to do so")
    texts = [prose(1, 30) + "\nReleased under the MIT License.\n" + prose(2, 30), "Licensed under CC BY-NC 4.0.", "Licensed under CC BY 4.0.",
             mit, "This work is licensed under the GNU General Public License, version 3.", "My driving license expired in spring.",
             "This work is licensed under the GNU General Public License, version 2.", prose(5, 40)]
    data = [(k, t, None, None, None, None, None, None, None) for k, t in enumerate(texts)]
    got = {r["id"]: r["license"] for r in licenses.scan_licenses(frame(spark, data)).collect()}
    assert got == {0: "MIT", 1: "CC-BY-NC-4.0", 2: "CC-BY-4.0", 3: "MIT", 4: "GPL-3.0", 5: None, 6: "GPL-2.0"}
    licenses.scan_licenses(frame(spark)).collect()
    assert licenses.scan_licenses(frame(spark, [])).collect() == []


def test_licenses_are_found_whatever_stands_around(spark):
    flat = lambda seed, n: prose(seed, n).replace("\n", " ")
    short = [(name, text) for name, text, _ in licenses.TEMPLATES if len(licenses.words(text)) < 10]
    mit = next(text for name, text, key in licenses.TEMPLATES if key == "sublicense").split()
    texts = [flat(1, 200) + " Released under the MIT License. " + flat(2, 200),
             "Copyright 2019 " + flat(3, 16) + " All rights reserved.",
             "Released under the MIT License. All rights reserved.",
             flat(4, 30) + " ".join(f" {text} {flat(9 + k, 20)}" for k, (_, text) in enumerate(short)),
             "\n".join(" ".join(mit[k:k + 12]) for k in range(0, len(mit), 12)),
             "Released under the MIT License. " * 3]
    data = [(k, t, None, None, None, None, None, None, None) for k, t in enumerate(texts)]
    got = sorted(licenses.scan_licenses(frame(spark, data)).collect(), key=lambda r: r["id"])
    found = [[r["license"] for r in got if r["id"] == k] for k in range(len(texts))]
    assert found == [["MIT"], ["Proprietary"], ["MIT", "Proprietary"], [name for name, _ in short], ["MIT"], ["MIT"] * 3]
    assert all(r["confirmed"] and r["differences"] == 0 and r["block"] in texts[r["id"]] for r in got)


@pytest.mark.parametrize("change, n", [((), 0), ((5,), 1), ((5, 9), 2), ((5, 9, 12, 20, 25, 30, 35), None)])
def test_license_wording_allows_a_tenth(change, n):
    name, text, keys = next(t for t in licenses.TEMPLATES if t[2] == "sublicense")
    own = text.split()
    for k in change:
        own[k] = "other"
    scanner = licenses.Scanner()
    got = scanner.scan(prose(1, 300) + " " + " ".join(own) + " " + prose(2, 300), CUES)
    assert [(r[2], r[4]) for r in got] == ([] if n is None else [("MIT", n)])
    assert scanner.scan(text.replace("sublicense", "license"), CUES) == []


def test_licenses_of_query_against_exhaustive_search(spark):
    """Both ways: no passage is lost, none is made up."""
    sf, places = "/root/testdata/sf0.01", 0
    got = {}
    for r in queries.op6_license_scans(spark, sf).where("confirmed").collect():
        got.setdefault(r["doc_id"], []).append((r["block"], r["license"], r["differences"]))
    for doc, text in queries.documents(spark, sf).select("doc_id", "text").collect():
        want = sorted((text[a:b], name, n) for a, b, name, n in plain_scan(text or ""))
        assert sorted(got.get(doc, [])) == want
        places += len(want)
    assert places > 10


def planted(seed):
    """A notice with up to a tenth of its other words changed, 0 to 200 words around it."""
    r = random.Random(seed)
    name, text, keys = licenses.TEMPLATES[seed % len(licenses.TEMPLATES)]
    own = text.split()
    free = [k for k, w in enumerate(own) if not set(licenses.words(w)) & set(keys.split()) and not CUES.search(w)]
    for k in r.sample(free, min(len(free), r.randint(0, int(licenses.ALLOWED * len(licenses.words(text)))))):
        own[k] = "other"
    around = [" ".join(prose(seed + k, 201).split()[:r.choice((0, 1, 5, 20, 80, 200))]) for k in (1, 2)]
    return f"{around[0]} {' '.join(own)} {around[1]}".strip()


def test_ranking_finds_what_the_exhaustive_search_finds():
    scanner, found, want = licenses.Scanner(), 0, 0
    for seed in range(21 * 20):
        text = planted(seed)
        full = plain_scan(text)
        found, want = found + len(full & scanned(text, scanner)), want + len(full)
    assert want >= 400 and found >= 0.99 * want


def test_the_ranking_decides(monkeypatch):
    """Without the sizes nothing is a candidate; with all alike, the longer notice doesn't win over the shorter one in it."""
    text = next(t for name, t, _ in licenses.TEMPLATES if name == "Apache-2.0" and len(t) > 60)
    assert scanned(text) == {(0, len(text), "Apache-2.0", 0)}
    monkeypatch.setattr(licenses.Scanner, "sizes", lambda self, part, k=None: (100, 100))
    assert scanned(text) == set()
    monkeypatch.setattr(licenses, "FLOOR", 0)
    assert scanned(text) != {(0, len(text), "Apache-2.0", 0)}


def test_dense_cues_are_scanned_in_bounded_passages():
    text = "license " * 3000 + "Released under the MIT License. " + "copyright " * 3000
    assert {r[2] for r in scanned(text)} == {"MIT"}


@pytest.mark.parametrize("a, b, n", [("a b c", "x a b c y", 0), ("a b c", "a c", 1), ("a b c", "a q c", 1), ("a", "", 1)])
def test_wording_differences(a, b, n):
    assert licenses.wording_differences(a.split(), b.split())[0] == n


def test_url_rules(spark):
    data = [(1, "HTTP://WWW.Example.COM/en/x?q"), (2, "http://example.com/en/"), (3, "http://a.example.com/en"), (4, "https://x.net/fr/1"),
            (5, None), (6, "no scheme"), (6, "no scheme"), (7, "http://net/es/#a"), (8, "http://com"), (9, "x://y://com/"),
            (None, "ftp://notcom/"), (10, "http://")]
    rules = spark.createDataFrame(list(queries.URL_RULES), "host string, path string, verdict string")
    pages = spark.createDataFrame(data, "page_id bigint, url string")
    pages = pages.withColumns({"row": F.lit(1), "key": F.lit("k"), "hits": F.lit(0)})
    got = sorted((str(r["page_id"]), r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge_urls(pages, rules).collect())
    assert got == sorted([
        ("1", "www.example.com", "/en/x", "www.example.com/en/", "allow"), ("2", "example.com", "/en/", "example.com/en/", "block"),
        ("3", "a.example.com", "/en", "com/", "allow"), ("4", "x.net", "/fr/1", "net/fr/", "block"), ("5", "", "", None, "allow"),
        ("6", "", "", None, "allow"), ("6", "", "", None, "allow"), ("7", "net", "/es/", "net/es/", "block"), ("8", "com", "", None, "allow"),
        ("9", "y:", "//com/", None, "allow"), ("None", "notcom", "/", None, "allow"), ("10", "", "", None, "allow")], key=lambda x: x)
    assert urls.judge_urls(pages.limit(0), rules).collect() == []
    assert {r["verdict"] for r in urls.judge_urls(pages, rules.limit(0)).collect()} == {"allow"}


def test_bloom_holds_every_entry_and_few_others(spark):
    keys = spark.range(3000).select(F.concat(F.lit("host"), "id", F.lit(".org/")).alias("key"))
    bloom = urls.BlockedBloom(urls.build_filter(keys))
    assert bloom.may_hold([f"host{k}.org/".encode() for k in range(3000)]).all()
    assert bloom.may_hold([f"other{k}.org/".encode() for k in range(3000)]).sum() < 60
    assert not urls.BlockedBloom(urls.build_filter(keys.limit(0))).may_hold([b"host1.org/", b""]).any()
    assert bloom.may_hold([]).tolist() == []


@pytest.mark.parametrize("part", [0.0, 1.0])
def test_common_entries_are_joined_alike(spark, monkeypatch, part):
    monkeypatch.setattr(urls, "HOT_PART", part)
    monkeypatch.setattr(urls, "max", min, raising=False)  # no least number of hits
    rules = spark.createDataFrame(list(queries.URL_RULES), "host string, path string, verdict string")
    pages = spark.createDataFrame([(k, f"http://{'www.' * (k % 3)}example.com/{'en/' * (k % 2)}{k}") for k in range(60)], "page_id int, url string")
    got = {r["page_id"]: r["rule"] for r in urls.judge_urls(pages, rules).collect()}
    assert got == {k: ("com/" if k % 2 == 0 else "example.com/en/" if k % 3 == 0 else "www.example.com/en/") for k in range(60)}
