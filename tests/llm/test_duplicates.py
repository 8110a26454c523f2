from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from metricwatch.llm import components, exact, lines, queries, simhash
from tests.llm.data import frame, prose, rows, words

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text, size=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = words(low)
    if not w:
        return 0
    shingles = [" ".join(w[i:i + size]) for i in range(max(1, len(w) - size + 1))]
    votes = Counter(b for s in shingles for b in range(64) if xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1)
    return sum(1 << b for b, n in votes.items() if 2 * n > len(shingles))


def plain_components(fps, bits):
    """id -> least id reachable, by comparing all pairs."""
    root = list(range(len(fps)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    for a in range(len(fps)):
        for b in range(a):
            if (fps[a][1] ^ fps[b][1]).bit_count() <= bits:
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(fps):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [(i, f, least.get(find(k))) for k, (i, f) in enumerate(fps)]


def order(rows_):
    return sorted(rows_, key=str)


def test_near_duplicate_query_against_all_pairs(spark):
    docs = queries.documents(spark, SF).select("doc_id", "text").collect()
    want = plain_components([(r[0], plain_fingerprint(r[1])) for r in docs], 2)
    got = [tuple(r) for r in queries.op10_simhash_near_dedup(spark, SF).collect()]
    assert order(got) == order((i, f"{f:016x}", c) for i, f, c in want)


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_near_duplicates_odd_documents(spark, bits):
    data = rows() + [(200 + k, " ".join(prose(9, 400).split()[:400 - k]), None, None, None, None, None, None, None) for k in range(6)]
    want = plain_components([(r[0], plain_fingerprint(r[1])) for r in data], bits)
    got = simhash.near_duplicates(frame(spark, data), 3, bits).select("id", simhash.hex_digits(F.col("fp")), "component").collect()
    assert order(map(tuple, got)) == order((i, f"{f:016x}", c) for i, f, c in want)


def test_links_of_planted_fingerprints(spark):
    base = 0x0123456789ABCDEF
    fps = [base, base ^ 1, base ^ 1 ^ 1 << 40, base ^ 1 << 63 ^ 1 << 2, ~base, 0, 7]
    fps = [simhash._signed(f & (1 << 64) - 1) for f in fps]
    found = components.components(simhash.links(spark.createDataFrame([(f,) for f in fps], "fp bigint"), 2)).collect()
    assert {r["node"] for r in found} == set(fps[:4]) and len({r["component"] for r in found}) == 1


def plain_groups(data, bits=2):
    """The rows' groups as sets of row numbers, by comparing all pairs."""
    named = plain_components([(k, plain_fingerprint(r[1])) for k, r in enumerate(data)], bits)
    groups = defaultdict(list)
    for k, _, c in named:
        groups[c].append(k)
    return list(groups.values())


def stays(group, data):
    """(id, text) of the row that stays, unless texts of one id are told by hash."""
    least = min((data[k][0] is None, data[k][0] or 0) for k in group)
    return [(data[k][0], data[k][1]) for k in group if (data[k][0] is None, data[k][0] or 0) == least]


def test_keep_one_leaves_one_row_of_every_group(spark):
    data = rows()
    kept = simhash.keep_one(frame(spark))
    assert kept.columns == frame(spark).columns
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    groups = plain_groups(data)
    assert len(got) == len(groups)
    for group in groups:
        assert any(x in got for x in stays(group, data))
    assert simhash.keep_one(frame(spark, [])).collect() == []


def test_keep_one_with_repeated_and_missing_ids(spark):
    a, b, c = prose(31, 90), prose(32, 90), prose(33, 90)
    data = [(7, a), (7, b), (8, c), (None, c), (None, c), (None, prose(34, 90)), (None, prose(34, 90)), (9, a)]
    df = spark.createDataFrame(data, "doc_id int, text string").withColumn("extra", F.create_map(F.lit("k"), F.col("doc_id")))
    got = order((r["doc_id"], r["text"]) for r in simhash.keep_one(df).collect())
    assert got == order([(7, a), (7, b), (8, c), (None, prose(34, 90))])


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(k, k + 1) for k in range(300)] + [(1000, 1000 + k) for k in range(1, 400)] + [(5, 5), (2000, 2001), (2001, 2000)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {k: 0 for k in range(301)} | {1000 + k: 1000 for k in range(400)} | {2000: 2000, 2001: 2000}


def test_exact_duplicates_odd_documents(spark, tmp_path):
    out = exact.exact_duplicates(frame(spark), capacity=2, index_path=str(tmp_path / "index"))
    got = [tuple(r) for r in out.select("id", "keep_id", "group_size", "kept").collect()]
    groups = defaultdict(list)
    for r in rows():
        groups[r[1] or ""].append(r[0])
    want = []
    for ids in groups.values():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), i == keep) for i in ids]
    assert order(got) == order(want)
    assert len(list((tmp_path / "index").glob("bucket=*"))) > 1
    assert exact.exact_duplicates(frame(spark, [])).collect() == []


def test_results_come_from_the_buckets(spark, tmp_path):
    """What the owners have written decides: another entry gives another result, a misled row finds none."""
    docs = frame(spark, [(k, f"text {k % 40}", *[None] * 7) for k in range(200)])
    path, other = str(tmp_path / "index"), str(tmp_path / "other")
    cells, depth = exact.build_index(docs, path, capacity=8)
    index = exact.read_index(docs, path)
    assert exact.look_up(docs, index, cells, depth).count() == 200 and index.select("bucket").distinct().count() > 4
    index.withColumn("keep_id", F.lit(-1).cast("bigint")).write.partitionBy("bucket").parquet(other)
    assert exact.look_up(docs, exact.read_index(docs, other), cells, depth).where("keep_id = -1 AND NOT kept").count() == 200
    last = cells.agg(F.max("bucket")).head()[0]
    misled = exact.look_up(docs, index, cells.withColumn("bucket", F.lit(last)), depth).count()
    assert misled == 5 * index.where(F.col("bucket") == last).count() < 200


def test_a_bucket_has_one_owner_and_a_range_of_keys(spark, tmp_path):
    docs = frame(spark, [(k, f"text {k % 300}", *[None] * 7) for k in range(900)])
    exact.build_index(docs, str(tmp_path / "index"), capacity=20)
    index = exact.read_index(docs, str(tmp_path / "index")).withColumn("file", F.input_file_name())
    files = index.groupBy("bucket").agg(F.countDistinct("file").alias("n")).collect()
    assert len(files) > 10 and all(r["n"] == 1 for r in files)
    spans = sorted((r["lo"], r["hi"]) for r in index.withColumn("cell", exact._cell(F.col("key"), exact.MAX_DEPTH)).groupBy("bucket").agg(
        F.min("cell").alias("lo"), F.max("cell").alias("hi")).collect())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


@pytest.mark.parametrize("part", [0.0, 0.4, 1.0])
def test_colliding_keys_and_hot_texts(spark, monkeypatch, part):
    """Texts that share keys are told apart in their chain, whichever way their rows come to the owner."""
    monkeypatch.setattr(exact, "HOT_PART", part)
    monkeypatch.setattr(exact.F, "xxhash64", lambda c: F.length(c).cast("bigint") % 3)
    data = [(k, ("same" if k % 2 else f"t{k % 7}"), *[None] * 7) for k in range(60)]
    got = sorted(tuple(r) for r in exact.exact_duplicates(frame(spark, data)).select("id", "keep_id", "group_size").collect())
    groups = defaultdict(list)
    for r in data:
        groups[r[1]].append(r[0])
    assert got == sorted((i, max(g), len(g)) for g in groups.values() for i in g)


def test_directory_splits_only_overfull_buckets(spark):
    entries = spark.range(20000).select(F.xxhash64("id").alias("key"))
    cells, depth = exact.directory(entries, 1000, 8)
    assert depth < 8
    assert cells.count() == cells.select("cell").distinct().count() == 2 ** depth
    sizes = entries.withColumn("cell", exact._cell(F.col("key"), depth)).join(cells, "cell").groupBy("bucket").count().collect()
    assert max(r["count"] for r in sizes) <= 1000 and sum(r["count"] for r in sizes) == 20000
    assert exact.directory(entries, 10 ** 6, 8)[0].count() == 1
    assert exact.directory(entries, 1, 4)[0].count() == 16  # overfull at the largest depth: longer buckets


def plain_lines(docs):
    """Texts without repeated passages, chunk by chunk; docs: (id, text)."""
    import hashlib

    def spans(text):
        h = [int(hashlib.md5(s.encode()).hexdigest()[:7], 16) for s in text]
        roll = {1: [x % lines.PRIME for x in h], 2: [((h[k - 1] if k else 0) * lines.BASE + h[k]) % lines.PRIME for k in range(len(h))]}
        out = set()
        for window, bit in lines.CUTS:
            for side in (0, 1):
                begin = 0
                for k, v in enumerate(roll[window]):
                    if v >> bit & 1 == side or k == len(h) - 1:
                        if k - begin + 1 >= lines.MIN_LINES and words("\n".join(text[begin:k + 1])):
                            out.add((begin, k))
                        begin = k
        return sorted(out)
    texts = sorted({(i is not None, i, t) for i, t in docs if t is not None}, key=lambda x: (x[0], x[1] or 0))
    split = [(key[1:], key[2].split("\n")) for key in texts]
    counts = Counter("\n".join(t[a:b + 1]) for _, t in split for a, b in spans(t))
    seen, out = set(), {}
    for key, text in split:
        later, first = set(), set()
        for a, b in spans(text):
            body = "\n".join(text[a:b + 1])
            if counts[body] > 1:
                (later if body in seen else first).update(range(a, b + 1))
                seen.add(body)
        out[key] = "\n".join(s for k, s in enumerate(text) if k not in later - first)
    return [(i, None if t is None else out[(i, t)]) for i, t in docs]


def test_line_dedup_odd_documents(spark):
    data = [r for r in rows() if r[0] != 99]  # one text an id, so that the first occurrence is plain
    df = frame(spark, data)
    got = lines.dedup_lines(df)
    assert got.columns == [*df.columns, "n_gone"]
    want = plain_lines([r[:2] for r in data])
    assert order((r["doc_id"], r["text"]) for r in got.collect()) == order(want)
    assert all(r["n_chars"] is None if r["text"] is None else r["n_chars"] == len(r["text"]) for r in got.collect())
    assert lines.dedup_lines(frame(spark, [])).collect() == []


def test_shared_passage_goes_wherever_it_stands(spark):
    shared = prose(77, 200)
    data = [(k, prose(100 + k, 9 * (k + 1)) + "\n" + shared + "\n" + prose(200 + k, 30), None, None, None, None, None, None, None)
            for k in range(5)]
    got = {r["doc_id"]: r["text"] for r in lines.dedup_lines(frame(spark, data)).collect()}
    assert got[0] == data[0][1]
    for k in range(1, 5):
        assert len(got[k]) < len(data[k][1]) - 0.8 * len(shared)
        assert data[k][1].startswith(got[k].split("\n")[0])


def test_first_occurrences_stay_whole(spark):
    block = prose(8, 54).split("\n")
    data = [(k, "\n".join(block[k:k + 4]), None, None, None, None, None, None, None) for k in range(3)] + [
        (9, "same\n" * 12 + "end", None, None, None, None, None, None, None)]
    got = lines.dedup_lines(frame(spark, data)).collect()
    assert order((r["doc_id"], r["text"]) for r in got) == order(plain_lines([r[:2] for r in data]))
    left = [r["text"].split("\n") for r in got]
    assert {s for text in left for s in text} == {*block, "same", "end"}


def test_most_two_line_passages_go(spark):
    lone = lambda k, n: prose(1000 + k, 9 * n).split("\n")
    shared = [prose(5000 + k, 60, 30) for k in range(300)]
    data = [(k, "\n".join([*lone(k, 3), shared[k % 300], *lone(7000 + k, 3)]), None, None, None, None, None, None, None) for k in range(600)]
    got = {r["doc_id"]: r for r in lines.dedup_lines(frame(spark, data)).collect()}
    assert all(got[k]["n_gone"] == 0 for k in range(300))
    assert sum(got[k]["n_gone"] == 2 for k in range(300, 600)) >= 0.9 * 300


def test_chunks_of_one_digest_are_told_apart(spark, monkeypatch):
    data = [r for r in rows() if r[0] != 99]
    monkeypatch.setattr(lines, "digest", lambda keys: F.size(keys) % 2)
    got = lines.dedup_lines(frame(spark, data)).collect()
    assert order((r["doc_id"], r["text"]) for r in got) == order(plain_lines([r[:2] for r in data]))


def test_lines_that_share_a_key_are_found(spark, monkeypatch):
    texts = spark.createDataFrame([("a\nb\nb",), ("b\nc",)], "text string")
    asked = texts.select(F.explode(F.split("text", "\n")).alias("line")).select(F.xxhash64("line").alias("key"))
    assert lines.shared_keys(texts, "text", asked).collect() == []


@pytest.mark.parametrize("words_", [1, 64])
def test_a_full_bit_table_changes_nothing(spark, monkeypatch, words_):
    monkeypatch.setattr(lines, "TABLE_WORDS", words_)
    data = [r for r in rows() if r[0] != 99]
    got = lines.dedup_lines(frame(spark, data)).collect()
    assert order((r["doc_id"], r["text"]) for r in got) == order(plain_lines([r[:2] for r in data]))


def test_bit_table_holds_every_key(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("key"))
    other = spark.range(5000, 10000).select(F.xxhash64("id").alias("key"))
    assert lines.with_bit(keys, F.col("key"), lines.bit_table(keys), "x").where("x").count() == 5000
    assert lines.with_bit(other, F.col("key"), lines.bit_table(keys), "x").where("x").count() < 50
    assert lines.with_bit(keys, F.col("key"), lines.bit_table(keys.limit(0)), "x").where("x").count() == 0
