import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from metricwatch.llm import packing, queries, sharding
from tests.llm.data import frame, prose, rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def encoder():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(queries.tokenizer_path())


def ids_of(encoder, text):
    return encoder.encode(text or "", add_special_tokens=False).ids + [0]


def best_fit_bins(lengths, capacity):
    """Best-fit decreasing, bin by bin."""
    bins = []
    for n in sorted(lengths, reverse=True):
        open_bins = [k for k, left in enumerate(bins) if left >= n]
        if open_bins:
            k = min(open_bins, key=lambda k: bins[k])
            bins[k] -= n
        else:
            bins.append(capacity - n)
    return len(bins)


def check_packed(found, docs, encoder, capacity):
    pieces = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found)
    want = []
    for doc, text in docs:
        ids = ids_of(encoder, text)
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at:at + capacity], "<u4").tobytes()
            want.append((-1 if doc is None else doc, k, at, len(part) // 4, zlib.crc32(part)))
    assert pieces == sorted(want)
    held = defaultdict(list)
    for r in found:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(held) == best_fit_bins([w[3] for w in want], capacity)


def test_packing_query_against_brute_force(spark, encoder):
    found = queries.op1_best_fit_packing(spark, SF).collect()
    docs = [(r[0], r[1]) for r in queries.documents(spark, SF).select("doc_id", "text").collect()]
    check_packed(found, docs, encoder, queries.CAPACITY)


@pytest.mark.parametrize("capacity", [7, 64, 2048])
def test_packing_odd_documents(spark, encoder, capacity):
    out = packing.packed_documents(frame(spark), queries.tokenizer_path(), capacity, with_ids=True).withColumnRenamed("id", "doc_id")
    found = out.collect()
    check_packed(found, [r[:2] for r in rows()], encoder, capacity)
    made = {r["sequence_id"]: r for r in packing.sequences(out).collect()}
    assert sum(len(r["ids"]) for r in made.values()) == sum(len(ids_of(encoder, r[1])) for r in rows())
    assert all(sum(r["lengths"]) == len(r["ids"]) <= capacity for r in made.values())


def test_packing_empty_table(spark):
    out = packing.packed_documents(frame(spark, []), queries.tokenizer_path())
    assert out.collect() == [] and out.columns[-2:] == ["sequence_id", "offset"]


def test_words_are_tokenized_like_whole_texts(encoder):
    tok = packing.WordTokenizer(queries.tokenizer_path())
    assert tok.by_words
    texts = [r[1] or "" for r in rows()] + ["a\x1cb c", "x\xa0y", "don't it's <|endoftext|> foo<|startoftext|>bar", "ΑΣ Σ ﬁ İ", "a\x85b ̈x",
                                            "...,, a.b,c. 12,3", "ＡＢ　c"]
    for text in texts:
        assert tok.encode(text) == np.array(encoder.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text[:40]


def test_files_of_other_rules_are_encoded_whole(encoder):
    import json

    import public_tokenizers
    from tokenizers import Tokenizer
    spec = json.load(open(queries.tokenizer_path()))
    assert packing.has_word_rules(spec)
    for change in ({"normalizer": None}, {"model": spec["model"] | {"byte_fallback": True}}, {"truncation": {}},
                   {"added_tokens": [{"content": "the"}]}, {"added_tokens": [{"content": "<|a b|>"}]}):
        assert not packing.has_word_rules(spec | change)
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok, other, text = packing.WordTokenizer(path), Tokenizer.from_file(path), "The  cat sat,\n on Été \u3000 mats."
    assert not tok.by_words and tok.encode(text) == np.array(other.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_special_strings_in_texts(encoder):
    tok = packing.WordTokenizer(queries.tokenizer_path())
    for text in ("a <|endoftext|> b", "x<|startoftext|>y", "<|endoftext|><|endoftext|>", "the<|end"):
        assert tok.encode(text) == np.array(encoder.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_remembered_words_are_bounded(monkeypatch, encoder):
    monkeypatch.setattr(packing, "REMEMBERED_WORDS", 5)
    tok, text = packing.WordTokenizer(queries.tokenizer_path()), prose(8, 300)
    assert tok.encode(text) == np.array(encoder.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert len(tok) <= 5


def test_plan_over_histogram_equals_document_by_document():
    rng = np.random.default_rng(3)
    for _ in range(20):
        lengths = np.minimum(50, rng.integers(1, 60, 200))
        steps = packing.best_fit_plan(dict(zip(*map(np.ndarray.tolist, np.unique(lengths, return_counts=True)))), 50)
        assert int((steps[:, 2]).max()) + 1 <= best_fit_bins(lengths.tolist(), 50) <= len(lengths)


def check_shards(found, docs, shards):
    assert len(found) == len(docs)
    by_text = defaultdict(set)
    for r in found:
        by_text[(r["text_crc32"], r["size"])].add(r["shard"])
    assert all(len(s) == 1 for s in by_text.values())
    want = sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t in docs)
    assert sorted((r["size"], r["text_crc32"]) for r in found) == want
    slots, loads = defaultdict(list), defaultdict(int)
    for r in found:
        slots[r["shard"]].append(r["slot"])
        loads[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    return loads, by_text


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_sharding_query_is_near_equal(spark, size):
    found = queries.op4_sharding(spark, f"/root/testdata/{size}").collect()
    docs = [tuple(r) for r in queries.documents(spark, f"/root/testdata/{size}").select("doc_id", "text").collect()]
    loads, _ = check_shards(found, docs, 40)
    share = sum(loads.values()) / 40
    assert len(loads) == 40 and max(loads.values()) < 1.005 * share and min(loads.values()) > 0.995 * share


def test_sharding_odd_documents(spark):
    found = [r.asDict() for r in sharding.shard_rows(frame(spark), 4).collect()]
    check_shards(found, [r[:2] for r in rows()], 4)
    assert sharding.shard_rows(frame(spark, []), 4).collect() == []


def test_groups_above_a_share_stand_alone(spark):
    data = [(k, "copy " * 50, *[None] * 7) for k in range(60)] + [(100 + k, f"text {k} " * 5, *[None] * 7) for k in range(120)]
    found = [r.asDict() for r in sharding.shard_rows(frame(spark, data), 5).collect()]
    loads, _ = check_shards(found, [r[:2] for r in data], 5)
    alone = {r["shard"] for r in found if r["id"] < 100}
    rest = [v for k, v in loads.items() if k not in alone]
    assert len(alone) == 1 and len(rest) == 4 and max(rest) - min(rest) <= 2 * 60
    assert all(r["id"] < 100 for r in found if r["shard"] in alone)


def test_shards_of_a_fixed_capacity(spark):
    data = [(k, "x" * (40 + 13 * k), *[None] * 7) for k in range(70)] + [(900, "y" * 5000, *[None] * 7)]
    found = [r.asDict() for r in sharding.shard_rows(frame(spark, data), capacity=2000).collect()]
    loads, _ = check_shards(found, [r[:2] for r in data], 10 ** 6)
    sizes = sorted((len(r[1]) + 16 for r in data[:-1]), reverse=True)
    assert len(loads) == best_fit_bins(sizes, 2000) + 1
    assert sorted(loads.values())[-1] == 5016 and sorted(loads.values())[-2] <= 2000


def plain_steps(classes, capacity, most=None):
    """Best-fit decreasing, group by group over a list of bins."""
    bins, out = [], []
    for name, size, n in classes:
        for rank in range(n):
            room = [(r, k) for k, r in enumerate(bins) if r >= size]
            if not room:
                if len(bins) == most or size > capacity:
                    return None
                bins.append(capacity)
                room = [(capacity, len(bins) - 1)]
            k = min(room)[1]
            bins[k] -= size
            out.append((name, rank, k))
    return out


def test_steps_are_best_fit():
    rng = np.random.default_rng(5)
    for _ in range(40):
        sizes = np.unique(rng.integers(1, 90, 30))[::-1].tolist()
        classes = [[s, s, int(rng.integers(1, 6))] for s in sizes]
        for most in (None, 12):
            got, want = sharding.best_fit_steps(classes, 100, most), plain_steps(classes, 100, most)
            assert (got is None) == (want is None)
            if got:
                runs = dict(((c, r), k) for c, r, k in got)
                at = {}
                for c, r, k in want:
                    at[c] = runs.get((c, r), at.get(c))
                    assert at[c] == k


@pytest.mark.parametrize("size", [1, 5, 4095, 4096, 4097, 5000, 10 ** 6 + 17, 10 ** 13 + 5])
def test_size_classes(spark, size):
    got = spark.range(1).select(sharding.size_class(F.lit(size).cast("bigint"))).head()[0]
    assert got <= size < got * (1 + 2 ** -10) + 1 and (got == size or size > sharding.EXACT)
