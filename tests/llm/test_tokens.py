"""BPE, packing and sharding against the tokenizers library and plain counting."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyscope.llm import bytepairs, packing, sharding
from tallyscope.llm.queries import BYTE_VOCABULARY, QUERIES, WORD_VOCABULARY, vocabulary
from tests.conftest import DATA
from tests.llm.conftest import documents

pytest.importorskip("tokenizers")


def library(name):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary(name))
    t.no_padding()
    t.no_truncation()
    return t


def _expected(rows):
    t = library(BYTE_VOCABULARY)
    out = []
    for r in rows:
        ids = t.encode(r["text"] or "", add_special_tokens=False).ids
        text = t.decode(ids, skip_special_tokens=False)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.append((r["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(text)))
    return Counter(out)


def test_op2_equals_the_library(spark):
    got = Counter(tuple(r) for r in QUERIES["op2_byte_pairs"](spark, DATA).collect())
    assert got == _expected(documents(spark).collect())


def test_op2_odd_rows(spark, odd, none):
    out = bytepairs.encode_decode(odd, vocabulary(BYTE_VOCABULARY))
    got = Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in out.collect())
    assert got == _expected(odd.collect())
    row = out.where("doc_id = 8").first()
    assert 50256 in row["ids"] and row["decoded"] == "été 12345 \x00 <|endoftext|> end"
    assert bytepairs.encode_decode(none, vocabulary(BYTE_VOCABULARY)).count() == 0


def test_simultaneous_merges_are_exact():
    """A merge round joins all occurrences at once; right as no token is made after a merge that uses it."""
    import json

    with open(vocabulary(BYTE_VOCABULARY)) as f:
        merges = json.load(f)["model"]["merges"]
    made = {a + b: i for i, (a, b) in enumerate(merges)}
    assert all(made.get(x, -1) < i for i, pair in enumerate(merges) for x in pair)


def test_words_of_unusual_texts():
    t = library(BYTE_VOCABULARY)
    texts = ["a  b", " x", "x ", "\n\n a", "it's we'll 'tis", "aaaaaaa" * 50, "日本語 テスト", "a b  c", "1²½", "", "<|endoftext|><|endoftext|> a"]
    got = bytepairs.Encoder(vocabulary(BYTE_VOCABULARY)).encode(texts)
    assert [list(g) for g in got] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def _check_packing(rows, out):
    t = library(WORD_VOCABULARY)
    want = Counter()
    for r in rows:
        ids = [*t.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        start = 0
        for k in packing.binary_lengths(len(ids)):
            want[r["doc_id"], start, k, zlib.crc32(np.array(ids[start : start + k], "<u4").tobytes()), len(ids)] += 1
            start += k
        assert start == len(ids)
    got = Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in out)
    assert got == want
    assert len({r["sequence_id"] for r in out}) == len(out)
    assert all(r["offset"] == 0 and 1 << r["bucket"] == r["length"] <= 4096 for r in out)


def test_op4_equals_the_library(spark):
    _check_packing(documents(spark).collect(), QUERIES["op4_binary_pieces"](spark, DATA).collect())


def test_op4_odd_rows(spark, odd, none):
    out = packing.pack(odd, vocabulary(WORD_VOCABULARY))
    _check_packing(odd.collect(), out.collect())
    assert all(len(r["ids"]) == r["length"] for r in out.collect())
    assert packing.pack(none, vocabulary(WORD_VOCABULARY)).count() == 0


def test_op4_buckets_on_disk(spark, odd, place):
    packing.write_buckets(packing.pack(odd, vocabulary(WORD_VOCABULARY)), f"{place}/b")
    assert spark.read.parquet(f"{place}/b").where("length <> shiftleft(1, bucket)").count() == 0


def _check_shards(rows, out, slack):
    want = Counter((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in rows)
    assert want == Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out)
    places, sizes = defaultdict(list), defaultdict(int)
    for r in out:
        places[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
        assert 0 <= r["shard"] < 16 and r["law"] == "bytes" and r["grown_shard"] is None
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    if slack:
        assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(16)) <= slack


def test_op3_is_near_equal(spark):
    rows = documents(spark, "0.01").collect()
    _check_shards(rows, QUERIES["op3_slot_shards"](spark, "/root/testdata/sf0.01").collect(), 200)


def test_op3_odd_rows(spark, odd, none):
    _check_shards(odd.collect(), sharding.shard_documents(odd).collect(), 0)
    assert sharding.shard_documents(none).count() == 0


def test_op3_levels_copies_of_one_key(spark):
    rows = [(7 if i % 3 == 0 else i, f"text {i} " * 20) for i in range(3000)] + [(None, "the same text " * 10)] * 1000
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = sharding.shard_documents(docs).collect()
    _check_shards(docs.collect(), out, 400)
    assert max(Counter(r["virtual_slot"] for r in out).values()) < 20


def test_maps_are_versions(spark, place):
    first = sharding.first_map(4, 64)
    size = np.arange(64.0)
    second = sharding.rebalance(first, size)
    load = np.bincount(second.shard, weights=size)
    assert load.max() - load.min() <= 1
    third = sharding.grow(second)
    moved = [(a, b) for a, b in zip(second.shard, third.shard) if a != b]
    assert moved and {b for _, b in moved} == {4} and len(moved) <= 64 // 5
    for m in (first, second, third):
        sharding.save_map(spark, place + "/map", m)
    assert sharding.load_map(spark, place + "/map", 1) == second and sharding.load_map(spark, place + "/map", 2) == third
    assert sum(a != b for a, b in zip(first.shard, sharding.rebalance(first, size, max_edits=1).shard)) <= 2
