"""Columns that clash with working names, and stored maps that are used again."""

import pytest
from pyspark.sql import functions as F

from tallyscope.llm import language, sharding, simhash, suffixes, toxicity
from tests.llm.conftest import DOCUMENT


def wider(df, *names):
    return df.select("*", *[F.concat(F.lit("x"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(n) for n in names])


@pytest.mark.parametrize("name", ["doc_", "TH_", "spans_", "spans"])
def test_op10_keeps_columns_of_its_names(odd, name):
    out = suffixes.without_repeats(wider(odd, name))
    assert out.columns == [*odd.columns, name, "cut"]
    assert {r[name] for r in out.collect()} == {r[name] for r in wider(odd, name).collect()}


def test_op9_op7_and_near_copies_keep_columns_of_their_names(odd):
    told = language.with_language(wider(odd, "predicted_"), None)
    assert "predicted_" in told.columns
    assert "chain_" in toxicity.with_toxicity(wider(odd, "chain_"), None).columns
    kept = simhash.one_of_each(wider(odd, "row_key_", "first_"))
    assert kept.columns == [*odd.columns, "row_key_", "first_"] and all(r["row_key_"].startswith("x") for r in kept.collect())


def test_models_keep_columns_of_their_names(spark):
    docs = spark.createDataFrame([(i, ("good day to you " if i % 2 else "guten tag euch allen ") * 3, "en" if i % 2 else "de", "a", 0) for i in range(80)], DOCUMENT)
    out = language.identify(wider(docs, "predicted_"))
    assert "predicted_" in out.columns and {r["lang_pred"] for r in out.collect()} == {"en", "de"}
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(80)], "doc_id long, quality long, toxic long")
    assert "chain_" in toxicity.score(wider(docs, "chain_"), labels).columns


def test_op3_runs_again_on_an_empty_table_and_on_its_own_map(spark, none, place):
    for _ in range(2):
        assert sharding.shard_documents(none).count() == 0
        assert sharding.shard_documents(none, map_path=f"{place}/empty").count() == 0
    rows = [(i, "w " * (1 + i * 37 % 90), "en", "a", 0) for i in range(900)]
    docs, path = spark.createDataFrame(rows, DOCUMENT), f"{place}/map"
    first = {r["doc_id"]: r for r in sharding.shard_documents(docs, 4, 64, map_path=path).collect()}
    one = sharding.newest_map(spark, path)
    again = {r["doc_id"]: r for r in sharding.shard_documents(docs, 4, 64, map_path=path).collect()}
    assert again == first and sharding.newest_map(spark, path) == one  # nothing to edit
    more = spark.createDataFrame(rows + [(900 + i, "v " * (i % 400), "en", "a", 0) for i in range(300)], DOCUMENT)
    sharding.shard_documents(more, 4, 64, map_path=path).count()
    two = sharding.newest_map(spark, path)
    assert two.version == one.version + 1
    sums = {}
    for r in sharding.shard_documents(more, 4, 64, map_path=path).collect():
        assert r["shard"] == two.shard[r["virtual_slot"]]
        sums[r["shard"]] = sums.get(r["shard"], 0) + r["size"]
    # edits move a slot only where that narrows the spread, so few slots move
    assert max(sums.values()) - min(sums.values()) < 0.02 * sum(sums.values())
    assert sum(a != b for a, b in zip(one.shard, two.shard)) < 32
    with pytest.raises(ValueError):
        sharding.shard_documents(more, 5, 64, map_path=path)


def test_places_and_sums_against_plain_counting(spark):
    rows = [(i % 150 if i % 7 else None, f"t{i % 40} " * (i % 13), "en", "a", 0) for i in range(500)]
    out = sharding.shard_documents(spark.createDataFrame(rows, DOCUMENT), 5, 32).collect()
    assert sorted((str(r["doc_id"]), r["size"]) for r in out) == sorted((str(d), len(t.encode()) + 1) for d, t, *_ in rows)
    for shard in range(5):
        own = [r for r in out if r["shard"] == shard]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        # slots follow each other; inside one, records go by id, checksum and size
        order = sorted(own, key=lambda r: (r["virtual_slot"], r["doc_id"] is not None, r["doc_id"] or 0, r["text_crc32"], r["size"]))
        assert [r["slot"] for r in order] == list(range(len(own)))
