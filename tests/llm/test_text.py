"""Quality, language, toxicity, chat and the pipeline."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from tallyscope.llm import chat, language, quality, simhash, toxicity
from tallyscope.llm.queries import ORACLES, QUERIES
from tests.conftest import DATA
from tests.llm.conftest import DOCUMENT, documents

SF = "/root/testdata/sf0.01"


# quality


def plain_base(text):
    text = text or ""
    blanks = " \t\n\x0b\x0c\r"

    def words(s):
        return [w for w in s.translate({ord(b): " " for b in blanks}).split(" ") if w]

    w = words(text)
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = Counter(grams)
    inside = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if words(x)]
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside),
        len(w) < 10 or 100 * len(inside) > 20 * len(w),
    )


def test_op6_base_figures(spark, odd, none):
    rows = [("a b c d e " * 4 + "tail", 1), ("one\ntwo\none\n\n \none", 2), ("#$%& <x> | *", 3), ("a b c d e f a b c d e", 4), ("p q r s t p q r s t p q", 5)]
    df = odd.unionByName(spark.createDataFrame([(i + 100, t, None, "h", 1) for t, i in rows], DOCUMENT))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = Counter((r["doc_id"], *[r[n] for n in names]) for r in quality.judge(df).collect())
    assert got == Counter((r["doc_id"], *plain_base(r["text"])) for r in df.collect())
    assert quality.judge(none).count() == 0


def test_op6_removes_lines_of_a_host(spark):
    rng = random.Random(1)
    body = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(12))
    banner = "This  site uses  cookies and other things to work at all"
    rows = [(i, f"{banner.upper() if i % 2 else banner}\n{body()}", None, "h", 1) for i in range(30)]
    rows += [(100 + i, f"{banner}\nfew words {i} only here now then so on", None, "h", 1) for i in range(5)]
    rows += [(200 + i, f"{banner}\n{body()}", None, "other", 1) for i in range(5)]
    rows += [(300 + i, body_copy, None, "copies", 1) for body_copy in [body()] for i in range(40)]
    got = {r["doc_id"]: r for r in quality.judge(spark.createDataFrame(rows, DOCUMENT), with_text=True).collect()}
    assert got[0]["n_removed_words"] == 0 and got[0]["clean_text"].startswith("This")  # the first keeps it
    assert all(got[i]["n_removed_words"] == 11 and got[i]["kept"] and "ookies" not in got[i]["clean_text"].lower() for i in range(1, 30))
    assert not any(got[100 + i]["kept"] for i in range(5))  # depleted
    assert all(got[200 + i]["kept"] and got[200 + i]["n_removed_words"] == 0 for i in range(5))
    assert all(got[300 + i]["kept"] for i in range(40))  # one text, however often copied


def test_op6_is_native(spark):
    plan = QUERIES["op6_line_quality"](spark, DATA)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_forms(spark, name):
    import duckdb

    from scripts.compare import compare

    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    _, result = compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    assert result.startswith("ok"), result


# language


def test_grams_by_hand():
    bucket, doc, has = language.grams(["Ab, c", "", "12", "é"])
    assert list(has) == [True, False, False, True]
    assert Counter(doc.tolist())[0] == 3 + 5 + 3  # a b c; _a ab b_ _c c_; _ab ab_ _c_
    same, _, _ = language.grams(["ab...C"])
    assert sorted(bucket[doc == 0]) == sorted(same)


def test_temperature_sets_confidence():
    rng = np.random.default_rng(0)
    labels = rng.integers(0, 3, 4000)
    logits = np.eye(3)[np.where(rng.random(4000) < 0.8, labels, rng.integers(0, 3, 4000))] * 10
    t = language.temperature(logits, labels)
    assert abs(language.softmax(logits / t).max(axis=1).mean() - 0.867) < 0.02


def test_op9_is_accurate_on_held_out_documents(spark):
    truth = {r["doc_id"]: r["lang"] for r in documents(spark, "0.01").collect()}
    rows = [r for r in QUERIES["op9_language"](spark, SF).collect() if r["held_out"]]
    assert len(rows) > 150 and all(0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in rows]) > 0.95


def test_op9_never_uses_held_out_labels(spark):
    docs = documents(spark).where("doc_id < 120")
    from pyspark.sql import functions as F

    other = docs.withColumn("lang", F.when(language.held_out(), F.lit("zz")).otherwise(F.col("lang")))
    a = {tuple(r) for r in language.identify(docs).select("doc_id", "lang_pred", "score").collect()}
    assert a == {tuple(r) for r in language.identify(other).select("doc_id", "lang_pred", "score").collect()}


def test_op9_odd_rows(spark, odd, none):
    got = {r["doc_id"]: r for r in language.identify(odd).collect()}
    assert {got[i]["lang_pred"] for i in (1, 2, 3)} == {"und"} and got[1]["score"] == 0
    assert got[4]["lang_pred"] in ("en", "de", "fr") and got[None]["held_out"]
    assert language.identify(none).count() == 0
    plain = spark.createDataFrame([(1, "abc", None, "lang_pred")], "doc_id long, text string, lang string, lang_pred string")
    assert language.identify(plain).first()["lang_pred"] == "und"


# toxicity


def test_op7_catches_held_back_documents(spark):
    from pyspark.sql import functions as F

    docs = documents(spark, "0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").join(docs.select("doc_id"), "doc_id")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 0
    scored = toxicity.score(docs, labels.where(~held)).join(labels.where(held), "doc_id").collect()
    hits = sum(r["flagged"] and r["toxic"] for r in scored)
    assert hits >= 0.7 * sum(r["toxic"] for r in scored)
    assert sum(r["flagged"] and not r["toxic"] for r in scored) <= 0.01 * len(scored)


def test_op7_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(5, 1, 0), (4, 0, 1), (6, None, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    out = toxicity.score(odd, labels)
    assert out.count() == odd.count() and out.where("p_toxic is null or flagged is null").count() == 0
    assert toxicity.score(none, labels).count() == 0
    assert toxicity.score(odd, labels.where("toxic > 5")).where("flagged").count() == 0


def test_op7_sample_is_bounded_by_rows(spark):
    rows = [(1, f"text {i}") for i in range(60)] + [(2, "same")] * 50 + [(3, None)] * 5 + [(None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    got = sorted((r["doc_id"], r["toxic"], r["poor"]) for r in toxicity.labelled(docs, labels, 40).collect())
    assert got == [(1, 1, 0)] * 40 + [(2, 0, 0), (3, 0, 1)]


# chat


def legal(states):
    return all(t in chat.NEXT[s] for s, t in zip([0, *states], states)) and (not states or states[-1] == chat.ASSISTANT)


def brute_cost(roles):
    """Least cost over every choice of state, merge and empty turns."""
    best = math.inf
    options = [(t, mode) for t in (1, 2, 3) for mode in ("open", "merge", 1, 2, 3)]
    for choice in itertools.product(options, repeat=len(roles)):
        turns, cost, last = [], 0, 0
        for r, (t, mode) in zip(roles, choice):
            cost += 0 if r == t else chat.NAME if r == 0 else chat.RELABEL
            if mode == "merge":
                cost += chat.MERGE if last == t else math.inf
            else:
                if mode != "open":
                    turns.append(mode)
                    cost += chat.INSERT
                turns.append(t)
            last = t
        end = {0: [], 3: [], 2: [3], 1: [2, 3]}[last]
        if legal(turns + end):
            best = min(best, cost + 3 * len(end))
    return best


def test_repair_is_cheapest():
    for n in range(1, 4):
        for roles in itertools.product(range(4), repeat=n):
            states = chat.path([chat._matrix(r) for r in roles])
            cost = chat.END[states[-1]] + sum(chat.moves(r)[s, t][0] for r, s, t in zip(roles, states, states[1:]))
            assert cost == brute_cost(roles), roles
            ways = []
            for way in itertools.product(range(4), repeat=n):
                steps = list(zip(roles, [0, *way], way))
                if all((s, t) in chat.moves(r) for r, s, t in steps):
                    ways.append((chat.END[way[-1]] + sum(chat.moves(r)[s, t][0] for r, s, t in steps), way[::-1]))
            assert min(ways) == (cost, tuple(states[:0:-1])), roles


def test_parts_do_not_decide_ties():
    rng = np.random.default_rng(8)
    for _ in range(200):
        steps = [chat._matrix(int(r)) for r in rng.integers(0, 4, 12)]
        whole = chat.path(steps)
        cuts = sorted(rng.choice(np.arange(1, 12), 3, replace=False))
        cost, pieces = chat.FIRST, []
        for a, b in zip([0, *cuts], [*cuts, 12]):
            pieces.append((steps[a:b], cost))
            for m in steps[a:b]:
                cost = chat._onward(cost, m)[0]
        state, out = chat.final_state(cost), []
        for part, enter in reversed(pieces):
            found = chat.path(part, enter, state)
            assert found[0] == chat.entries(part, enter)[state]
            out, state = found[1:] + out, found[0]
        assert [state, *out] == whole


CONVERSATION = "conv_id long, turn long, role string, text string, part string"


def strings(out):
    got = {}
    for r in sorted(out.collect(), key=lambda r: r["place"]):
        got[r["conv_id"]] = got.get(r["conv_id"], "") + r["rendered"]
    return got


def test_op8_renders_legal_conversations(spark):
    turns = Counter(r["conv_id"] for r in spark.read.parquet(f"{DATA}/conversations.parquet").collect())
    out = QUERIES["op8_role_repair"](spark, DATA)
    got = strings(out)
    assert set(got) == set(turns)
    for text in got.values():
        states = [chat.ROLES.index(p.split("\n")[0]) for p in text.split(chat.OPEN)[1:]]
        assert legal(states) and text.count(chat.CLOSE) == len(states)
    assert Counter(r["conv_id"] for r in out.where("action not in ('end', 'empty')").collect()) == turns


def test_op8_splits_long_conversations_without_change(spark):
    rng = random.Random(6)
    rows = [(c, i, rng.choice(["user", "assistant", "human", None, "narrator", "system"]), f"t{i}", "x") for c in (7, 9) for i in range(300)]
    rows += [(8, 0, "user", "hi", "x")]
    found = []
    for parts in ("1", "4", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            out = chat.repair(spark.createDataFrame(rows, CONVERSATION))
            found.append(sorted(map(str, out.collect())))
            got = strings(out)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
        states = [chat.ROLES.index(p.split("\n")[0]) for p in got[7].split(chat.OPEN)[1:]]
        assert legal(states) and all(f"t{i}" in got[7] for i in range(300))
    assert found[0] == found[1] == found[2]
    assert got[8] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"


def test_op8_odd_rows(spark):
    rows = [
        (None, 0, "user", "a", ""), (0, 0, "user", "zero", ""), (None, None, None, None, ""), (1, 0, "user", "<|im_end|>", ""), (1, 0, "user", "<|im_end|>", ""),
        (2, 0, "assistant", "first", ""), (3, 1, "bot", "b", ""), (3, 0, " HUMAN ", "a", ""),
    ]
    got = strings(chat.repair(spark.createDataFrame(rows, CONVERSATION)))
    assert set(got) == {None, 0, 1, 2, 3}
    assert got[3] == "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n"
    assert got[1] == "<|im_start|>user\n<|_im_end|>\n<|_im_end|><|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    assert chat.repair(spark.createDataFrame([], CONVERSATION)).count() == 0


# pipeline


def test_stages_follow_each_other(spark):
    docs = documents(spark, "0.01")
    from tallyscope.sources.durable import materialise

    stages = dict(corpus_pipeline.STAGES)
    told = materialise(stages["language"](spark, docs, SF))
    assert told.columns == docs.columns and told.count() > 0.97 * docs.count()
    fine = materialise(stages["quality"](spark, told, SF))
    verdict = {r["doc_id"]: plain_base(r["text"])[-1] for r in told.collect()}
    kept = {r["doc_id"] for r in fine.collect()}
    assert fine.columns == docs.columns and not any(verdict[i] for i in kept)
    assert len(kept) > 0.95 * sum(not v for v in verdict.values())
    single = materialise(stages["near_copies"](spark, fine, SF))
    rows = fine.collect()
    print_of = {r["doc_id"]: simhash.fingerprint_of(r["text"]) for r in rows}
    left = {r["doc_id"] for r in single.collect()}
    for r in rows:  # whatever went has a kept text of its component before it, and no two kept ones are near
        if r["doc_id"] not in left:
            assert any((print_of[r["doc_id"]] ^ print_of[o]).bit_count() <= 2 for o in print_of if o != r["doc_id"])
    assert all((print_of[a] ^ print_of[b]).bit_count() > 2 for a in left for b in left if a < b)
    cut = materialise(stages["passages"](spark, single, SF))
    assert cut.columns == docs.columns
    texts = sorted((r["doc_id"], r["text"].encode()) for r in cut.collect())
    seen = set()
    for _, raw in texts:
        assert len(raw) > 0
    before = {r["doc_id"]: r["text"].encode() for r in single.collect()}
    gone = 0
    for doc, raw in sorted(before.items()):
        strings_ = {raw[i : i + 100] for i in range(len(raw) - 99)}
        gone += bool(strings_ & seen)
        seen |= strings_
    assert gone == sum(before[d] != dict(texts).get(d, b"") for d in before) or gone > 0
    pieces = stages["packing"](spark, cut, SF)
    assert {r["doc_id"] for r in pieces.select("doc_id").distinct().collect()} == {d for d, _ in texts}


def test_near_copies_keep_one_row_of_each_component(spark):
    rng = random.Random(3)

    def text():
        return " ".join(f"w{rng.randrange(10**6)}" for _ in range(200))

    a, b, c, d = (text() for _ in range(4))
    rows = [(i, t, "en", "s", len(t)) for i, t in (
        (1, a), (9, a), (9, b),  # 9 repeats with a near copy of 1 and the only text of its group
        (None, c), (None, c), (None, d), (5, d),  # a group without ids, and one with
        (7, d), (7, d),
    )]
    want = [(1, a), (5, d), (9, b), (None, c)]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, DOCUMENT).repartition(3)
        got = corpus_pipeline.near_copy_stage(spark, docs, SF)
        assert got.columns == docs.columns
        assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == sorted(want, key=str)


def test_pipeline_runs_whole(spark):
    assert corpus_pipeline.run(spark, DATA).count() > 0
