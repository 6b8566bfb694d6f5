"""Toxicity by a chain of linear classifiers."""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyscope.llm.rows import unused
from tallyscope.sources.durable import materialise

BUCKETS = 1 << 18
FOLDS = 3
SAMPLE_PER_CLASS = 5000
THRESHOLD = 0.5
#: in chain order; each is a label of its own and a hint to the later ones
CATEGORIES = ("poor", "toxic", "toxic_poor")

ALPHA, BETA, L1, L2, EPOCHS, BATCH = 0.5, 1.0, 4.0, 0.1, 6, 32
_PLAIN = bytes(b if chr(b).isalnum() or b >= 128 else 32 for b in range(256))


def words(text: str | None) -> np.ndarray:
    """Buckets of the distinct words of a whole text and of their beginnings of 4 and 5 bytes."""
    found = set((text or "").lower().encode("utf-8", "surrogatepass").translate(_PLAIN).split())
    found |= {b"4" + w[:4] for w in found if len(w) > 3} | {b"5" + w[:5] for w in found if len(w) > 4}
    return np.unique(np.fromiter(map(crc32, found), dtype=np.int64, count=len(found)) % BUCKETS)


def labelled(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """Texts with the categories of :data:`CATEGORIES`, from labels (doc_id, quality, toxic).

    At most ``per_class`` rows of each value of toxic: this bound is the
    documented sample. Ids are chosen among the labels, the first by hash, and
    stored. Of their rows those equal in id and text count once, and the bound
    is applied again, by hash of id and text, as an id may have many texts.
    """
    marks = labels.where(F.col("toxic").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"), F.min("quality").alias("quality")
    )
    marks = marks.select(
        "doc_id", (F.col("quality") == 0).cast("int").alias("poor"), F.col("toxic").cast("int").alias("toxic"),
        ((F.col("toxic") == 1) & (F.col("quality") == 0)).cast("int").alias("toxic_poor"),
    )
    first = F.row_number().over(Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id"))
    marks = materialise(marks.withColumn("place_", first).where(F.col("place_") <= per_class).drop("place_"), "marks")
    text_hash = F.sha2(F.col("text").cast("binary"), 256)
    rows = docs.select("doc_id", "text").join(marks, "doc_id").withColumn("hash_", text_hash).dropDuplicates(["doc_id", "hash_"])
    first = F.row_number().over(Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id", "hash_"), "doc_id", "hash_"))
    return rows.withColumn("place_", first).where(F.col("place_") <= per_class).drop("place_", "hash_")


def train_one(rows: list[np.ndarray], extra: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic weights over buckets, then over ``extra`` columns, then the bias; FTRL in small batches."""
    n_extra = extra.shape[1]
    size = BUCKETS + n_extra + 1
    z, n = np.zeros(size), np.zeros(size)
    side = np.arange(BUCKETS, size)

    def weights(i):
        return -np.sign(z[i]) * np.maximum(np.abs(z[i]) - L1 * (i < BUCKETS), 0) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)

    for _ in range(EPOCHS):
        for at in range(0, len(rows), BATCH):
            part = rows[at : at + BATCH]
            flat = np.concatenate(part)
            doc = np.repeat(np.arange(len(part)), [len(r) for r in part])
            used, inverse = np.unique(flat, return_inverse=True)
            w, ws = weights(used), weights(side)
            x = np.column_stack([extra[at : at + BATCH], np.ones(len(part))])
            margin = np.bincount(doc, weights=w[inverse], minlength=len(part)) + x @ ws
            error = 1 / (1 + np.exp(-margin.clip(-30, 30))) - y[at : at + BATCH]
            for i, w_, g in (
                (used, w, np.bincount(inverse, weights=error[doc], minlength=len(used))), (side, ws, x.T @ error),
            ):
                z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA * w_
                n[i] += g * g
    return weights(np.arange(size))


def apply_one(w: np.ndarray, rows: list[np.ndarray], extra: np.ndarray) -> np.ndarray:
    base = np.array([w[r].sum() for r in rows])
    margin = base + extra @ w[BUCKETS:-1] + w[-1]
    return 1 / (1 + np.exp(-margin.clip(-30, 30)))


def _trainer(category: str):
    """Task of one fold: train without it and predict it; task ``FOLDS`` trains on all."""
    def train(frame: pd.DataFrame) -> pd.DataFrame:
        task = int(frame["task"].iloc[0])
        frame = frame.sort_values(["order_", "doc_id"], kind="stable")
        held = (frame["fold"] == task).to_numpy()
        bags = [np.asarray(w) for w in frame["words"]]
        extra = np.array([list(k) for k in frame["known"]], dtype=float).reshape(len(frame), -1)
        y = frame[category].to_numpy(dtype=float)[~held]
        w = train_one([b for b, h in zip(bags, held, strict=True) if not h], extra[~held], y)
        if task == FOLDS:
            return pd.DataFrame({"doc_id": [None], "order_": [None], "p": [None], "weights": [w.astype("<f8").tobytes()]})
        p = apply_one(w, [b for b, h in zip(bags, held, strict=True) if h], extra[held])
        return pd.DataFrame({"doc_id": frame["doc_id"][held], "order_": frame["order_"][held], "p": p, "weights": None})

    return train


def fit(samples: DataFrame, categories: tuple[str, ...] = CATEGORIES) -> list[np.ndarray] | None:
    """Weights of the chain, one vector a category; None without labelled rows.

    ``samples`` has doc_id, text and the category columns and is bounded, as
    :func:`labelled` returns it. For each category one task a fold trains on the
    other folds and predicts its own, and one task trains on all; its inputs
    are the words and the out-of-fold probabilities of earlier categories, so
    later models see inputs like those of unseen documents.
    """

    def features(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id").cast(pa.int64()),
                    "order_": pa.array([crc32((t or "").encode("utf-8", "surrogatepass")) for t in texts], pa.int64()),
                    "words": pa.array([words(t) for t in texts], pa.list_(pa.int64())),
                    **{c: batch.column(c).cast(pa.int32()) for c in categories},
                }
            )

    schema = "doc_id long, order_ long, words array<long>, " + ", ".join(f"{c} int" for c in categories)
    rows = samples.select("doc_id", "text", *categories).mapInArrow(features, schema)
    # a text keeps to one fold, or its copies would give its label away
    rows = materialise(rows.withColumn("fold", (F.col("order_") % FOLDS).cast("int")), "sample")
    chain: list[np.ndarray] = []
    known = rows.withColumn("known", F.array().cast("array<double>"))
    for c in categories:
        tasks = known.withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(FOLDS))))
        done = materialise(
            tasks.groupBy("task").applyInPandas(_trainer(c), "doc_id long, order_ long, p double, weights binary"), "chain"
        )
        got = done.where("weights is not null").collect()
        if not got:
            return None
        chain.append(np.frombuffer(got[0]["weights"], dtype="<f8"))
        oof = done.where("weights is null").groupBy("doc_id", "order_").agg(F.max("p").alias("p"))
        known = materialise(
            known.join(oof, ["doc_id", "order_"]).withColumn("known", F.concat("known", F.array("p"))).drop("p"), "known"
        )
    return chain


def with_toxicity(docs: DataFrame, chain: list[np.ndarray] | None, categories: tuple[str, ...] = CATEGORIES) -> DataFrame:
    """``docs`` with a probability ``p_<category>`` each, and ``flagged``: p_toxic at or above the threshold.

    Null or empty text: the probabilities of a text without words. Without a
    chain (nothing labelled) probabilities are 0 and nothing is flagged. Repeated
    rows get equal results; an empty table stays empty. Columns of these names
    are replaced, others kept.
    """
    if chain is None:
        out = docs
        for c in categories:
            out = out.withColumn(f"p_{c}", F.lit(0.0))
        return out.withColumn("flagged", F.lit(False))
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    @F.pandas_udf(", ".join(f"{c} double" for c in categories))
    def predict(text: pd.Series) -> pd.DataFrame:
        bags = [words(t) for t in text]
        extra = np.zeros((len(bags), 0))
        for w in shared.value:
            extra = np.column_stack([extra, apply_one(w, bags, extra)])
        return pd.DataFrame(extra, columns=list(categories))

    chained = unused(docs, "chain_")
    out = docs.withColumn(chained, predict(F.col("text")))
    for c in categories:
        out = out.withColumn(f"p_{c}", F.col(f"{chained}.{c}"))
    return out.withColumn("flagged", F.col("p_toxic") >= THRESHOLD).drop(chained)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on the labelled documents, score all."""
    return with_toxicity(docs, fit(labelled(docs, labels)))
