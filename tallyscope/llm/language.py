"""Language identification: multinomial logistic regression on character n-grams, trained by FTRL."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyscope.llm.rows import texts_of, unused
from tallyscope.sources.durable import materialise

BUCKETS = 1 << 16
SAMPLE_PER_LANGUAGE = 2000
UNDETERMINED = "und"
_STEP = 1 << 16  # characters looked at in one go
_ROWS = 512  # texts of a batch that are Python strings at a time

ALPHA, BETA, L1, L2, EPOCHS, SCALE = 0.3, 1.0, 0.02, 0.05, 2, 30.0


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    out = np.zeros(0x110000, dtype=bool)
    out[[i for i in range(0x110000) if chr(i).isalpha()]] = True
    return out


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed 1-, 2- and 3-grams of lower-cased texts: bucket, text number, and texts with a letter.

    A run of characters other than letters counts as one blank; a gram may start
    or end with a blank but never crosses it.
    """
    parts = [(" " + t.lower() + " ").encode("utf-32-le", "surrogatepass") for t in texts]
    code = np.frombuffer(b"".join(parts), dtype=np.uint32)
    doc = np.repeat(np.arange(len(parts)), [len(p) // 4 for p in parts])
    letter = _letters()[code]
    has = np.zeros(len(texts), dtype=bool)
    has[doc[letter]] = True
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[:-1] |= letter[1:]
    keep[1:] &= ~(~letter[1:] & ~letter[:-1] & ~np.append(letter[2:], False))
    code, doc, letter = np.where(letter, code, 32)[keep].astype(np.uint64), doc[keep], letter[keep]
    m1, m2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
    h1 = code * m1
    h2 = (h1[:-1] ^ (h1[:-1] >> np.uint64(29))) * m2 + h1[1:]
    h3 = (h2[:-1] ^ (h2[:-1] >> np.uint64(31))) * m2 + h1[2:]
    ok1 = letter
    ok2 = (letter[:-1] | letter[1:]) & (doc[:-1] == doc[1:])
    ok3 = letter[1:-1] & (doc[:-2] == doc[2:]) if len(code) > 2 else np.zeros(0, dtype=bool)
    both = np.concatenate([h1[ok1], h2[ok2] ^ np.uint64(1 << 40), h3[ok3] ^ np.uint64(2 << 40)])
    both = ((both ^ (both >> np.uint64(32))) * m2) >> np.uint64(48)
    where = np.concatenate([doc[ok1], doc[:-1][ok2], doc[:-2][ok3]]) if len(code) else np.zeros(0, dtype=np.int64)
    return both.astype(np.int64) % BUCKETS, where, has


def _steps(texts: list[str]):
    """Consecutive slices of about ``_STEP`` characters; a long text is a slice of its own."""
    at = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= _STEP:
            yield texts[at : i + 1]
            at, size = i + 1, 0
    if at < len(texts):
        yield texts[at:]


def sparse_counts(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets and their counts of each text."""
    out = []
    for part in _steps(texts):
        bucket, doc, _ = grams(part)
        key, n = np.unique(doc * BUCKETS + bucket, return_counts=True)
        cut = np.searchsorted(key, np.arange(1, len(part)) * BUCKETS)
        for k, c in zip(np.split(key % BUCKETS, cut), np.split(n, cut), strict=True):
            out.append((k, c))
    return out


def document_frequency(docs: DataFrame) -> np.ndarray:
    """How many of all the given documents hold each bucket; 65,536 sums reach the driver."""
    def count(batches):
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                for part in _steps(texts_of(batch.slice(at, _ROWS))):
                    bucket, doc, _ = grams(part)
                    total += np.bincount(np.unique(doc * BUCKETS + bucket) % BUCKETS, minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(used, pa.int64()), "n": pa.array(total[used], pa.int64())})

    sums = docs.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS)
    for r in sums.toPandas().itertuples():
        out[r.bucket] = r.n
    return out


class Model:
    """Weights by bucket and language, with IDF folded in, and the temperature."""

    def __init__(self, languages: list[str], weights: np.ndarray, bias: np.ndarray, temperature: float):
        self.languages, self.weights, self.bias, self.temperature = languages, weights, bias, temperature

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities by text and language, and which texts have a letter."""
        probs, letters = [], []
        for part in _steps(texts):
            bucket, doc, has = grams(part)
            total = np.bincount(doc, minlength=len(part)).clip(1)
            logits = np.stack(
                [np.bincount(doc, weights=w[bucket], minlength=len(part)) for w in self.weights], axis=1
            ) / total[:, None]
            probs.append(softmax((logits * SCALE + self.bias) / self.temperature))
            letters.append(has)
        if not probs:
            return np.zeros((0, len(self.languages))), np.zeros(0, dtype=bool)
        return np.concatenate(probs), np.concatenate(letters)


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, n_classes: int) -> np.ndarray:
    """Follow-the-regularised-leader with both penalties; the last row of the weights is the bias."""
    z = np.zeros((BUCKETS + 1, n_classes))
    n = np.zeros((BUCKETS + 1, n_classes))

    def weights(z_, n_):
        return -np.sign(z_) * np.maximum(np.abs(z_) - L1, 0) / ((BETA + np.sqrt(n_)) / ALPHA + L2)

    for _ in range(EPOCHS):
        for (at, x), y in zip(rows, labels, strict=True):
            z_, n_ = z[at], n[at]
            w = weights(z_, n_)
            p = softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p
            z[at] += g - (np.sqrt(n_ + g * g) - np.sqrt(n_)) / ALPHA * w
            n[at] += g * g
    return weights(z, n)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature that gives the labels the least log loss, on a grid of 0.05 to 20."""
    if not len(labels):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    loss = [-np.log(softmax(logits / t)[np.arange(len(labels)), labels] + 1e-12).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def fit(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model | None:
    """Learn from rows (text, lang); None without a labelled text.

    Document frequencies cover all rows. The classifier itself is fitted on at
    most ``per_language`` distinct texts of each language, the first by hash: this
    bound is the documented sample. Only hashes are ranked, and only the chosen
    texts are shuffled. A fifth of them sets the temperature. Training runs in
    one task over the sample's counts; its weights, a table fixed by the buckets
    and languages, come to the driver.
    """
    labelled = docs.select("text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    frequency = document_frequency(labelled)
    n_docs = frequency.max() if len(frequency) else 0
    idf = np.log((1 + n_docs) / (1 + frequency)) + 0.1
    hashed = labelled.withColumn("hash_", F.xxhash64("text"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("hash_"))
    ranked = hashed.select("lang", "hash_").distinct().withColumn("place_", first)
    last = materialise(
        ranked.where(F.col("place_") <= per_language).groupBy("lang").agg(F.max("hash_").alias("last_")), "last"
    )
    chosen = hashed.join(last, "lang").where(F.col("hash_") <= F.col("last_"))
    sample = chosen.groupBy("lang", "hash_").agg(F.min("text").alias("text")).select("text", "lang")

    def features(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            got = sparse_counts(texts)
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": batch.column("lang"),
                    "order_": pa.array([hash_of(t) for t in texts], pa.int64()),
                    "at": pa.array([a for a, _ in got], pa.list_(pa.int32())),
                    "n": pa.array([c for _, c in got], pa.list_(pa.int32())),
                }
            )

    def train(frames):
        given = list(frames)
        if not given:
            return
        data = pd.concat(given, ignore_index=True)
        data = data[data["at"].map(len) > 0].sort_values(["order_", "lang"], kind="stable")
        if not len(data):
            return
        languages = sorted(data["lang"].unique())
        labels = data["lang"].map({k: i for i, k in enumerate(languages)}).to_numpy()
        rows = []
        for at, c in zip(data["at"], data["n"], strict=True):
            x = np.asarray(c) / np.sum(c) * idf[at] * SCALE
            rows.append((np.append(at, BUCKETS), np.append(x, 1.0)))
        held = data["order_"].to_numpy() % 5 == 0
        w = ftrl([r for r, h in zip(rows, held, strict=True) if not h], labels[~held], len(languages))
        logits = np.array([x @ w[at] for (at, x), h in zip(rows, held, strict=True) if h]).reshape(-1, len(languages))
        folded = (w[:-1] * idf[:, None]).T
        yield pd.DataFrame(
            {
                "lang": languages, "weights": [np.ascontiguousarray(r).tobytes() for r in folded],
                "bias": w[-1], "temperature": temperature(logits, labels[held]),
            }
        )

    rows = (
        sample.mapInArrow(features, "lang string, order_ long, at array<int>, n array<int>")
        .repartition(1).mapInPandas(train, "lang string, weights binary, bias double, temperature double").collect()
    )
    if not rows:
        return None
    rows = sorted(rows, key=lambda r: r["lang"])
    weights = np.stack([np.frombuffer(r["weights"]) for r in rows])
    return Model([r["lang"] for r in rows], weights, np.array([r["bias"] for r in rows]), rows[0]["temperature"])


def hash_of(text: str) -> int:
    import zlib

    return zlib.crc32(text.encode("utf-8", "surrogatepass"))


def held_out() -> Column:
    """True where crc32 of the id as text is divisible by 5, or there is no id: never learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def with_language(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; earlier columns of these names are replaced.

    Null text, or one without a letter: ``und`` and score 0. Without a model all
    are ``und``. Repeated rows get equal results; an empty table stays empty.
    """
    if model is None:
        return docs.withColumn("lang_pred", F.lit(UNDETERMINED)).withColumn("score", F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def predict(text: pd.Series) -> pd.DataFrame:
        m = shared.value
        probs, letters = m.scores([t or "" for t in text])
        best = probs.argmax(axis=1)
        names = np.where(letters, np.array(m.languages, dtype=object)[best], UNDETERMINED)
        return pd.DataFrame({"lang": names, "score": np.where(letters, probs.max(axis=1), 0.0)})

    # A filter on the result would be moved below it, and every text told twice, by two workers a task.
    once = predict.asNondeterministic()
    told = unused(docs, "predicted_")
    got = docs.withColumn(told, once(F.col("text")))
    return got.withColumn("lang_pred", F.col(f"{told}.lang")).withColumn("score", F.col(f"{told}.score")).drop(told)


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out and predict the language of all."""
    model = fit(docs.where(~held_out()))
    return with_language(docs.withColumn("held_out", held_out()), model)
