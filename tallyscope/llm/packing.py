"""Packing by power-of-two decomposition."""

from __future__ import annotations

import os
import re
import zlib
from functools import lru_cache
from struct import pack as pack_ids
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyscope.llm.bytepairs import byte_letters
from tallyscope.llm.rows import texts_of

END_ID = 2
MAX_LENGTH = 4096
_CACHED = 400_000

PIECES = (
    "doc_id long, start long, length long, ids array<int>, ids_crc32 long, doc_tokens long, bucket int"
)


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def binary_lengths(n: int, longest: int = MAX_LENGTH) -> list[int]:
    """Pieces of a document of n ids: whole ``longest`` ones, then the bits of the rest, largest first."""
    out = [longest] * (n // longest)
    rest = n % longest
    return out + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


class WordIds:
    """Ids of texts, a stretch between ASCII blanks at a time; repeated stretches are looked up.

    Exact for tokenizers that drop white space, compose to NFC and lower-case,
    since none of that looks across a blank; a full stop or comma between an
    ASCII letter and a blank is a word of its own there. New words of letters go
    to the tokenizer's model, other stretches to the whole tokenizer, joined by
    a special token whose id parts the result again.
    The store of stretches is emptied when it holds ``_CACHED`` of them, so
    memory stays bounded.
    """

    _stop = re.compile(rb"(?<=[a-z])([.,])(?=[ \n])")

    def __init__(self, path: str):
        self._tokenizer = _tokenizer(path)
        added = self._tokenizer.get_added_tokens_decoder()
        self._bar_id, bar = min(added.items())
        self._bar = bar.content
        self._marks = [t.content.encode("utf-8") for t in added.values()]
        self._letters = str.maketrans(byte_letters())
        self._ids: dict[bytes, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        known = self._ids
        split = []
        for text in texts:
            raw = text.encode("utf-8")
            if not any(m in raw for m in self._marks):
                raw = self._stop.sub(rb" \1 ", raw.lower())
            split.append(raw.split())
        if len(known) > _CACHED:
            known.clear()
        self._learn(list({w for words in split for w in words if w not in known}))
        return [b"".join([known[w] for w in words]) for words in split]

    def _learn(self, words: list[bytes]) -> None:
        """Look new stretches up: plain lower-case words straight in the model, others by the whole tokenizer."""
        rest = []
        model = self._tokenizer.model
        for w in words:
            word = w.decode("utf-8")
            if word.isalpha() and word == word.lower() and (word.isascii() or is_normalized("NFC", word)):
                ids = [t.id for t in model.tokenize(w.decode("latin-1").translate(self._letters))]
                self._ids[w] = pack_ids(f"<{len(ids)}I", *ids)
            elif any(m in w for m in self._marks):
                ids = self._tokenizer.encode(word, add_special_tokens=False).ids
                self._ids[w] = pack_ids(f"<{len(ids)}I", *ids)
            else:
                rest.append((w, word))
        for at in range(0, len(rest), 5000):
            part = rest[at : at + 5000]
            text = self._bar.join([word for _, word in part])
            ids = np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")
            cuts = np.flatnonzero(ids == self._bar_id)
            raw, start = ids.tobytes(), 0
            for (w, _), cut in zip(part, [*(4 * cuts).tolist(), len(raw)], strict=True):
                self._ids[w] = raw[start:cut]
                start = cut + 4


@lru_cache(maxsize=2)
def _words(path: str) -> WordIds:
    """One a worker, so that later tasks find the words of earlier ones."""
    return WordIds(path)


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, longest: int = MAX_LENGTH) -> DataFrame:
    """One row per piece, each a sequence of its own: no sequence holds two documents, none is padded.

    ``bucket`` is log2 of the length; sequences of one bucket batch together.
    ``sequence_id`` numbers pieces within the input's partitions, so a retried
    task gives the same ids. Nothing is shuffled, and a task holds one batch.

    Null or blank text: the end id alone. Repeated rows are packed separately.
    An empty table gives no rows. Other columns of ``docs`` are ignored.
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def pieces(batches):
        words = _words(tokenizer_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                doc, start, length, ids, crc, total = [], [], [], [], [], []
                for doc_id, own in zip(part.column("doc_id").to_pylist(), words.encode(texts_of(part)), strict=True):
                    own += end
                    n, s = len(own) // 4, 0
                    for k in binary_lengths(n, longest):
                        piece = own[4 * s : 4 * (s + k)]
                        doc.append(doc_id)
                        start.append(s)
                        length.append(k)
                        crc.append(zlib.crc32(piece))
                        total.append(n)
                        s += k
                    ids.append(own)
                values = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
                lengths = np.array(length, dtype=np.int64)
                offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
                np.cumsum(lengths, out=offsets[1:])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(lengths),
                        pa.ListArray.from_arrays(pa.array(offsets), values), pa.array(crc, pa.int64()),
                        pa.array(total, pa.int64()), pa.array(np.log2(lengths).astype(np.int32)),
                    ],
                    names=["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "bucket"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(pieces, PIECES)
    return rows.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Store sequences by bucket, so that a reader draws batches of one length."""
    pieces.write.partitionBy("bucket").parquet(path)
