"""Byte-level BPE encoding and decoding by batched merge rounds."""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyscope.llm.rows import texts_of

# White space by Unicode, and the published word pattern of this kind of vocabulary.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + SPACE + r"\p{L}\p{N}]+"
    r"|[" + SPACE + r"]+(?![^" + SPACE + r"])|[" + SPACE + r"]+"
)
_SHIFT = 20
_CACHED = 400_000
_ROUND = 20_000

ENCODED = "doc_id long, n_tokens long, ids array<int>, ids_sha256 string, decoded string, decoded_sha256 string"


def byte_letters() -> dict[int, str]:
    """Printable stand-in of each byte: itself where Latin-1 prints it, else the next free one from 256."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class BytePairs:
    """A vocabulary with its merge table as sorted arrays."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        letters = byte_letters()
        self.byte_id = np.array([vocab[letters[b]] for b in range(256)], dtype=np.int64)
        pairs = [(m if isinstance(m, list) else m.split(" ", 1)) for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        keys = left << _SHIFT | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order.astype(np.int64), made[order]
        self.by_rank = made
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *self.special.values()]) + 1
        back = {c: b for b, c in letters.items()}
        tokens = [b""] * size
        for t, i in vocab.items():
            tokens[i] = bytes(back[c] for c in t)
        for t, i in self.special.items():
            tokens[i] = t.encode("utf-8")
        self.bytes_table = _table(tokens)
        self.csv_table = _table([b"%d," % i for i in range(size)])
        self._words = regex.compile(WORDS)
        self._uneven = re.compile(r"\s | \s| $")
        self._split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def words(self, text: str) -> list[str]:
        """Words of a text in order; a special token's string is one word."""
        if self._split is None or not any(s in text for s in self.special):
            return self._words.findall(text)
        out = []
        for part in self._split.split(text):
            out.extend([part] if part in self.special else self._words.findall(part))
        return out

    def stretches(self, text: str) -> list[str]:
        """Cuts of a text that no word crosses: before each single blank between two non-blanks.

        Fewer and cheaper to find than words; they are looked up whole.
        """
        if any(s in text for s in self.special) or self._uneven.search(text):
            return self.words(text)
        first, *rest = text.split(" ")
        out = [" " + p for p in rest]
        return [first, *out] if first else out

    def merge(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word.

        The symbols of all words lie in one array. A round looks every adjacent
        pair up in the sorted keys, takes each word's lowest rank and joins its
        occurrences from the left; a word with no known pair leaves the array.
        """
        raw = [w.encode("utf-8") for w in words]
        out: list[np.ndarray] = [np.empty(0, dtype=np.int64)] * len(words)
        sym = self.byte_id[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        word = np.repeat(np.arange(len(raw)), [len(r) for r in raw])
        none = len(self.keys)
        while len(sym):
            rank = np.full(len(sym), none)
            if len(sym) > 1:
                key = sym[:-1] << _SHIFT | sym[1:]
                at = np.minimum(np.searchsorted(self.keys, key), none - 1)
                hit = (self.keys[at] == key) & (word[:-1] == word[1:])
                rank[:-1][hit] = self.rank[at[hit]]
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            low = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, len(sym)))
            done = low == none
            for i in np.flatnonzero(done):
                out[word[first[i]]] = sym[first[i] : first[i] + size[i]]
            if done.all():
                break
            low_of = np.repeat(low, size)
            spot = np.flatnonzero((rank == low_of) & (rank < none))
            run = np.flatnonzero(np.append(True, np.diff(spot) != 1))
            place = np.arange(len(spot)) - np.repeat(run, np.diff(np.append(run, len(spot))))
            spot = spot[place % 2 == 0]
            sym[spot] = self.by_rank[rank[spot]]
            keep = ~np.repeat(done, size)
            keep[spot + 1] = False
            sym, word = sym[keep], word[keep]
        return out

    def join(self, ids: np.ndarray, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[bytes, np.ndarray]:
        """Table entries of all ids in one string, and where each id's entry ends."""
        flat, start, length = table
        size = length[ids]
        ends = np.cumsum(size)
        if not len(ids):
            return b"", ends
        src = np.repeat(start[ids] - (ends - size), size)
        src += np.arange(len(src))
        return flat[src].tobytes(), ends


def _table(entries: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    length = np.array([len(e) for e in entries], dtype=np.int64)
    return np.frombuffer(b"".join(entries), dtype=np.uint8), np.cumsum(length) - length, length


@lru_cache(maxsize=2)
def load(path: str) -> BytePairs:
    return BytePairs(path)


class Encoder:
    """Encodes texts; ids of words seen before are looked up in a store of bounded size."""

    def __init__(self, path: str):
        self.pairs = load(path)
        self._special = {s: np.array([i], dtype="<i4").tobytes() for s, i in self.pairs.special.items()}
        self._ids = dict(self._special)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        known = self._ids
        if len(known) > _CACHED:
            known.clear()
            known.update(self._special)
        split = [self.pairs.stretches(t) for t in texts]
        new = list({w for words in split for w in words if w not in known})
        for at in range(0, len(new), _ROUND):
            part = new[at : at + _ROUND]
            words = [self.pairs.words(w) for w in part]
            ids = self.pairs.merge([w for own in words for w in own])
            place = 0
            for w, own in zip(part, words, strict=True):
                end = place + len(own)
                known[w] = (ids[place] if len(own) == 1 else np.concatenate(ids[place:end])).astype("<i4").tobytes()
                place = end
        return [np.frombuffer(b"".join([known[w] for w in words]), dtype="<i4") for words in split]


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    """One a worker, so that later tasks find the words of earlier ones."""
    return Encoder(path)


def encode_decode(docs: DataFrame, vocabulary_path: str, with_values: bool = True) -> DataFrame:
    """Ids of every whole text, the text decoded from the ids, and digests of both.

    ``with_values=False`` leaves the ids and the decoded text null and keeps the
    digests and ``n_tokens``. Null text counts as empty: no ids, digests of the
    empty string. Strings of special tokens in a text become their ids. Repeated
    rows give repeated results, an empty table none; other columns are ignored.
    """
    def run(batches):
        encoder = _encoder(vocabulary_path)
        pairs = encoder.pairs
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                each = encoder.encode(texts_of(part))
                flat = np.concatenate(each) if each else np.empty(0, dtype="<i4")
                bounds = np.cumsum([len(e) for e in each])
                csv_at = _digests(pairs, flat, bounds, pairs.csv_table, 1)
                text_at = _digests(pairs, flat, bounds, pairs.bytes_table, 0)
                values = with_values or None
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id").cast(pa.int64()),
                        "n_tokens": pa.array([len(e) for e in each], pa.int64()),
                        "ids": pa.array(each if values else [None] * len(each), pa.list_(pa.int32())),
                        "ids_sha256": pa.array([hashlib.sha256(b).hexdigest() for b in csv_at]),
                        "decoded": pa.array(
                            [b.decode("utf-8", "replace") for b in text_at] if values else [None] * len(each), pa.string()
                        ),
                        "decoded_sha256": pa.array(
                            [hashlib.sha256(b.decode("utf-8", "replace").encode("utf-8")).hexdigest() for b in text_at]
                        ),
                    }
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ENCODED)


def _digests(pairs: BytePairs, flat: np.ndarray, bounds: np.ndarray, table, drop: int) -> list[bytes]:
    joined, ends = pairs.join(flat, table)
    edge = np.where(bounds > 0, ends[np.maximum(bounds - 1, 0)] if len(ends) else 0, 0)
    before = np.append(0, edge[:-1])
    return [joined[a : max(a, b - drop)] for a, b in zip(before.tolist(), edge.tolist(), strict=True)]
