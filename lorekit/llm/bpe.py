"""Byte-level BPE by forced-boundary splitting.

A pair of neighbouring bytes that occurs inside no vocabulary token can never be merged, so it marks a certain cut:
fragments between cuts are encoded on their own and concatenated. White space gives cuts of the same kind before that
(a piece of the pre-tokeniser never holds white space after anything else), so a text falls into short chunks whose
ids are remembered in each worker, up to a fixed number of entries.

Defined cases: a null or empty text has no ids and decodes to an empty text; special tokens standing in a text are
encoded as such, as the tokeniser's file says; very long words are merged with a heap, in n log n steps; repeated rows
get equal values; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Fixed value: the pre-tokeniser's pattern, with its white space spelled out.
PIECES = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{BLANK}\p{{L}}\p{{N}}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+")
CHUNKS = re.compile(rf"[{BLANK}]*[^{BLANK}]+|[{BLANK}]+")
UNEVEN = re.compile(rf"^[{BLANK}]|[{BLANK}][{BLANK}]|[{BLANK}]$")
REMEMBER, LONGEST = 250_000, 48


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones themselves, others from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """A byte-level BPE vocabulary, read from a tokenizers file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        letter = byte_letters()
        vocab = file["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.tokens = [b""] * (max(*vocab.values(), *self.special.values(), 0) + 1)
        for word, i in vocab.items():
            self.tokens[i] = word.encode() if word in self.special else bytes(letter[c] for c in word)
        for word, i in self.special.items():
            self.tokens[i] = word.encode()
        self.dtype = np.dtype("<u2" if len(self.tokens) <= 1 << 16 else "<u4")
        self.byte = [vocab[c] for c, _ in sorted(letter.items(), key=lambda x: x[1])]
        self.ranks, self.made = {}, []
        for rank, pair in enumerate(file["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocab[a], vocab[b]] = rank
            self.made.append(vocab[a + b])
        self.rank_of, self.never = self.ranks.get, len(self.made)
        self.inside = {p for word in vocab if word not in self.special for p in zip(*(lambda t: (t, t[1:]))(self.tokens[vocab[word]]), strict=False)}
        self.marks = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.known: dict[str, bytes] = {}
        self.after: dict[str, bytes] = {}
        self.parts: dict[bytes, list[int]] = {}

    def fragments(self, piece: bytes) -> list[bytes]:
        """piece, cut at the byte pairs that occur inside no token."""
        inside, out, start = self.inside, [], 0
        for i in range(1, len(piece)):
            if (piece[i - 1], piece[i]) not in inside:
                out.append(piece[start:i])
                start = i
        out.append(piece[start:])
        return out

    def merge(self, fragment: bytes) -> list[int]:
        """The ids of one fragment: the merge of lowest rank first, the leftmost of equal ones."""
        ids, rank_of, never = [self.byte[b] for b in fragment], self.rank_of, self.never
        if len(ids) > 64:
            return self._merge_long(ids)
        ranks = [rank_of(p, never) for p in zip(ids, ids[1:], strict=False)]
        while ranks and (best := min(ranks)) != never:
            i = ranks.index(best)
            ids[i : i + 2] = [self.made[best]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank_of((ids[i - 1], ids[i]), never)
            if i < len(ranks):
                ranks[i] = rank_of((ids[i], ids[i + 1]), never)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        n = len(ids)
        after, before, heap = list(range(1, n + 1)), list(range(-1, n - 1)), []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (rank := self.rank_of((ids[i], ids[j]))) is not None:
                heapq.heappush(heap, (rank, i, ids[i], ids[j], self.made[rank]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = new, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [x for x in ids if x >= 0]

    def _chunk(self, chunk: str) -> bytes:
        out: list[int] = []
        for piece in PIECES.findall(chunk):
            for part in self.fragments(piece.encode()):
                ids = self.parts.get(part)
                if ids is None:
                    ids = self.merge(part)
                    if len(self.parts) < REMEMBER // 2 and len(part) <= LONGEST:
                        self.parts[part] = ids
                out.extend(ids)
        return np.array(out, self.dtype).tobytes()

    def _plain(self, text: str) -> bytes:
        """Packed ids of a text without special tokens."""
        if not text:
            return b""
        spaced = not UNEVEN.search(text)
        words = text.split(" ") if spaced else CHUNKS.findall(text)
        known = self.after if spaced else self.known
        first = [self._chunk(words.pop(0))] if spaced else []
        try:
            return b"".join(chain(first, [known[w] for w in words]))
        except KeyError:
            pass
        got = []
        for w in words:
            ids = known.get(w)
            if ids is None:
                ids = self._chunk(" " + w if spaced else w)
                if len(known) < REMEMBER and len(w) <= LONGEST:
                    known[w] = ids
            got.append(ids)
        return b"".join(chain(first, got))

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a text."""
        text = text or ""
        if self.marks is None or not self.marks.search(text):
            return np.frombuffer(self._plain(text), self.dtype)
        out, at = [], 0
        for m in self.marks.finditer(text):
            out += [self._plain(text[at : m.start()]), np.array([self.special[m[0]]], self.dtype).tobytes()]
            at = m.end()
        return np.frombuffer(b"".join([*out, self._plain(text[at:])]), self.dtype)

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.tokens.__getitem__, ids.tolist())).decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The codec of a file, one for each worker process."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for whole in batches:
            for batch in (whole.slice(i, 256) for i in range(0, whole.num_rows, 256)):
                ids = [c.encode(t.as_py()).astype(np.int32) for t in batch.column(1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text of rows of doc_id, ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            text = [c.decode(np.array(i.as_py() or [], np.int64)) for i in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: each text encoded, its ids decoded again, both hashed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        digits = [str(i) for i in range(len(c.tokens))]
        for batch in batches:
            n, a, b = [], [], []
            for t in batch.column(1):
                ids = c.encode(t.as_py())
                n.append(len(ids))
                a.append(hashlib.sha256(",".join(map(digits.__getitem__, ids.tolist())).encode()).hexdigest())
                b.append(hashlib.sha256(c.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
