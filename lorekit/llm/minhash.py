"""Near-duplicate documents by circulant MinHash.

Two permutations make all signature coordinates: the first scatters a shingle over 32 bits, the second is applied
after a circular shift by the coordinate's number. Coordinates are banded; documents that share a band and agree in
enough coordinates form candidate clusters; exact Jaccard on the full shingle sets then confirms links.

With 24 bands of 4 rows, a pair at exactly the threshold of 0.8 is missed with a probability under 1e-5, one above
it with far less. Copies collapse first by a 128-bit fingerprint of their shingle set, and clusters above 250,000
shingles are dealt over pairs of blocks, so no task holds an unbounded group.

Defined cases: a null, empty or blank text has no shingles, stands alone and links with nothing; with fewer words
than a shingle takes, the whole sequence is the one shingle; a row whose doc_id is null takes part under a null id, and
comes after all others; one row of a component is kept, also where rows repeat a doc_id; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorekit.llm.common import GOLD, components, discard, grouped, mix64, packed, salted, settle, tiles

BANDS, ROWS = 24, 4
COORDS = BANDS * ROWS
#: Of 96 coordinates; a pair at Jaccard 0.8 agrees in 77 on average, and in fewer than 58 about once in a million.
AGREE = 58
BLOCK_ROWS, BLOCK_SHINGLES, PIECE = 1024, 250_000, 1 << 20

_rng = np.random.default_rng(20240229)
BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE[65:91] = BYTE[97:123]  # A-Z count as a-z
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x2545F4914F6CDD1D
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE and its inverse modulo 2**64, to the powers 0 to n - 1 at least."""
    if len(_powers[0]) < n:
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            out = np.full(max(n, PIECE + 2), base, np.uint64)
            out[0] = 1
            _powers[k] = np.multiply.accumulate(out)
    return _powers[0], _powers[1]


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash for each word, in order; long texts go piece by piece, cut at white space."""
    out, at, n = [], 0, len(text)
    while at < n:
        end = min(n, at + PIECE)
        while end < n and not SPACE[text[end]]:
            end += 1
        a = np.frombuffer(text, np.uint8, end - at, at)
        word = np.zeros(len(a) + 2, bool)
        np.logical_not(SPACE[a], out=word[1:-1])
        turn = np.flatnonzero(word[1:] != word[:-1])
        if len(turn):
            up, down = _power(len(a) + 1)
            total = np.zeros(len(a) + 1, np.uint64)
            np.cumsum(BYTE[a] * up[: len(a)], out=total[1:])
            out.append(mix64((total[turn[1::2]] - total[turn[::2]]) * down[turn[::2]]))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingles(text: str | bytes | None, words: int) -> np.ndarray:
    """The distinct shingle hashes of a text, sorted."""
    w = word_hashes(text.encode() if isinstance(text, str) else text or b"")
    if not len(w):
        return w
    k = min(words, len(w))
    s = np.full(len(w) - k + 1, k, np.uint64) * GOLD
    for i in range(k):
        s += w[i : len(w) - k + 1 + i] * PLACE[i % 64] + np.uint64(i // 64)
    return np.unique(mix64(s))


def _spread(x: np.ndarray, a: int, b: int) -> np.ndarray:
    """A permutation of the 32-bit words, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(a)
    x ^= x >> np.uint32(15)
    x *= np.uint32(b)
    x ^= x >> np.uint32(16)
    return x


def signature(s: np.ndarray) -> np.ndarray:
    first = _spread((s >> np.uint64(32)).astype(np.uint32), 0x7FEB352D, 0x846CA68B)
    shift = np.arange(COORDS, dtype=np.uint32)[:, None]
    least = np.full(COORDS, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(first), 4096):
        np.minimum(least, _spread(first[None, i : i + 4096] - shift, 0x21F0AAAD, 0xD35A2D97).min(axis=1), out=least)
    return least


def _fingerprints(words: int):
    salt = mix64(np.arange(1, BANDS + 1, dtype=np.uint64) * GOLD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, s1, s2, bands, sigs = [], [], [], [], []
            for text in batch.column(1):
                s = shingles(text.as_py(), words)
                n.append(len(s))
                if not len(s):
                    s1.append(None), s2.append(None), bands.append(None), sigs.append(None)
                    continue
                sig = signature(s)
                s1.append(int(mix64(s).sum().view(np.int64)))
                s2.append(int(np.bitwise_xor.reduce(mix64(s + GOLD)).view(np.int64)))
                key = (sig.reshape(BANDS, ROWS).astype(np.uint64) * PLACE[:ROWS]).sum(axis=1) + salt
                bands.append(mix64(key).view(np.int64))
                sigs.append(sig.astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(sigs, pa.binary())], names=["doc_id", "row", "n_shingles", "s1", "s2", "bands", "sig"])

    return run


def _join(label: np.ndarray, i: int, others: np.ndarray) -> list[int]:
    """Merge the groups of others with that of i; the first of others in each group that wasn't i's."""
    new, first = np.unique(label[others], return_index=True)
    far = new != label[i]
    if far.any():
        label[np.isin(label, new[far])] = label[i]
    return others[first[far]].tolist()


def _alike(t: pa.Table) -> dict | None:
    """Links that hold together the documents of a bucket that agree in enough coordinates."""
    node, first = np.unique(t.column("s1").to_numpy(), return_index=True)
    if len(node) < 2:
        return None
    sig = np.stack([np.frombuffer(t.column("sig")[int(i)].as_py(), np.uint8) for i in first])
    label, a, b = np.arange(len(node)), [], []
    for i in range(len(node) - 1):
        hit = i + 1 + np.flatnonzero((sig[i + 1 :] == sig[i]).sum(axis=1) >= AGREE)
        for j in _join(label, i, hit) if len(hit) else ():
            a.append(int(node[i])), b.append(int(node[j]))
    return {"a": a, "b": b} if a else None


def _confirm(words: int, percent: int):
    def run(t: pa.Table) -> dict | None:
        """Links between full shingle sets that hold together each component of a cluster, or of two of its blocks."""
        if t.num_rows < 2:
            return None
        sets: dict[int, np.ndarray] = {}
        for node, text in zip(t.column("s1").to_pylist(), t.column("text").to_pylist(), strict=True):
            s = shingles(text, words)
            if node not in sets and len(s) and int(mix64(s).sum().view(np.int64)) == node:
                sets[node] = s
        node, have = list(sets), list(sets.values())
        n, size = len(node), np.array([len(s) for s in have])
        if n < 2:
            return None
        of = np.repeat(np.arange(n), size)
        _, value, count = np.unique(np.concatenate(have), return_inverse=True, return_counts=True)
        order = np.argsort(value, kind="stable")
        holder, start = of[order], np.cumsum(count) - count
        at = np.cumsum(size) - size
        label, a, b = np.arange(n), [], []
        for i in range(n - 1):
            v = value[at[i] : at[i] + size[i]]
            v = v[count[v] > 1]
            c = count[v]
            places = np.repeat(start[v] - (np.cumsum(c) - c), c) + np.arange(c.sum())
            both = np.bincount(holder[places], minlength=n)
            hit = np.flatnonzero(100 * both >= percent * (size + size[i] - both))
            hit = hit[hit != i]
            for j in _join(label, i, hit) if len(hit) else ():
                a.append(node[i]), b.append(node[j])
            if len(a) == n - 1:
                break
        return {"a": a, "b": b} if a else None

    return run


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs (doc_id, text).

    Two documents link when 100 * |intersection| >= percent * |union| of their distinct shingles of that many words.
    """
    rows = settle(docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id()), "rows")
    return _kept_rows(rows, words, percent).drop("row")


def _kept_rows(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """near_duplicates, with the row of docs (doc_id, text, row); row tells rows with one doc_id, or none, apart."""
    pairs = docs.select("doc_id", "text", "row")
    marks = settle(pairs.mapInArrow(_fingerprints(words), "doc_id long, row long, n_shingles long, s1 long, s2 long, bands array<long>, sig binary"), "marks")
    full = marks.where("n_shingles > 0")
    sets = settle(full.groupBy("s1", "s2").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"), F.max("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("sig").alias("sig")), "sets")
    rows = sets.select("s1", F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    near = rows.join(shared, "key").join(sets.select("s1", "sig"), "s1")
    near = tiles(near, "key", "s1", F.ceil(F.col("rows") / BLOCK_ROWS)).select("tile", "lower", "s1", "sig")
    cluster = components(grouped(near, "tile", _alike, "a long, b long")).withColumnsRenamed({"node": "s1", "label": "cluster"})
    held = sets.select("s1", "first.row", "n").join(cluster, "s1")
    sizes = held.groupBy("cluster").agg(F.sum("n").alias("total"))
    held = tiles(held.join(sizes, "cluster"), "cluster", "s1", F.ceil(F.col("total") / BLOCK_SHINGLES))
    texts = held.select("tile", "lower", "s1", "row").join(pairs, "row").select("tile", "lower", "s1", "text")
    links = components(grouped(texts, "tile", _confirm(words, percent), "a long, b long")).withColumnsRenamed({"node": "s1"})
    nodes = sets.select("s1", "s2", "first").join(links, "s1", "left").withColumn("label", F.coalesce("label", "s1"))
    least = nodes.groupBy("label").agg(F.min("first").alias("least"))
    nodes = salted(nodes, least, "label", "s1").select("s1", "s2", "least")
    out = marks.select("doc_id", "row", "n_shingles", "s1", "s2").join(nodes, ["s1", "s2"], "left")
    kept = F.coalesce(F.col("row") == F.col("least.row"), F.lit(True))
    return out.select("row", "doc_id", "n_shingles", F.coalesce("least.doc_id", "doc_id").alias("component_id"), kept.alias("kept"))


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """docs with one row of each component, that of the smallest doc_id; rows without one come last.

    Rows without any shingle all stay; other columns, whatever their names, are kept as they are.
    """
    rows = settle(docs.select(packed(docs, "all"), F.monotonically_increasing_id().alias("row")), "rows")
    kept = _kept_rows(rows.select("all.doc_id", "all.text", "row"), words, percent).where("kept").select("row")
    return rows.join(kept, "row", "left_semi").select("all.*")
