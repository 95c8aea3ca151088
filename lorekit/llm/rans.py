"""Token files coded by a static range asymmetric numeral system.

One frequency table, counted over all tokens of the corpus, is shared by all blocks. A block holds whole documents,
about 262,144 tokens, dealt over up to 2048 interleaved lanes; it can be decoded without any other block, and its
checkpoints (lane states and word positions every 64 steps) let parts of it be decoded side by side. Checksums cover
the coded words and the ids. A file is the run of blocks of one range of document ids; files are written and read by
Spark, so executors share nothing but the folder.

Defined cases: a null or empty text is a document of the end id alone; a null doc_id sorts before all; equal doc_ids
go by their place in the input; a document longer than a block makes a block of its own; without documents there are no
blocks; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lorekit.llm.common import discard, resettled, settle, with_batches

SCALE = 18
LOW = np.uint64(1 << 31)
BLOCK, LANES, STRIDE = 1 << 18, 2048, 64
BLOCKS_AT_ONCE = 4
#: Pages are closed by their size after any row: by default only after a hundred, which here makes 50 MB.
LARGE_ROWS = {"parquet.page.size.row.check.min": "1"}
MAGIC = b"RANB"
REMEMBER, LONGEST = 200_000, 48
NULL_ID = -(1 << 63)
#: ASCII and the letters (with two signs) from U+00C0 to U+00FF in UTF-8: no combining marks, so case can go first.
PLAIN = bytes([*range(0xC0), 0xC3])
#: What special tokens begin with; they are matched before case is dropped.
MARK = b"<|"
#: Where the vocabulary's tokeniser cuts plain lower-case text.
CUT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ\t-\r ]+")


class Table:
    """Frequencies scaled to 2**SCALE, at least 1 for each id that occurs."""

    def __init__(self, counts: np.ndarray):
        self.counts = np.asarray(counts, np.int64)
        total, size = int(self.counts.sum()), 1 << SCALE
        freq = np.zeros(len(self.counts), np.int64)
        seen = self.counts > 0
        if seen.sum() > size:
            raise ValueError("more different ids than table slots")
        if total:
            freq[seen] = np.maximum(1, np.round(self.counts[seen] / total * size)).astype(np.int64)
            order = np.argsort(-freq, kind="stable")
            while over := int(freq.sum()) - size:
                give = np.minimum(freq[order] - 1, np.maximum(1, freq[order] * abs(over) // size)) if over > 0 else np.maximum(0, freq[order] * -over // size + 1) * seen[order]
                give = np.minimum(give, np.maximum(0, abs(over) - (np.cumsum(give) - give)))
                freq[order] -= give * (1 if over > 0 else -1)
        self.freq = freq.astype(np.uint64)
        self.start = (np.cumsum(freq) - freq).astype(np.uint64)
        self.slot = np.repeat(np.arange(len(freq)), freq).astype(np.uint32)
        self.mark = zlib.crc32(freq.astype("<u4").tobytes())

    def __reduce__(self):
        return Table, (self.counts,)


def encode_block(table: Table, docs: list[int], lengths: list[int], ids: np.ndarray, offset: int) -> bytes:
    """ids of documents of those lengths; offset: the ids before them in the file."""
    n = len(ids)
    lanes = max(1, min(LANES, n // 64))
    steps = -(-n // lanes)
    x, words, points, shift, sent = np.full(lanes, LOW), [], [], np.uint64(SCALE), 0
    ids = ids.astype(np.int64)
    for t in range(steps - 1, -1, -1):
        row = ids[t * lanes : (t + 1) * lanes]
        f, c, now = table.freq[row], table.start[row], x[: len(row)]
        full = now >= (f << np.uint64(63 - SCALE))
        if full.any():
            words.append(now[full].astype(np.uint32))
            sent += len(words[-1])
            now = np.where(full, now >> np.uint64(32), now)
        q = now // f
        x[: len(row)] = (q << shift) + (now - q * f) + c
        if t and t % STRIDE == 0:
            points.append((t, sent, x.copy()))
    stream = np.concatenate(words[::-1]).astype("<u4").tobytes() if words else b""
    body = x.astype("<u8").tobytes()
    for t, had, state in points[::-1]:
        body += struct.pack("<II", t, sent - had) + state.astype("<u8").tobytes()
    body += stream
    index = np.array(docs, "<i8").tobytes() + np.array(lengths, "<u4").tobytes()
    head = struct.pack("<4sIQIIIIII", MAGIC, table.mark, offset, len(docs), n, lanes, len(points), sent, zlib.crc32(ids.astype("<u4").tobytes()))
    return head + struct.pack("<I", zlib.crc32(head + index + body)) + index + body


HEAD = struct.calcsize("<4sIQIIIIII")


def _run(table: Table, out: np.ndarray, x: np.ndarray, stream: np.ndarray, first: int, last: int) -> int:
    """Decode the steps from first to last into out; the words that it took."""
    lanes, mask, shift, at = len(x), np.uint64((1 << SCALE) - 1), np.uint64(SCALE), 0
    for t in range(first, last):
        row = out[t * lanes : (t + 1) * lanes]
        now = x[: len(row)]
        slot = now & mask
        row[:] = s = table.slot[slot.astype(np.int64)]
        now = table.freq[s] * (now >> shift) + slot - table.start[s]
        need = now < LOW
        k = int(need.sum())
        if k:
            now[need] = (now[need] << np.uint64(32)) | stream[at : at + k]
            at += k
        x[: len(row)] = now
    return at


def decode_block(table: Table, block: bytes, only: int | None = None) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Offset, document ids, lengths and ids of a block; only: one part between checkpoints (the other ids stay 0)."""
    magic, mark, offset, n_docs, n, lanes, n_points, sent, crc = struct.unpack_from("<4sIQIIIIII", block)
    (whole,) = struct.unpack_from("<I", block, HEAD)
    if magic != MAGIC or mark != table.mark or whole != zlib.crc32(block[HEAD + 4 :], zlib.crc32(block[:HEAD])):
        raise ValueError("damaged block, or one of another table")
    at = HEAD + 4
    docs = np.frombuffer(block, "<i8", n_docs, at)
    lengths = np.frombuffer(block, "<u4", n_docs, at + 8 * n_docs)
    at += 12 * n_docs
    states = [(0, 0, np.frombuffer(block, "<u8", lanes, at).copy())]
    at += 8 * lanes
    for _ in range(n_points):
        t, had = struct.unpack_from("<II", block, at)
        states.append((t, had, np.frombuffer(block, "<u8", lanes, at + 8).copy()))
        at += 8 + 8 * lanes
    stream = np.frombuffer(block, "<u4", sent, at).astype(np.uint64)
    out = np.zeros(n, np.uint32)
    ends = [*(s[0] for s in states[1:]), -(-n // lanes)]
    for k, ((first, had, x), last) in enumerate(zip(states, ends, strict=True)):
        if only is None or k == only:
            _run(table, out, x, stream[had:], first, last)
    if only is None and zlib.crc32(out.astype("<u4").tobytes()) != crc:
        raise ValueError("ids differ from their checksum")
    return offset, docs, lengths, out


class Words:
    """Ids of texts by the tokenizers library, piece by piece, remembered up to a fixed number.

    Valid for tokenisers that drop white space, ignore case and never join words across white space. Words of plain
    characters (ASCII and the Latin letters of two bytes) are cut where the tokeniser cuts them; new pieces go to the
    library in runs, past the normaliser and the splitter that have nothing left to do. Any other word goes there whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        split = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.whole, self.bare = (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer), (None, split)
        self.size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.last = np.zeros(self.size, bool)
        for word, i in self.tokenizer.get_vocab().items():
            self.last[i] = word.endswith("</w>")
        self.met = bytearray(1 << 22)
        self.known: dict[str | bytes, bytes] = {}

    def _remember(self, new: dict[str | bytes, bytes]) -> None:
        """Keep what was met before: most new words never come again. Any hash will do, as it only decides what is kept."""
        met, known = self.met, self.known
        for w, ids in new.items():
            if len(known) >= REMEMBER:
                break
            h = hash(w) % len(met)
            if met[h] and len(w) <= LONGEST:
                known[w] = ids
            met[h] = 1

    def _each(self, words: list[str]) -> list[bytes]:
        self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = self.whole
        got = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in got]

    def _runs(self, pieces: list[str]) -> list[bytes]:
        """Pieces that the tokeniser doesn't cut, encoded in runs: each ends with its only id that ends a word."""
        out = []
        for i in range(0, len(pieces), 500):
            run = pieces[i : i + 500]
            self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = self.bare
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(run)], add_special_tokens=False)[0].ids, self.dtype)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(run):
                out += self._each(run)
                continue
            packed, k = ids.tobytes(), self.dtype.itemsize
            out += [packed[k * a : k * b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
        return out

    def _units(self, text: bytes) -> list[str | bytes]:
        """Pieces (str) of a text's plain words, and its other words (bytes), in order."""
        if not (MARK in text or text.translate(None, PLAIN)):
            return CUT.findall(text.decode().lower())
        out: list[str | bytes] = []
        for w in text.split():
            if MARK in w or w.translate(None, PLAIN):
                out.append(w)
            else:
                out += CUT.findall(w.decode().lower())
        return out

    def encode(self, texts: list[bytes], end: int) -> list[bytes]:
        """Packed ids of each text, end appended."""
        tail, flat, ends = np.array([end], self.dtype).tobytes(), [], []
        for t in texts:
            flat += self._units(t)
            ends.append(len(flat))
        got, lost, at = list(map(self.known.get, flat)), [], -1
        got.append(None)
        while (at := got.index(None, at + 1)) < len(flat):
            lost.append(at)
        new = {flat[i] for i in lost}
        pieces, words = [w for w in new if isinstance(w, str)], [w for w in new if isinstance(w, bytes)]
        fresh = dict(zip([*pieces, *words], [*self._runs(pieces), *self._each([w.decode() for w in words])], strict=True))
        for i in lost:
            got[i] = fresh[flat[i]]
        self._remember(fresh)
        return [b"".join(got[a:b]) + tail for a, b in zip([0, *ends], ends, strict=False)]


_words: dict[str, Words] = {}


def forget() -> None:
    """A worker of a later stage needs no vocabulary."""
    _words.clear()


def words(path: str) -> Words:
    if path not in _words:
        _words[path] = Words(path)
    return _words[path]


def _pieces(texts: Iterator[bytes], most: int = 1 << 21) -> Iterator[list[bytes]]:
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def _blocks(path: str, end: int):
    """Rows (doc_id, text) in order, tokenised and gathered to blocks of whole documents; part: the number of the task.

    A last row without documents holds the tally of the task's tokens.
    """
    kinds = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("offset", pa.int64()), ("docs", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())), ("ids", pa.binary()), ("tally", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, part = words(path), TaskContext.get().partitionId()
        size, seq, offset, docs, ids, held, total = w.dtype.itemsize, 0, 0, [], [], 0, np.zeros(w.size, np.int64)

        def flush() -> pa.RecordBatch:
            nonlocal seq, offset, docs, ids, held, total
            n, whole = [len(i) // size for i in ids], b"".join(ids)
            total += np.bincount(np.frombuffer(whole, w.dtype), minlength=w.size)
            row = {"part": [part], "seq": [seq], "offset": [offset], "docs": [docs], "lengths": [n], "ids": [whole], "tally": [None]}
            seq, offset, docs, ids, held = seq + 1, offset + sum(n), [], [], 0
            return pa.RecordBatch.from_pydict(row, schema=kinds)

        for batch in batches:
            keys, at = batch.column(0).cast(pa.int64()).fill_null(NULL_ID).to_pylist(), 0
            for piece in _pieces(t.as_py() or b"" for t in batch.column(1).cast(pa.binary())):
                for packed in w.encode(piece, end):
                    docs.append(keys[at])
                    ids.append(packed)
                    held += len(packed)
                    at += 1
                    if held >= BLOCK * size:
                        yield flush()
        if docs:
            yield flush()
        yield pa.RecordBatch.from_pydict({"part": [part], "seq": [-1], "offset": [offset], "docs": [[]], "lengths": [[]], "ids": [b""], "tally": [total.tobytes()]}, schema=kinds)

    return run


BLOCK_ROWS = "part int, seq int, offset long, docs array<long>, lengths array<int>, ids binary, tally binary"


def write(docs: DataFrame, path: str, end: int, tag: str = "tokens") -> tuple[DataFrame, Table]:
    """Token files of docs in ascending doc_id order, as rows (part, seq, n_tokens, block), and their table."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    rows = rows.repartitionByRange(n, "doc_id", "row").sortWithinPartitions("doc_id", "row").select("doc_id", "text")
    w = words(path)
    plain = settle(rows.mapInArrow(_blocks(path, end), BLOCK_ROWS), f"{tag}-plain", LARGE_ROWS)
    few = resettled(plain, with_batches(spark, BLOCKS_AT_ONCE))
    kind, size = w.dtype, w.size

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        forget()
        for batch in batches:
            for tally in batch.column(0):
                total += np.frombuffer(tally.as_py(), np.int64)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["id", "n"])

    counts = np.zeros(size, np.int64)
    found = few.select("tally").where("tally is not null").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    for row in found.collect():  # a row for each id of the vocabulary at most
        counts[row.id] = row.n
    table = Table(counts)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for k in range(batch.num_rows):
                part, seq, offset, docs_of, lengths, packed = (c[k].as_py() for c in batch.columns)
                ids = np.frombuffer(packed, kind)
                block = encode_block(table, docs_of, lengths, ids, offset)
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([block], pa.binary())], names=["part", "seq", "n_tokens", "block"])

    files = settle(few.where("seq >= 0").drop("tally").mapInArrow(code, "part int, seq int, n_tokens long, block binary"), tag, LARGE_ROWS | {"compression": "none"})
    discard(plain)
    return resettled(files, spark), table


def read(files: DataFrame, table: Table) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files."""
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    ahead = F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = totals.select(F.col("part").alias("_part"), ahead.alias("ahead"))  # a row for each file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, block in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                offset, docs, lengths, ids = decode_block(table, block.as_py())
                packed, at = ids.astype("<u4"), np.cumsum(lengths, dtype=np.int64) - lengths
                crc = [zlib.crc32(packed[a : a + n]) for a, n in zip(at.tolist(), lengths.tolist(), strict=True)]
                doc = pa.array(docs, pa.int64(), mask=docs == NULL_ID)
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(docs), pa.int32()), doc, pa.array(at + offset, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())], names=["part", "doc_id", "at", "n_tokens", "ids_crc32"])

    spark = files.sparkSession
    few = resettled(files, with_batches(spark, BLOCKS_AT_ONCE)).select("part", "block")
    rows = settle(few.mapInArrow(run, "part int, doc_id long, at long, n_tokens long, ids_crc32 long"), "tokens-read")
    rows = resettled(rows, spark).join(F.broadcast(starts), F.col("part") == F.col("_part"))
    return rows.select("doc_id", (F.col("ahead") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
