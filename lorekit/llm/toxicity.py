"""Toxicity by noisy-channel deobfuscation.

A character model of order four is counted over all documents. Words pass through a noisy channel: letters may be written
as digits or signs, repeated, or set apart by signs or blanks. A Viterbi search, without a beam, through the lattice of
possible letters under the character model and the costs of the channel restores the likeliest text. Words and word
beginnings of the restored text, beside those as written, are looked up in a lexicon that sets labelled toxic texts apart
from others, and a logistic model over the lexicon gives the score.

Where the search cannot change a text it isn't run. A plain text changes only where leaving out a border or a repeated
letter is cheaper under the model than its cost in the channel; that is computed for all places of a text at once. The
search runs over the words around such places, over words with digits or signs beside letters, letters three times in a
row, and rows of three or more single letters.

Bounds: lexicon and weights are fitted on at most SAMPLE labelled rows (those of smallest hash of their doc_id); the
lexicon has at most LEXICON entries. Scoring reads whole texts and is the same at every size.

Defined cases: a null or empty text has the score of a text without any lexicon word; without labelled rows of both
kinds every score is 0; repeated rows get equal scores; a null doc_id is not held out; of several labels for one
doc_id the highest counts, and rows that repeat a labelled doc_id all count; other columns are ignored, but for the
filter, which keeps them.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorekit.llm.common import settle

SAMPLE, LEXICON, LEAST = 20_000, 400, 5
KINDS = 28  # border, a to z, any other letter
ORDER = 4
REMEMBER = 100_000
PIECE, TOGETHER = 1 << 20, 1 << 18
#: Between texts that are read together: no letter of a word, and nothing that a word could be joined over.
APART = "\n\u3002\n"
#: Letters that a digit or sign may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t"}
#: Costs of the channel, in nats: a letter written as a digit or sign; such a character that is none, or an exclamation
#: mark that is none; a letter repeated; a blank, or a sign, inside a word.
COST_LEET, COST_DIGIT, COST_MARK, COST_REPEAT, COST_BLANK, COST_INNER = 0.7, 15.0, 1.0, 4.0, 6.0, 2.0
WORDS = re.compile(r"[^\W\d_]+")
RUNS = re.compile(r"[a-z0-9@$!|+\x80-\U0010ffff]|[^a-z0-9@$!|+\x80-\U0010ffff]+")

_class = np.zeros(256, np.uint8)
_class[65:91] = _class[97:123] = np.arange(1, 27)
_class[128:] = 27
_leet = np.isin(np.arange(256), [ord(c) for c in LEET])
_blank = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_first = (np.arange(256) & 0xC0) != 0x80  # not a later byte of a character


@dataclass
class Model:
    """Costs of the character model, lexicon entries with weights, and the bias; small enough to send to every task."""

    costs: np.ndarray
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0
    fitted: bool = False


def character_costs(counts: np.ndarray) -> np.ndarray:
    """Costs of a character class after three others, smoothed by shorter contexts."""
    four = counts.reshape((KINDS,) * ORDER).astype(float)
    one = four.sum(axis=(0, 1, 2)) + 1
    one /= one.sum()
    two = four.sum(axis=(0, 1)) + 20 * one
    two /= two.sum(axis=1, keepdims=True)
    three = four.sum(axis=0) + 20 * two[None]
    three /= three.sum(axis=2, keepdims=True)
    full = four + 10 * three[None]
    return -np.log(full / full.sum(axis=3, keepdims=True)).astype(np.float32)


def _whole(raw: bytes) -> Iterator[bytes]:
    """Pieces of a text, cut at blanks."""
    at = 0
    while at < len(raw):
        end = min(len(raw), at + PIECE)
        while end < len(raw) and raw[end] not in b"\t\n\v\f\r ":
            end += 1
        yield raw[at:end]
        at = end


def _kinds(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes, and the classes of their characters with their places, runs of borders being one; borders at the ends."""
    b = np.frombuffer(raw, np.uint8)
    c = _class[b]
    keep = _first[b]
    keep[1:] &= (c[1:] > 0) | (c[:-1] > 0)
    at = np.flatnonzero(keep)
    return b, np.r_[np.zeros(3, np.uint8), c[at], np.zeros(3, np.uint8)], np.r_[0, 0, 0, at, [len(b)] * 3]


def _grams(s: np.ndarray) -> np.ndarray:
    """The number of each run of ORDER classes."""
    s = s.astype(np.int32)
    return ((s[:-3] * KINDS + s[1:-2]) * KINDS + s[2:-1]) * KINDS + s[3:]


def count_grams(docs: DataFrame) -> np.ndarray:
    """Counts over every document; KINDS ** ORDER numbers come to the driver, whatever the size of the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(KINDS**ORDER, np.int64)
        for batch in batches:
            for text in batch.column(0):
                for raw in _whole((text.as_py() or "").encode()):
                    np.add.at(total, _grams(_kinds(raw)[1]), 1)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["gram", "n"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(KINDS**ORDER, np.int64)
        for batch in batches:
            total[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["counts"])

    sums = docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    packed = sums.repartition(1).mapInArrow(pack, "counts binary").first()  # a row for each gram at most
    return np.frombuffer(packed.counts, np.int64) if packed else np.zeros(KINDS**ORDER, np.int64)


def _kind(c: str) -> int:
    return 0 if len(c) > 1 else ord(c) - 96 if "a" <= c <= "z" else 27 if ord(c) > 127 else 0


def restore(span: str, costs: np.ndarray, dearest: float | None = None) -> str:
    """The likeliest words behind a lower-case span: the best path through the lattice of its characters.

    A letter may stand for itself or for a repetition of the one before; a digit or sign for a letter that it resembles or
    for a border; anything else for a border or for nothing. A path is given up only if it costs more than the cheapest and any change of its context.
    """
    flat, bound = costs.reshape(-1), ORDER * (float(costs.max()) if dearest is None else dearest)
    paths: dict[tuple[int, str], tuple[float, tuple | None]] = {(0, ""): (0.0, None)}
    for c in RUNS.findall(span):
        own, letters = _kind(c), LEET.get(c, "")
        options = [(c, own, 0.0)] if own else [(x, ord(x) - 96, COST_LEET) for x in letters]
        border = None if own else 0.0 if not letters else COST_MARK if c == "!" else COST_DIGIT
        nothing = None if own or letters else COST_BLANK if any(x.isspace() for x in c) else COST_INNER
        after: dict[tuple[int, str], tuple[float, tuple | None]] = {}
        for (context, last), (cost, made) in paths.items():
            moves = []
            for x, k, extra in options:
                gram = context * KINDS + k
                moves.append(((gram % KINDS**3, x), cost + extra + float(flat[gram]), (made, x)))
                if own and x == last:
                    moves.append(((context, last), cost + extra + COST_REPEAT, made))
            if border is not None:
                if context % KINDS:
                    gram = context * KINDS
                    moves.append(((gram % KINDS**3, ""), cost + border + float(flat[gram]), (made, " ")))
                else:
                    moves.append(((context, ""), cost + border, made))
            if nothing is not None and context % KINDS:
                moves.append(((context, last), cost + nothing, made))
            for state, total, path in moves:
                if state not in after or after[state][0] > total:
                    after[state] = (total, path)
        least = min(cost for cost, _ in after.values()) + bound
        paths = {state: x for state, x in after.items() if x[0] <= least}
    path = min(((cost + (float(flat[context * KINDS]) if context % KINDS else 0.0), made) for (context, _), (cost, made) in paths.items()), key=lambda x: x[0])[1]
    out = []
    while path:
        out.append(path[1])
        path = path[0]
    return "".join(reversed(out)).strip()


def suspects(text: str, costs: np.ndarray) -> list[str]:
    """The spans of a lower-case text that the search may change."""
    return [span for _, span in _suspects(text, costs)]


def _suspects(text: str, costs: np.ndarray) -> list[tuple[int, str]]:
    """Such spans, with the places (bytes) of their beginnings."""
    out, before = [], 0
    for raw in _whole(text.encode()):
        b, s, at = _kinds(raw)
        n, flat = len(s), costs.reshape(-1)
        cost = flat[_grams(s)]  # of the character three places on
        join = 3 + np.flatnonzero((s[3 : n - 3] == 0) & (s[2 : n - 4] > 0) & (s[4 : n - 2] > 0))
        joined = np.stack([s[join + d] for d in (-3, -2, -1, 1, 2, 3)]).astype(np.int32)
        less = sum(flat[((joined[i] * KINDS + joined[i + 1]) * KINDS + joined[i + 2]) * KINDS + joined[i + 3]] for i in range(3))
        gain = cost[join - 3] + cost[join - 2] + cost[join - 1] + cost[join] - less
        blanks = np.r_[0, np.cumsum(_blank[b])]
        wide = blanks[at[join + 1]] > blanks[at[join]]
        single = (s[join - 2] == 0) & (s[join + 2] == 0)
        places = [at[join[gain > np.where(wide, COST_BLANK, COST_INNER)]], at[join[1:-1][single[1:-1] & single[:-2] & single[2:]]]]
        twice = 3 + np.flatnonzero((s[3 : n - 3] == s[2 : n - 4]) & (s[3 : n - 3] > 0) & (s[3 : n - 3] < 27))
        left = np.stack([s[twice + d] for d in (-3, -2, -1, 1, 2, 3)]).astype(np.int32)
        less = sum(flat[((left[i] * KINDS + left[i + 1]) * KINDS + left[i + 2]) * KINDS + left[i + 3]] for i in range(3))
        gain = cost[twice - 3] + cost[twice - 2] + cost[twice - 1] + cost[twice] - less
        places.append(at[twice[(gain > COST_REPEAT) | (s[twice - 1] == s[twice - 2])]])
        letter, leet = _class[b] > 0, _leet[b]
        places.append(np.flatnonzero((leet[:-1] & letter[1:]) | (letter[:-1] & leet[1:])))
        lone = (letter | leet) & np.r_[True, _blank[b[:-1]]] & np.r_[_blank[b[1:]], True]
        if lone.any():
            alone = np.flatnonzero(lone)
            near = np.diff(alone) <= 4
            row = np.r_[near, False] & np.r_[False, near]
            places.append(alone[row])
        out += _spans(raw, np.unique(np.concatenate(places)), blanks, before)
        before += len(raw)
    return out


def _spans(raw: bytes, places: np.ndarray, blanks: np.ndarray, before: int) -> list[tuple[int, str]]:
    """The words around the places, as texts; words around one place, or touching, are one span. before: bytes ahead."""
    if not len(places):
        return []
    is_blank = blanks[1:] > blanks[:-1]
    edge = np.flatnonzero(np.r_[True, is_blank[1:] != is_blank[:-1], True])  # runs of blanks and of others
    run = np.searchsorted(edge, places, side="right") - 1
    first = np.where(is_blank[np.minimum(edge[run], len(is_blank) - 1)], run - 1, run)
    last = np.where(is_blank[np.minimum(edge[run], len(is_blank) - 1)], run + 1, run)
    first, last = np.maximum(first, 0), np.minimum(last, len(edge) - 2)
    start, end = edge[first], edge[last + 1]
    reach = np.maximum.accumulate(end)
    new = np.r_[True, start[1:] >= reach[:-1]]
    return [(before + a, raw[a:z].decode("utf-8", "replace")) for a, z in zip(start[new].tolist(), np.maximum.reduceat(end, np.flatnonzero(new)).tolist(), strict=True)]


class Reader:
    """Words of texts, disguised ones restored; remembers spans up to a fixed number."""

    def __init__(self, model: Model):
        self.model, self.costs, self.dearest = model, model.costs, float(model.costs.max())
        self.spans: dict[str, list[str]] = {}
        self.starts = {e[1:5] for e in model.weights}

    def _restored(self, span: str) -> list[str]:
        made = self.spans.get(span)
        if made is None:
            once = restore(span, self.costs, self.dearest)
            made = WORDS.findall(f"{once} {restore(once, self.costs, self.dearest)}")  # letters that were digits may be repetitions
            if len(self.spans) < REMEMBER:
                self.spans[span] = made
        return made

    def words(self, text: str | None) -> set[str]:
        return next(self.words_of([text]))

    def words_of(self, texts: list[str | None]) -> Iterator[set[str]]:
        """The words of each text; texts are read together up to TOGETHER characters."""
        held, size = [], 0
        for t in texts:
            held.append((t or "").lower())
            size += len(held[-1])
            if size >= TOGETHER:
                yield from self._together(held)
                held, size = [], 0
        yield from self._together(held)

    def _together(self, texts: list[str]) -> list[set[str]]:
        out = [set(WORDS.findall(t)) for t in texts]
        ends = np.cumsum([len(t.encode()) + len(APART.encode()) for t in texts])
        for at, span in _suspects(APART.join(texts), self.costs) if texts else ():
            for k, part in enumerate(span.split(APART), int(np.searchsorted(ends, at, side="right"))):
                out[min(k, len(out) - 1)].update(self._restored(part))
        return out

    def found(self, words: set[str]) -> set[str]:
        """The lexicon entries that words match; few words have their first four letters in common with any."""
        return {e for w in words if w[:4] in self.starts for e in entries(w) if e in self.model.weights}


def entries(word: str) -> list[str]:
    """What a word may match in the lexicon: itself, or a beginning of 4 to 8 letters."""
    return ["=" + word, *("^" + word[:n] for n in (4, 5, 6, 7, 8) if len(word) >= n)]


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the labelled rows of docs; labels: doc_id, toxic."""
    model = Model(character_costs(count_grams(docs)))
    marks = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("toxic", "text")  # SAMPLE rows at most

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """entry, bad, n: the toxic texts and all texts that have it; the entry "" counts the texts themselves."""
        reader, bad, both = Reader(model), Counter(), Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(both), pa.string()), pa.array([bad[e] for e in both], pa.int64()), pa.array(list(both.values()), pa.int64())], names=["entry", "bad", "n"])
            bad.clear()
            both.clear()
            return out

        for batch in batches:
            for toxic, words in zip(batch.column(0).to_pylist(), reader.words_of(batch.column(1).to_pylist()), strict=True):
                found = {"", *(e for w in words for e in entries(w))}
                both.update(found)
                if toxic:
                    bad.update(found)
                if len(both) > 300_000:
                    yield flush()
        yield flush()

    seen = rows.mapInArrow(count, "entry string, bad long, n long").groupBy("entry").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
    seen = settle(seen.where(F.col("bad") >= LEAST), "entries")
    total = seen.where("entry = ''").first()
    if total is None or total.bad == total.n:
        return model
    odds = F.log((F.col("bad") + 0.5) / (total.bad + 1)) - F.log((F.col("n") - F.col("bad") + 0.5) / (total.n - total.bad + 1))
    best = seen.where("entry <> ''").withColumn("odds", odds).where("odds > 2").orderBy((F.col("bad") * F.col("odds")).desc(), "entry").limit(LEXICON)
    place = {r.entry: i for i, r in enumerate(best.collect())}

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            found = [sorted({place[e] for w in words for e in entries(w) if e in place}) for words in reader.words_of(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int32()), pa.array(found, pa.list_(pa.int32()))], names=["toxic", "found"])

    table = rows.mapInArrow(every, "toxic int, found array<int>").collect()  # SAMPLE rows of a few numbers
    x = np.zeros((len(table), len(place) + 2), np.float32)
    x[:, -1] = 1
    y = np.array([float(r.toxic > 0) for r in table])
    for i, r in enumerate(table):
        x[i, [*r.found, -2] if r.found else []] = 1  # the last but one: any entry at all
    w = np.zeros(x.shape[1])
    ridge = np.full(len(w), 1.0)
    ridge[-1] = 0.01
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * w)
        w += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    model.weights = {e: float(w[i]) for e, i in place.items()} | {"": float(w[-2])}
    model.bias, model.fitted = float(w[-1]), True
    return model


def scores(reader: Reader, texts: list[str | None]) -> list[float]:
    """The score of each text."""
    model, out = reader.model, []
    if not model.fitted:
        return [0.0] * len(texts)
    for words in reader.words_of(texts):
        found = reader.found(words)
        z = model.bias + sum(model.weights[e] for e in sorted(found)) + (model.weights[""] if found else 0.0)
        out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
    return out


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            s = scores(reader, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64()), pa.array([int(v >= 0.5) for v in s], pa.int32())], names=["doc_id", "score", "predicted"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, predicted int")


def held_out():
    """Whether a row is kept from training: the checksum of its id, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """docs without those predicted toxic."""
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            yield batch.filter(pa.array([s < 0.5 for s in scores(reader, batch.column(place).to_pylist())], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
