"""The corpus operators against brute force on small rows, with the awkward cases of every operator."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from lorekit.llm import bpe, graph, hilbert, licences, lines, minhash, mixing, png, rans, toxicity  # noqa: E402

LONG = "word and more of it " * 3000
BASE = " ".join(f"w{i}" for i in range(60))
TEXTS = [
    None, "", " \n\t ", "one", "one two three", "one two three", "One TWO three", BASE, BASE + " tail", BASE.replace("w30", "x30"), LONG, LONG,
    "Released under the MIT License.\nReleased under the MIT License.", "licensed under the GNU General Public License, version 3", "a line of more than twenty chars\nsecond, é中 İ",
    "a line of more than twenty charz\nsecond, é中 İ", "<|endoftext|> x <|startoftext|>", "x" * 3000,
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rank int, size string, part string, label string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 2 else None, [None, "b", "a"][i % 3], len(t or ""), 7, "x", "p", "l") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("doc_id < 0")


def word_path():
    return public_tokenizers.path("word_bpe_49k.json")


def byte_path():
    return public_tokenizers.path("byte_bpe_50k.json")


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    files, table = rans.write(empty, word_path(), 2)
    frames = [
        lines.line_report(empty), lines.drop_lines(empty), hilbert.hilbert_shards(empty), minhash.near_duplicates(empty), rans.read(files, table), bpe.digests(empty, byte_path()),
        mixing.mix(empty), mixing.mixed(empty), toxicity.score(empty, toxicity.fit(empty, labels)), png.describe(png.to_media(empty)), graph.nearest(vectors, vectors), licences.scan(empty),
    ]
    assert [f.count() for f in frames] == [0] * len(frames)


def test_components(spark):
    """Chains, stars with the hub as least, middle and largest node, and random links."""
    from lorekit.llm.common import components

    rng = random.Random(17)
    order = rng.sample(range(10_000, 10_400), 400)
    edges = [*zip(order, order[1:], strict=False), *((7, i) for i in range(20_000, 20_900)), *((25_000, i) for i in range(24_000, 26_000, 2) if i != 25_000), *((39_999, i) for i in range(39_000, 39_900)), (1, 1)]
    edges += [(rng.randrange(50_000, 51_000), rng.randrange(50_000, 51_000)) for _ in range(600)]
    edges += [(-5, 7), (26_000, 39_999)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(rows) == len({r.node for r in rows}) and {r.node: r.label for r in rows} == {x: find(x) for x in parent}


def test_near_duplicates(docs):
    def sets(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()

    s = [sets(t) for t in TEXTS]
    parent = list(range(len(s)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(s)):
        for j in range(i):
            if s[i] and s[j] and 100 * len(s[i] & s[j]) >= 80 * len(s[i] | s[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs, 4).collect()}
    assert got == {i: (len(s[i]), find(i), find(i) == i) for i in range(len(s))}


def test_near_copies_without_ids_and_repeated_rows(spark):
    other = BASE.replace("w", "v")
    near = BASE.replace("w59", "x59")
    rows = [(None, other), (None, "a clean one"), (3, BASE), (3, BASE), (None, near), (5, near), (None, None), (None, other.replace("v59", "y59")), (7, "alone"), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in minhash.drop_near_duplicates(docs).collect()]
    left = [r for r in got if r[1] not in (other, rows[7][1])]
    assert sorted(left, key=str) == sorted([rows[1], rows[2], rows[6], rows[8], rows[9]], key=str) and len(got) == 6
    report = [tuple(r) for r in minhash.near_duplicates(docs).collect()]
    assert len(report) == len(rows) and sum(r[3] for r in report) == 6 and sorted(r[2] for r in report if r[2] is not None) == [3, 3, 3, 3, 7]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance():
    rng = random.Random(3)
    for _ in range(5000):
        a, b = ("".join(rng.choices("ab", k=rng.randint(0, 10))) for _ in range(2))
        most = rng.randint(1, 4)
        assert lines.edit_distance(a, b, most) == min(distance(a, b), most + 1)


def test_edit_distances_side_by_side():
    rng = random.Random(13)
    texts = []
    for _ in range(300):
        x = [rng.choice("abé中" if rng.random() < 0.5 else "ab") for _ in range(rng.randint(8, 90))]
        texts.append("".join(x))
        for _ in range(rng.randint(0, 9)):
            at = rng.randrange(len(x))
            x[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "b", "bb"])
        texts.append("".join([*x, *"abababab"][: max(8, len(x))]))
    left, right = np.array([rng.randrange(600) for _ in range(4000)] + list(range(0, 600, 2))), np.array([rng.randrange(600) for _ in range(4000)] + list(range(1, 600, 2)))
    edits = np.array([rng.choice([2, 3, 5, 7]) for _ in left])
    got = lines.within(texts, left, right, edits)
    assert got.tolist() == [distance(texts[a], texts[b]) <= e for a, b, e in zip(left, right, edits.tolist(), strict=True)] and 100 < got.sum() < 4000
    long = "".join(rng.choices("abcdef", k=900))
    assert lines.within([long, long[:100] + long[140:], long[:100] + long[150:]], np.array([0, 0, 0]), np.array([1, 1, 2]), np.array([40, 39, 45])).tolist() == [True, False, False]


def test_lines(spark):
    rng = random.Random(5)
    stems = ["".join(rng.choices("abcde é中", k=30)) for _ in range(12)]

    def near(s):
        s = list(s)
        for _ in range(rng.randint(0, 3)):
            s[rng.randrange(len(s))] = rng.choice("abc")
        return "".join(s)

    rows = [(i, "\n".join(near(rng.choice(stems)) for _ in range(rng.randint(1, 4))) if i % 9 else None) for i in range(60)]
    places = [(i, k, x) for i, t in rows if t for k, x in enumerate(t.split("\n"))]
    forms = sorted({x for _, _, x in places})
    parent = {x: x for x in forms}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in forms:
        for b in forms:
            if a < b and distance(a, b) <= 2:
                parent[find(a)] = find(b)
    first = {}
    for i, k, x in places:
        first.setdefault(find(x), (i, k))
    want = {i: [k for j, k, x in places if j == i and first[find(x)] != (i, k)] for i, _ in rows}
    got = {r.doc_id: list(r.dropped) for r in lines.line_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


def test_lines_edits_grow_with_length(spark):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(300)]
    rows = []
    for n in (14, 17, 20, 22, 25, 60, 150, 150):
        base = rng.choices(words, k=n)
        for edits in (0, 1, 2, 3):
            w = list(base)
            for _ in range(edits):
                w[rng.randrange(n)] = rng.choice(words)
            rows.append((len(rows), " ".join(w)))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    far = 0
    for i, a in rows:
        for j, b in rows[:i]:
            most = max(2, min(len(a), len(b)) * 5 // 100)
            if abs(len(a) - len(b)) <= most and (d := lines.edit_distance(a, b, most)) <= most:
                far += d > 2
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    got = {r.doc_id: list(r.dropped) for r in lines.line_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert far > 10 and got == {i: [] if find(i) == i else [0] for i, _ in rows}


def test_drop_lines_keeps_columns(docs):
    got = {r.doc_id: r for r in lines.drop_lines(docs).collect()}
    assert got[14].text == TEXTS[14] and got[12].text == "Released under the MIT License." and got[12].n_chars == 31 and got[0].text is None
    assert set(range(len(TEXTS))) - set(got) == {5, 8, 9, 11, 15}


def line_oracle(rows, most=2, least=20):
    """class id, links and dropped lines of rows (doc_id, text) by comparing all pairs of lines."""
    rank = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    places = [(i, k, x) for i in rank for k, x in enumerate((rows[i][1] or "").split("\n")) if x.strip()]
    forms = sorted({x for _, _, x in places})
    parent = {x: x for x in forms}

    def find(p, x):
        while p[x] != x:
            x = p[x]
        return x

    for i, a in enumerate(forms):
        for b in forms[:i]:
            within = max(most, min(len(a), len(b)) * 5 // 100)
            if min(len(a), len(b)) >= least and abs(len(a) - len(b)) <= within and lines.edit_distance(a, b, within) <= within:
                parent[find(parent, a)] = find(parent, b)
    members = {}
    for p in places:
        members.setdefault(find(parent, p[2]), []).append(p)
    doc = list(range(len(rows)))
    for own in members.values():
        for p in own[1:]:
            doc[find(doc, p[0])] = find(doc, own[0][0])
    ids = {}
    for i in range(len(rows)):
        known = [rows[j][0] for j in range(len(rows)) if find(doc, j) == find(doc, i) and rows[j][0] is not None]
        ids[i] = min(known) if known else None
    out = []
    for i in range(len(rows)):
        mine = [(k, members[find(parent, x)]) for j, k, x in places if j == i]
        out.append((rows[i][0], ids[i], sum(len(m) - 1 for _, m in mine), [k for k, m in mine if m[0][:2] != (i, k)]))
    return out


def test_line_classes_of_documents(spark):
    """Short copies, closure over documents, links of first holders, null and repeated ids, clashing names."""
    one, two, three = "a first line of thirty letters", "quite another one, also longer", "Les."
    rows = [
        (4, one), (5, two), (6, f"{one}\n{two}"), (7, f"{three}\nonly here, and nowhere else on"), (8, f"{three}\n \n{three}"), (9, f"{one[:-1]}z\nown words in a line of its own"),
        (3, "repeated id, first text of the two"), (3, "other words\nunder the same id 3 as before"), (None, two), (None, "a line without any id, but clean"), (10, None), (11, ""), (12, "\n\n"),
    ]
    got = [(r.doc_id, r.class_id, r.n_links, list(r.dropped)) for r in lines.line_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got, key=str) == sorted(line_oracle(rows), key=str)
    assert dict((r[0], r[1]) for r in got if r[0])[5] == 4
    names = ["_dropped", "dropped", "row", "mark", "_d", "_m", "tile", "n_lines", "label", "line"]
    docs = spark.createDataFrame([(*r, *map(str, range(len(names)))) for r in rows], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    left = lines.drop_lines(docs)
    assert left.columns == docs.columns
    want = []
    for r, (_, _, _, drop) in zip(rows, line_oracle(rows), strict=True):
        whole = (r[1] or "").split("\n")
        if not drop or len(drop) < sum(bool(x.strip()) for x in whole):
            want.append((r[0], "\n".join(x for i, x in enumerate(whole) if i not in drop) if drop else r[1], *map(str, range(len(names)))))
    assert sorted(map(tuple, left.collect()), key=str) == sorted(want, key=str)


def test_lines_with_a_common_beginning(spark):
    """More lines than a block share their first segment, and most of them nothing else."""
    rng = random.Random(11)
    tails = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=rng.choice([30, 75]))) for _ in range(650)]
    near = []
    for t in tails[:40]:
        x = list(t)
        for _ in range(rng.randint(1, 3)):
            x[rng.randrange(len(x))] = rng.choice("abc")
        near.append("".join(x))
    rows = [(i, f"2024-02-29 {t}") for i, t in enumerate([*tails, *near])]
    got = [(r.doc_id, r.class_id, r.n_links, list(r.dropped)) for r in lines.line_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got) == sorted(line_oracle(rows)) and sum(r[2] for r in got) > 40


def spread(rng, text, edits):
    """text with so many edits, as far apart as they can be: what both have in a row is as short as it can be."""
    out, kind = list(text), rng.choice(["replace", "delete", "insert"])
    for i in reversed(range(edits)):
        at = (i + 1) * len(text) // (edits + 1)
        out[at : at + (kind != "insert")] = [] if kind == "delete" else ["#"]
    return "".join(out)


def test_long_lines_with_edits_far_apart(spark):
    """As many edits as allowed leave no long stretch as it was; lengths where the stretch changes, and very long lines."""
    rng = random.Random(17)
    rows = []
    for n in [100, 101, 104, 105, 107, 119, 120, 161, 162, 170, 199, 360, 361, 379, 400, 420, 1000, 3000, 70000] * 2:
        base = "".join(rng.choices("abcdefghij ", k=n))
        other = spread(rng, base, n * 5 // 100)
        if len(other) < n:
            other = spread(rng, base, len(other) * 5 // 100)
        rows += [(len(rows), base), (len(rows) + 1, other if n < 70000 else base[:300] + "#" * 1500 + base[300:])]
    rows.append((len(rows), "a" * 150)), rows.append((len(rows), "a" * 157)), rows.append((len(rows), "a" * 164))
    got = [(r.doc_id, r.class_id, r.n_links, list(r.dropped)) for r in lines.line_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got) == sorted(line_oracle(rows)) and [r[2] for r in sorted(got)] == [1] * (len(rows) - 3) + [2, 2, 2]


def test_long_lines_with_a_common_beginning(spark):
    """More lines than a block share a passage at one place, and some of them nothing else that is as long."""
    rng = random.Random(19)
    bases = ["2024-02-29 12:00:00 worker said: " + "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=90)) for _ in range(560)]
    near = []
    for b in bases[:40]:
        x = list(b)
        for i in range(6):
            x[41 + 13 * i] = "#"
        near.append("".join(x))
    rows = list(enumerate(bases + near))
    got = {r.doc_id: (r.class_id, r.n_links, list(r.dropped)) for r in lines.line_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: (i, 1 if i < 40 else 0, []) if i < 560 else (i - 560, 1, [0]) for i, _ in rows}


def test_drop_long_lines_with_edits_far_apart(spark):
    """The pipeline's line stage drops later forms of long lines with as many edits as allowed."""
    rng = random.Random(23)
    bases = ["".join(rng.choices("abcdefghij ", k=n)) for n in (100, 120, 160, 199, 240, 360, 400, 560, 900) for _ in range(4)]
    copies = []
    for b in bases:
        x = list(b)
        for i in range(len(b) * 5 // 100):
            x[(i + 1) * len(b) // (len(b) * 5 // 100 + 1)] = "#"
        copies.append("".join(x))
    rows = [(i, f"{b}\nown words of document number {i * 7919:040d}") for i, b in enumerate(bases)] + [(100 + i, f"{c}\n{i:03d}") for i, c in enumerate(copies)]
    got = {r.doc_id: r.text for r in lines.drop_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[100 + i] for i in range(len(copies))] == [f"{i:03d}" for i in range(len(copies))] and all(got[i].startswith(b) for i, b in enumerate(bases))


def test_lines_that_share_many_keys_meet_once():
    """Near copies of long lines share hundreds of keys, some lines apiece; candidates grow with the lines, none is lost."""
    rng = random.Random(29)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(500)]
    base, rows = rng.choices(words, k=70), []
    for size in (300, 1200):
        copies = []
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randint(0, 5)):
                w[rng.randrange(len(w))] = rng.choice(words)
            copies.append(" ".join(w))
        copies = sorted(set(copies))
        found = [pa.RecordBatch.from_pydict({"text": copies})]
        for step in (lines._keys(20, 2, 0), lines._meet(2), lines._once):
            out = [x for b in step(iter(found)) for x in b.to_pylist()]
            found = [pa.RecordBatch.from_pylist(sorted(out, key=lambda x: x.get("part", 0)))]
        near = {x["near"] for x in out}
        rows.append((len(near), len(out), len(copies)))
        tiles = {}
        for x in out:
            tiles.setdefault(x["key"], set()).add(x["near"])
        codes, a, b, _ = next(lines._pieces(copies))
        name = (np.array(list(map(len, copies))) << 32) | (lines._line_ids(*lines._sums(codes), a, b) >> np.uint64(32)).astype(np.int64)
        for _ in range(3000):
            i, j = rng.sample(range(len(copies)), 2)
            most = min(map(len, (copies[i], copies[j]))) * 5 // 100
            if lines.edit_distance(copies[i], copies[j], most) <= most:
                assert any({int(name[i]), int(name[j])} <= t for t in tiles.values())
    assert all(out <= 30 * n for n, out, _ in rows) and rows[1][1] <= 6 * rows[0][1], rows


def test_lines_of_middling_groups_meet_once():
    """Sixty near copies of a long line: candidates are not all their pairs."""
    rng = random.Random(31)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(500)]
    base, copies = rng.choices(words, k=70), set()
    while len(copies) < 60:
        w = list(base)
        w[rng.randrange(len(w))] = rng.choice(words)
        copies.add(" ".join(w))
    found = [pa.RecordBatch.from_pydict({"text": sorted(copies)})]
    for step in (lines._keys(20, 2, 0), lines._meet(2), lines._once):
        out = [x for b in step(iter(found)) for x in b.to_pylist()]
        found = [pa.RecordBatch.from_pylist(sorted(out, key=lambda x: x.get("part", 0)))]
    assert len({x["near"] for x in out}) == 60 and len(out) <= 20 * 60, len(out)


def test_shards(docs):
    rows = hilbert.hilbert_shards(docs, 5).collect()
    counts = [sum(r.shard == s for r in rows) for s in range(5)]
    assert max(counts) - min(counts) <= 1 and all(sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s])) for s in range(5))
    for r in rows:
        raw = (TEXTS[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "rows", None)
    cube = np.array(list(np.ndindex(8, 8, 8)))
    path = cube[np.argsort(hilbert.hilbert_index(cube, 3))]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_tokens(docs):
    tok = Tokenizer.from_file(word_path())
    files, table = rans.write(docs, word_path(), 2)
    got, start = {r.doc_id: r for r in rans.read(files, table).collect()}, 0
    for i, t in enumerate(TEXTS):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_words_equal_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    w = rans.Words(path)
    texts = ["<|endoftext|> a<|startoftext|>b <|STARTOFTEXT|>", "J\u030cx I\u0307 \u00e9 \u00c9's DON'T l'Main ''s !'s \u2019s \u00aa\u00ba\u00b5", "1\u00bd2 \u00d7\u00f7 a\u00d7b \x00\x1c\x1f\x7f a\x85b a\xa0b <| |> </w> a</w>b", "\u017ftra\u00dfe STRASSE \u1e9e \u0130I \u212a \u3000x\u2028y", "\u65e5\u672c\u8a9e", "", "   ", "x" * 300 + " " + "Ab1" * 90]
    for _ in range(3):  # unknown, met once, remembered
        got = w.encode([t.encode() for t in texts], 2)
        assert [np.frombuffer(g, w.dtype).tolist() for g in got] == [[*library.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert w.encode([], 2) == []


def test_rans_parts_and_damage():
    rng = np.random.default_rng(1)
    ids = rng.zipf(1.5, 200_000).clip(0, 40_000)
    table = rans.Table(np.bincount(ids, minlength=49_408))
    block = rans.encode_block(table, [5, 6], [150_000, 50_000], ids, 9)
    assert (rans.decode_block(table, block)[3] == ids).all()
    parts = sum(rans.decode_block(table, block, k)[3].astype(int) for k in range(2))
    assert (parts == ids).all() and int(table.freq.sum()) == 1 << rans.SCALE
    with pytest.raises(ValueError):
        rans.decode_block(table, block[:-1] + bytes([block[-1] ^ 1]))


def test_bpe_equals_the_library(docs):
    tok, own = Tokenizer.from_file(byte_path()), bpe.codec(byte_path())
    rng, letters = random.Random(2), [*" \n\t'.,aeiousrtlvmd09éß中🙂ا　\x85", "'s", "'ll", "the", "<|endoftext|>"]
    for t in [*(t or "" for t in TEXTS), *("".join(rng.choices(letters, k=rng.randint(0, 30))) for _ in range(1500))]:
        ids = tok.encode(t, add_special_tokens=False).ids
        assert own.encode(t).tolist() == ids and own.decode(own.encode(t)) == tok.decode(ids, skip_special_tokens=False)
    for r in bpe.digests(docs, byte_path()).collect():
        ids = tok.encode(TEXTS[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert {r.doc_id: r.text for r in bpe.decode(bpe.encode(docs, byte_path()), byte_path()).collect()}[10] == LONG


def test_mix(docs, spark):
    rows = [(i, "w " * (i % 50 + 1), f"s{i % 4}") for i in range(2000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert got and sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()))
    total = sum(r["size"] for r in got)
    for s, w in zip(range(4), (5, 2, 1, 5), strict=True):
        own = [r for r in got if r.doc_id % 4 == s]
        assert own[0].target == pytest.approx(total * w / 13) and abs(sum(r.taken for r in own) - own[0].target) <= 50
    assert all(r.taken <= 3 * r["size"] for r in mixing.mix(docs).collect())


def test_targets_share_the_excess(spark):
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame([("a", 10), ("b", 1000), (None, 500)], "source string, source_size long")).collect()}
    assert got == pytest.approx({"a": 30.0, "b": 1480 * 2 / 3, None: 1480 / 3})


def test_restore_finds_the_cheapest_path():
    """Against every path through the lattice of short spans, under random costs."""
    rng, gen = random.Random(21), np.random.default_rng(21)
    costs = gen.exponential(3.0, (toxicity.KINDS,) * 4).astype(np.float32)

    def cost_of(path):
        total, seen = 0.0, [0, 0, 0]
        for c, extra in path:
            total += extra
            if c is not None and (c != " " or seen[-1]):
                seen.append(toxicity._kind(c) if c != " " else 0)
                total += float(costs[seen[-4], seen[-3], seen[-2], seen[-1]])
        return total + (float(costs[seen[-3], seen[-2], seen[-1], 0]) if seen[-1] else 0.0)

    def paths(chars, last):
        if not chars:
            return [[]]
        c, out = chars[0], []
        letters = toxicity.LEET.get(c, "")
        if c.isalpha():
            out += [[(c, 0.0), *p] for p in paths(chars[1:], c)]
            if c == last:
                out += [[(None, toxicity.COST_REPEAT), *p] for p in paths(chars[1:], last)]
            return out
        for x in letters:
            out += [[(x, toxicity.COST_LEET), *p] for p in paths(chars[1:], x)]
        border = 0.0 if not letters else toxicity.COST_MARK if c == "!" else toxicity.COST_DIGIT
        out += [[(" ", border), *p] for p in paths(chars[1:], "")]
        if not letters:
            out += [[(None, toxicity.COST_BLANK if c == " " else toxicity.COST_INNER), *p] for p in paths(chars[1:], last)]
        return out

    for _ in range(150):
        span = "".join(rng.choice("aabs0156!$ -é") for _ in range(rng.randint(1, 7)))
        span = re.sub(r"[ -]+", lambda m: m[0][0], span).strip(" -")
        best = min((cost_of(p) for p in paths(span, "")), default=0.0)
        found = {"".join(c for c, _ in p if c is not None) for p in paths(span, "") if abs(cost_of(p) - best) < 1e-4}
        assert re.sub(" +", " ", toxicity.restore(span, costs)).strip() in {re.sub(" +", " ", f).strip() for f in found}, span


def test_toxicity(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels.where(~toxicity.held_out()))
    disguised = {
        "a55": "ass", "a$$": "ass", "hat3": "hate", "stuupid": "stupid", "stu pid": "stupid", "stu-pid": "stupid", "s  t  u  p  i  d": "stupid", "l0ser": "loser", "l00ser": "loser",
        "stuuuupid": "stupid", "$tup1d": "stupid", "i d i o t": "idiot", "s.t.u.p.i.d": "stupid", "idi07": "idiot",
    }
    reader = toxicity.Reader(model)
    for span, word in disguised.items():
        assert word in reader.words(f"The one, {span} and that") and word in reader.words(span), span
    assert toxicity.suspects("the and of that", model.costs) == [] and "ethe" not in reader.words("the\n" * 300_000 + "x")
    texts = ["the stu", "pid one", None, "", "stu pid", "i d i", "o t", "l0ser"] * 30
    assert list(reader.words_of(texts)) == [reader.words(t) for t in texts]
    plain = "one of the " * 200_000
    assert "stupid" in reader.words(plain + "s t u p i d " + plain)
    rows = toxicity.score(docs, model).join(labels, "doc_id").where(toxicity.held_out()).collect()
    bad, good = [r for r in rows if r.toxic], [r for r in rows if not r.toxic]
    assert sum(r.predicted for r in bad) >= 0.8 * len(bad) and sum(r.predicted for r in good) <= 0.01 * len(good)
    kept = {r.doc_id for r in toxicity.keep_clean(docs, model).select("doc_id").collect()}
    assert kept == {r.doc_id for r in toxicity.score(docs, model).where("predicted = 0").select("doc_id").collect()}


def test_media(docs):
    for r in png.describe(png.to_media(docs)).collect():
        raw = (TEXTS[r.doc_id] or "").encode()
        full = raw + b" " * (-len(raw) % 192 or (0 if raw else 192))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-16:]))
    good = png.encode(bytes(range(192)) * 40)
    with pytest.raises(ValueError):
        png.decode(good[:60] + bytes([good[60] ^ 1]) + good[61:])


def test_all_png_filters():
    rng = np.random.default_rng(4)
    want, kinds = rng.integers(0, 256, (10, 12)), [0, 1, 2, 2, 3, 4, 4, 3, 2, 1]
    lines_ = []
    for r, k in enumerate(kinds):
        row = [k]
        for i in range(12):
            w, n, nw = (want[r][i - 3] if i >= 3 else 0), (want[r - 1][i] if r else 0), (want[r - 1][i - 3] if r and i >= 3 else 0)
            p = w + n - nw
            guess = [0, w, n, (w + n) // 2, min((abs(p - w), 0, w), (abs(p - n), 1, n), (abs(p - nw), 2, nw))[2]][k]
            row.append((want[r][i] - guess) % 256)
        lines_.append(row)
    assert (png.unfilter(np.array(lines_, np.uint8), 3) == want).all()


def test_nearest(spark):
    rng = np.random.default_rng(6)
    v = rng.normal(size=(1500, 16))
    v[100:140] = v[100]
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)] + [(1500, None), (1501, [0.0] * 16), (1502, [float("nan")] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in graph.nearest(df, df.where("vec_id % 100 = 0"), shard=500).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    hits = 0
    for q in range(0, 1500, 100):
        d = np.sqrt(((v - v[q]) ** 2).sum(axis=1))
        best = sorted((x, i) for i, x in enumerate(d.tolist()) if i != q)[:10]
        hits += len({i for _, i in best} & {i for i, _ in got[q].values()})
        assert sorted(got[q]) == list(range(1, 11)) and all(s == pytest.approx(d[i], abs=1e-12) for i, s in got[q].values())
    assert hits >= 0.9 * 150 and [got[100][k][0] for k in range(1, 11)] == list(range(101, 111)) and not {1500, 1501, 1502} & got.keys()


def test_licences(docs):
    lower = str.maketrans(licences.UPPER, licences.LOWER)
    for r in licences.scan(docs).collect():
        words = re.findall(licences.WORD, (TEXTS[r.doc_id] or "").translate(lower))
        at = [(i, b) for p, b in licences.BASE.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        assert (r.n_words, r.n_base, r.base_labels) == (len(words), len(at), ",".join(sorted({b for _, b in at})))
        assert (r.first_word, r.last_word) == ((min(at)[0], max(at)[0]) if at else (None, None)) and set(r.base_labels.split(",")) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert {r.doc_id: r.labels for r in licences.scan(docs).collect()}[13] == "gpl,gpl-3.0"


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert corpus_pipeline.run(spark, sf).count() > 0
