"""Awkward rows through every operator and stage, and the pipeline against a sequential version."""

import hashlib
import math
import random
import re

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from lorekit.llm import bpe, graph, hilbert, licences, lines, minhash, mixing, png, rans, toxicity  # noqa: E402

NAMES = [
    "_dropped", "dropped", "row", "_row", "_id", "_n", "n", "copies", "mark", "_d", "_m", "key", "bucket", "bytes", "size", "name", "tile", "lower", "s1", "s2", "all", "kept", "shard_no", "slot", "curve", "at",
    "part", "seq", "ids", "words", "marks", "votes", "found", "score", "media", "bag", "label", "line", "u", "v", "node", "rank", "wanted",
]
BASE = " ".join(f"w{i}" for i in range(40))
ROWS = [
    (None, "a text without an id", "en", "a"), (None, None, None, None), (None, BASE, "de", "b"), (7, BASE, "en", None), (7, "another text under the same id", None, "b"), (7, "another text under the same id", None, "b"),
    (8, "", "en", "a"), (9, " \n\t\n", "en", "a"), (10, ("long words and " * 50 + "\n") * 1600, "fr", "c"), (11, "x" * 1_300_000, "fr", "c"), (12, "Released under the MIT License.", "en", "a"),
]


@pytest.fixture(scope="module")
def docs(spark):
    kinds = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in NAMES)
    return spark.createDataFrame([(*r, len(r[1] or ""), *NAMES) for r in ROWS], kinds)


def byte_path():
    return public_tokenizers.path("byte_bpe_50k.json")


def same_rows(got, want):
    return sorted(map(tuple, got), key=repr) == sorted(map(tuple, want), key=repr)


def test_every_operator_keeps_every_row(spark, docs):
    labels = spark.createDataFrame([(7, 1), (8, 0), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    files, table = rans.write(docs, public_tokenizers.path("word_bpe_49k.json"), 2)
    frames = {
        "lines": lines.line_report(docs), "shards": hilbert.hilbert_shards(docs, 4), "near": minhash.near_duplicates(docs), "tokens": rans.read(files, table), "bpe": bpe.digests(docs, byte_path()),
        "mix": mixing.mix(docs), "toxicity": toxicity.score(docs, model), "media": png.describe(png.to_media(docs)), "licences": licences.scan(docs),
    }
    for name, df in frames.items():
        ids = [r.doc_id for r in df.select("doc_id").collect()]
        assert sorted(ids, key=str) == sorted((r[0] for r in ROWS), key=str), name


def test_every_stage_keeps_columns(spark, docs):
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    whole = docs.collect()
    assert same_rows(toxicity.keep_clean(docs, model).collect(), whole)
    for out in (lines.drop_lines(docs), minhash.drop_near_duplicates(docs), mixing.mixed(docs)):
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        assert all(tuple(r[5:]) == tuple(NAMES) for r in out.collect())
    near = minhash.drop_near_duplicates(docs).collect()
    assert len(near) == len(ROWS) - 2 and sum(r.doc_id is None for r in near) == 2
    taken = mixing.mixed(docs).count()
    assert taken == sum(r.copies for r in mixing.mix(docs).collect())


def test_mixed_takes_each_row_by_itself(spark):
    """Rows that share an id, or have none, but not their sizes, come as often as the mix says of each."""
    rows = [(i % 3 if i % 5 else None, "w " * (1 + 7 * i), f"s{i % 2}", i) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int")
    copies = {r["size"]: r.copies for r in mixing.mix(docs).collect()}
    got = {}
    for r in mixing.mixed(docs).collect():
        size = len(r.text.split())
        got[size] = got.get(size, 0) + 1
        assert r.copies * 7 + 1 == size
    assert got == {s: c for s, c in copies.items() if c}


def mix_oracle(rows):
    """copies of each of rows (doc_id, text, source), one after the other; doc_ids differ."""
    size = [len(re.findall(mixing.WORD, t or "")) for _, t, _ in rows]
    names = sorted({s for _, _, s in rows if s is not None}) + ([None] if any(s is None for _, _, s in rows) else [])
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    have = {s: sum(n for n, r in zip(size, rows, strict=True) if r[2] == s) for s in names}
    target, open_, left = {}, set(names), float(sum(size))
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * have[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3.0 * have[s]
            left -= target[s]
            open_.discard(s)

    def key(i):
        u = (int(hashlib.md5(f"7:{rows[i][0]}".encode()).hexdigest()[:12], 16) + 0.5) / 2**48
        per_word = len((rows[i][1] or "").encode()) / max(size[i], 1)
        return -math.log(u) / max(0.25, 1 / (1 + abs(math.log(max(per_word, 1.0) / 6))))

    copies = [0] * len(rows)
    for s in names:
        whole = int(target[s] // have[s]) if have[s] else 0
        rest, at = target[s] - whole * have[s], 0
        for i in sorted((i for i in range(len(rows)) if rows[i][2] == s), key=lambda i: (key(i), rows[i][0])):
            copies[i] = whole + (at < rest and 2 * at + size[i] <= 2 * rest)
            at += size[i]
    return copies, size, target


def test_mix_chooses_the_documents_of_least_keys(spark):
    rng = random.Random(4)
    rows = [(i, " ".join("w" * rng.randint(1, 12) for _ in range(rng.randint(0, 60))), rng.choice(["a", "b", "c", None])) for i in range(400)] + [(400 + i, "rare words", "z") for i in range(3)]
    copies, size, target = mix_oracle(rows)
    got = {r.doc_id: r for r in mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    for (i, _, s), c, n in zip(rows, copies, size, strict=True):
        assert (got[i]["size"], got[i].copies, got[i].taken) == (n, c, c * n) and got[i].target == pytest.approx(target[s])


def test_shards_on_disk(spark, docs, tmp_path):
    plan = hilbert.write_shards(docs, str(tmp_path / "shards"), 4)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert same_rows(back.select(docs.columns).collect(), docs.collect())
    listed = {r.shard: r for r in plan.collect()}
    rows = back.collect()
    for s in range(4):
        own = [r for r in rows if r.shard == s]
        assert listed[s].rows == len(own) and listed[s].bytes == sum(len((r.text or "").encode()) + 16 for r in own)
        assert listed[s].min_source == min((r.source for r in own if r.source), default=None)
    many = spark.createDataFrame([(i, "t", "en", f"host{i % 100:03}") for i in range(3000)], "doc_id long, text string, lang string, source string")
    cells = many.select("source", hilbert.cells(many.withColumn("size", hilbert.F.lit(17)))[1].alias("cell")).distinct().collect()
    ranked = [r.cell for r in sorted(cells)]
    assert ranked == sorted(ranked) and len(set(ranked)) == 32
    few = spark.createDataFrame([(i, "t", "en", "abc"[i % 3]) for i in range(30)], "doc_id long, text string, lang string, source string")
    assert {(r.source, r.cell) for r in few.select("source", hilbert.cells(few.withColumn("size", hilbert.F.lit(17)))[1].alias("cell")).collect()} == {("a", 0), ("b", 1), ("c", 2)}


GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or (at your option) any later version."""


def licence_oracle(text):
    """Labels, by comparing every template with every place of a text."""
    words = re.findall(licences.WORD, (text or "").translate(str.maketrans(licences.UPPER, licences.LOWER)))
    out = {b for p, b in licences.BASE.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()}
    for label, _, key in licences.notices():
        out |= {label for i in range(len(words)) if words[i : i + len(key)] == key}
    return out


def test_licence_labels(spark):
    notices = {
        GPL: "gpl,gpl-3.0", GPL.replace("General", "Lesser General").replace("version 3", "version 2.1"): "gpl,lgpl,lgpl-2.1", GPL.replace("General", "Affero General"): "agpl,agpl-3.0,gpl", GPL.replace("version 3", "version 2"): "gpl,gpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": "mpl-2.0", "It is subject to the terms of the Mozilla Public License Version 2.0": "mpl-2.0",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that": "bsd",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted": "isc",
        "Licensed under the Apache License, Version 2.0 (the \"License\")": "apache,apache-2.0", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software": "mit-grant",
        "// SPDX-License-Identifier: MIT": "mit", "# SPDX-License-Identifier: GPL-2.0": "gpl-2.0", "SPDX-License-Identifier: BSD-3-Clause": "bsd-3-clause", "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0", "no notice at all": "",
        "x " * 400_000 + GPL + " y" * 400_000: "gpl,gpl-3.0", None: "",
    }
    rng = random.Random(9)
    vocabulary = sorted({w for _, n, _ in licences.notices() for w in n})
    texts = list(notices)
    for _ in range(300):
        w = []
        for _ in range(rng.randint(1, 4)):
            w += [rng.choice(vocabulary) for _ in range(rng.randint(0, 6))]
            n = list(rng.choice(licences.notices())[1])
            if rng.random() < 0.4:
                n[rng.randrange(len(n))] = rng.choice(vocabulary)
            w += n
        texts.append(" ".join(w))
    rows = {r.doc_id: r for r in licences.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        assert rows[i].labels == ",".join(sorted(licence_oracle(t))), t[:300] if t else t
        if t in notices:
            assert rows[i].labels == notices[t]


def test_licence_plan_does_not_grow(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    steps = lambda n: licences.scan(docs, licences.notices()[:n])._jdf.queryExecution().analyzed().toString().count("lambdafunction")
    assert steps(len(licences.notices())) == steps(5) > 0


def test_pipeline_against_a_sequential_version(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(30)
    vocabulary = ["".join(rng.choices("aeioulnrst", k=rng.randint(2, 9))) for _ in range(400)]
    line = lambda n: " ".join(rng.choices(vocabulary, k=n))
    common, rows, marks = line(9), [], []
    for i in range(150):
        text = "\n".join(line(rng.randint(4, 30)) for _ in range(rng.randint(1, 5)))
        text += f"\n{common}" if i % 6 == 0 else ""
        toxic = i % 4 == 1
        if toxic:
            text += " you stupid idiot" if i % 8 == 1 else " you st00pid 1diot stupid"
        rows.append((i, text, "en", "abc"[i % 3] if i % 10 else None))
        marks.append((i, int(toxic)))
    for i in range(150, 190):
        base = rows[rng.randrange(150)][1].split(" ")
        base[rng.randrange(len(base))] = "changed"
        rows.append((i, " ".join(base), "en", "a"))
    whole = [r for r in rows[:150] if r[0] % 6 and r[0] % 4 != 1 and r[1].count("\n") > 1]
    rows += [(200 + k, " ".join(r[1].split()), "en", "b") for k, r in enumerate(whole[:12])]
    rows += [(190, None, None, None), (None, "a clean text without any id", "en", "b"), (None, line(30), "en", "b"), (191, "", "en", "a"), (5, line(25), "en", "a")]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))

    model = toxicity.fit(docs, labels.where(~toxicity.held_out()))
    reader = toxicity.Reader(model)
    now = [r for r in rows if toxicity.scores(reader, [r[1]])[0] < 0.5]
    assert not any("stupid" in (r[1] or "") for r in now) and {r[0] for r in now} >= {i for i, t in marks if not t}
    from tests.llm.test_operators import line_oracle

    after = []
    for r, (_, _, _, drop) in zip(now, line_oracle([r[:2] for r in now]), strict=True):
        whole = (r[1] or "").split("\n")
        if not drop or len(drop) < sum(bool(x.strip()) for x in whole):
            after.append((r[0], "\n".join(x for k, x in enumerate(whole) if k not in drop) if drop else r[1], *r[2:]))
    sets = [minhash.shingles(r[1], 5) for r in after]
    group = list(range(len(after)))
    for i in range(len(after)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    first = {}
    for i in sorted(range(len(after)), key=lambda i: (after[i][0] is None, after[i][0] or 0)):
        first.setdefault(group[i], i)
    kept = [after[i] for i in range(len(after)) if first[group[i]] == i]
    assert len(rows) > len(now) > len(after) > len(kept)
    tokenizer, want = Tokenizer.from_file(byte_path()), []
    known = [r for r in kept if r[0] is not None]
    copies, _, _ = mix_oracle([(r[0] if r[0] is not None else "", r[1], r[3]) for r in kept])
    for r, c in zip(kept, copies, strict=True):
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids
        want += [(r[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest())] * c
    assert len(known) < len(kept)
    got = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert same_rows(got, want)
