"""The registered corpus queries over whole small tables, against SQL, the libraries and plain Python."""

import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from lorekit.llm import licences, queries  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    df = queries.QUERIES[name](spark, SF)
    result = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    mine, theirs = sorted(map(tuple, df.select(names).collect())), sorted(result.fetchall())
    assert len(mine) == len(theirs)
    for a, b in zip(mine, theirs, strict=True):
        assert all(x == (pytest.approx(y, rel=1e-12) if isinstance(y, float) else y) for x, y in zip(a, b, strict=True))


def test_lines_of_documents(spark, texts):
    from tests.llm.test_operators import line_oracle

    want = {i: (c, n, drop) for i, c, n, drop in line_oracle(sorted(texts.items()))}
    got = {r.doc_id: (r.class_id, r.n_links, list(r.dropped)) for r in queries.op1_edit_join_lines(spark, SF).collect()}
    assert got == want


def test_shards_follow_the_law(spark, texts):
    rows = queries.op2_hilbert_shards(spark, SF).collect()
    counts = np.bincount([r.shard for r in rows], minlength=40)
    assert sorted(r.doc_id for r in rows) == sorted(texts) and counts.max() - counts.min() <= 1 and len(counts) == 40
    for s in range(40):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
    assert all((r["size"], r.text_crc32) == (len(texts[r.doc_id].encode()) + 16, zlib.crc32(texts[r.doc_id].encode())) for r in rows)
    order = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in order] == sorted(r.curve for r in rows)


def test_token_queries_equal_the_library(spark, texts):
    words, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    got = {r.doc_id: r for r in queries.op4_rans_tokens(spark, SF).collect()}
    for i in sorted(texts):
        ids = np.array([*words.encode(texts[i], add_special_tokens=False).ids, 2], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    pieces = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in queries.op5_forced_boundary_bpe(spark, SF).collect():
        ids = pieces.encode(texts[r.doc_id], add_special_tokens=False).ids
        back = pieces.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())


def test_media_and_licences(spark, texts):
    for r in queries.op8_png_media(spark, SF).collect():
        raw = texts[r.doc_id].encode()
        full = raw + b" " * (-len(raw) % 192 or (0 if raw else 192))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-16:]))
    lower = str.maketrans(licences.UPPER, licences.LOWER)
    keys = [(label, key) for label, _, key in licences.notices()]
    for r in queries.op10_licence_scan(spark, SF).collect():
        words = re.findall(licences.WORD, texts[r.doc_id].translate(lower))
        at = [(i, b) for p, b in licences.BASE.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        own = {label for label, key in keys if any(words[i : i + len(key)] == key for i in range(len(words)))}
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(words), len(at), min(at)[0] if at else None, max(at)[0] if at else None)
        assert r.base_labels == ",".join(sorted({b for _, b in at})) and r.labels == ",".join(sorted({b for _, b in at} | own))


def test_toxicity_and_neighbours(spark, texts):
    rows = queries.op7_toxicity(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(texts) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    vectors = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect() if r.embedding is not None}
    ids = np.array(sorted(i for i, v in vectors.items() if np.isfinite(v).all() and v.any()))
    points, hits, total, got = np.stack([vectors[i] for i in ids]), 0, 0, {}
    for r in queries.op9_pruned_graph(spark, SF).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for q in (i for i in ids.tolist() if i % 100 == 0):
        d = np.sqrt(((points - vectors[q]) ** 2).sum(axis=1))
        best = [i for _, i in sorted((x, i) for x, i in zip(d.tolist(), ids.tolist(), strict=True) if i != q)[:10]]
        hits, total = hits + len(set(best) & {i for _, i, _ in got[q]}), total + len(best)
        assert [k for k, _, _ in sorted(got[q])] == list(range(1, len(best) + 1)) and [(s, i) for _, i, s in sorted(got[q])] == sorted((s, i) for _, i, s in got[q])
    assert hits >= 0.9 * total
