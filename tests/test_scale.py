"""Queries against their SQL on inputs that the small tables don't hold, and steps that must not grow with the square."""

import duckdb
import pytest

from lorekit.plans import queries


def documents(spark, folder, texts, n_chars=lambda i: i):
    rows = [(i, t, ("en", "de")[i % 2], "s", n_chars(i)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def same_as_sql(spark, sf_dir, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf_dir}/documents.parquet/*.parquet'")
    result = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    mine = [tuple(r) for r in queries.QUERIES[name](spark, sf_dir).select(*names).collect()]
    assert sorted(map(repr, mine)) == sorted(map(repr, result.fetchall()))
    return mine


@pytest.mark.parametrize("name", ["tier_classify", "tier_reasons"])
def test_tiers_of_odd_texts_equal_sql(spark, tmp_path, name):
    """Numbers beside letters that aren't ASCII, and line breaks where a text is cut."""
    texts = [f"{w}{s}en_b de_a reset{s}fifo 5ß 12 é4{s}3 counter{s}{w}" * (1 + i % 4) for i in range(150) for w in ("x", "de_a ") for s in ("\n", "\t\n", "  ", " ")]
    same_as_sql(spark, documents(spark, tmp_path, texts), name)


def common_words(i, n=40):
    """Texts that share most of their words with all others; every fifth is nearly the one before."""
    k = i - (i % 5 == 4)
    return "reset width in counter state " + " ".join(f"w{j}" for j in range(n) if (j * 7 + k * 13) % 3) + f" Use assign error checker u{i} " + " ".join(f"v{(k * j) % 211}" for j in range(1, n))


def test_similar_pairs_are_never_rows_before_they_are_similar(spark, tmp_path):
    sf_dir = documents(spark, tmp_path, [common_words(i) for i in range(300)])
    assert same_as_sql(spark, sf_dir, "jaccard_pairs")
    assert "Join" not in queries.QUERIES["jaccard_pairs"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["candidate_recall", "merge_decide", "merge_prompts", "apply_ops"])
def test_recall_makes_no_row_of_a_pair_below_the_best(spark, tmp_path, name):
    """Tokens in common were counted from a row for each pair and token."""
    sf_dir = documents(spark, tmp_path, [common_words(i) * 3 for i in range(160)])
    assert same_as_sql(spark, sf_dir, name) or name == "merge_prompts"
    assert "both_p" not in queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["dup_pairs", "consolidate_pairs"])
def test_pairs_of_a_group_are_never_rows_before_they_are_similar(spark, tmp_path, name):
    sf_dir = documents(spark, tmp_path, [common_words(i - i % 4) * 3 + str(i) for i in range(400)], lambda i: i - i % 4)
    assert same_as_sql(spark, sf_dir, name)
    assert "Join" not in queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()


def test_spool_lines_are_numbered_without_one_task_for_all(spark, tmp_path):
    sf_dir = documents(spark, tmp_path, [common_words(i) * 3 for i in range(160)])
    assert same_as_sql(spark, sf_dir, "spool_roundtrip")
    plan = queries.QUERIES["spool_roundtrip"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(ord#" not in plan
