"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations only.

Each document draws the exponential key -ln(u) / quality, where u is a number from the digest of its id. A source whose target holds
whole epochs takes every document that many times; the rest of its budget goes to the documents of smallest key,
prefix-summed until the budget is met (the document at the border counts if that comes nearer to it).

A source may hold a third of all rows: rows are dealt by ranges of source and key, of near equal counts, the ranges' sums
are prefix-summed within the source, and only the rows of one range are sorted together.

Defined cases: a null or blank text has size 0 and takes no words; the null source comes last; a source of size 0 has
target 0; equal keys go by doc_id; repeated rows are documents of their own; reruns agree; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lorekit.llm.common import discard, packed, settle

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3.0


def prose_quality() -> Column:
    """Between 0.25 and 1: the nearer a text's bytes a word are to those of prose (about 6), the higher."""
    per_word = F.col("bytes") / F.greatest(F.col("size"), F.lit(1))
    return F.greatest(F.lit(0.25), 1.0 / (1.0 + F.abs(F.log(F.greatest(per_word, F.lit(1.0)) / 6.0))))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """sizes (source, source_size) with target: all words shared by weight, no source above most times its size.

    Sources reach their cap in the order of cap / weight; the level of those below it follows from two prefix sums.
    These windows run over one row for each source.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    cyc = F.array(*map(F.lit, weights))
    s = sizes.withColumn("w", F.element_at(cyc, (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")))
    s = s.withColumn("cap", most * F.col("source_size"))
    rank = W.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    every = W.partitionBy()
    full = F.coalesce(F.sum("cap").over(rank.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("w").over(rank.rowsBetween(0, W.unboundedFollowing))
    s = s.withColumn("level", (F.sum("source_size").over(every) - full) / left).withColumn("rank", F.row_number().over(rank))
    s = s.withColumn("fits", F.col("level") * F.col("w") <= F.col("cap"))
    level = F.min_by("level", F.when(F.col("fits"), F.col("rank"))).over(every)
    return s.withColumn("target", F.least(F.col("cap"), level * F.col("w")).cast("double")).select(*sizes.columns, "target")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST, seed: int = 7, quality: Column | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies. quality: an expression over size, bytes and the columns of docs."""
    rows = docs.select("doc_id", "text", "source") if quality is None else docs
    return _mix(rows.withColumn("_row", F.lit(0)), weights, most, seed, quality).drop("_row")


def _mix(docs: DataFrame, weights: tuple[float, ...], most: float, seed: int, quality: Column | None) -> DataFrame:
    """mix, with the column _row of docs, which sets apart rows that are alike in all else."""
    spark = docs.sparkSession
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.withColumn("size", size).withColumn("bytes", F.coalesce(F.octet_length("text"), F.lit(0)))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")), 1, 12)
    u = (F.conv(digits, 16, 10).cast("long").cast("double") + 0.5) / float(1 << 48)
    key = -F.log(u) / (prose_quality() if quality is None else quality)
    rows = rows.select("_row", "doc_id", "source", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("name"), "size", key.alias("key"))
    keys = settle(rows, "keys")
    order = ["name", "key", "doc_id", "size", "_row"]
    dealt = keys.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
    rows = settle(dealt.withColumn("bucket", F.spark_partition_id()), "buckets")
    sums = rows.groupBy("name", "source", "bucket").agg(F.sum("size").alias("words"))
    plan = targets(sums.groupBy("name", "source").agg(F.sum("words").alias("source_size")), weights, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = plan.withColumn("epochs", whole).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    ahead = F.coalesce(F.sum("words").over(W.partitionBy("name").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select("name", "bucket", ahead.alias("ahead")).join(plan.drop("source"), "name")
    rows = rows.join(sums, ["name", "bucket"])
    within = W.partitionBy("name", "bucket").orderBy(*order[1:])
    start = F.col("ahead") + F.coalesce(F.sum("size").over(within.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("start", start)
    last = (F.col("start") < F.col("rest")) & (2 * F.col("start") + F.col("size") <= 2 * F.col("rest"))
    rows = rows.withColumn("copies", F.col("epochs") + last.cast("long"))
    rows = rows.select("_row", "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")
    discard(keys)
    return rows


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST, seed: int = 7) -> DataFrame:
    """The rows of docs, each as many times as the mix takes it; each row by itself, also where rows repeat a doc_id or
    have none. Other columns, whatever their names, are kept as they are."""
    rows = settle(docs.select(packed(docs), F.monotonically_increasing_id().alias("_row")), "rows")
    copies = _mix(rows.select("_row", "row.doc_id", "row.text", "row.source"), weights, most, seed, None).where("copies > 0").select("_row", "copies")
    taken = rows.join(copies, "_row").withColumn("n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return taken.select("row.*")
