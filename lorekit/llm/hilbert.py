"""Shards along a Hilbert curve.

Metadata dimensions are quantised to a few bits each, rows are sorted by their place on the curve, and the sorted
order is cut into runs whose row counts differ by one at most (law `rows`). Rows that are alike in all dimensions lie
in neighbouring runs, so a filter on any of them prunes most shards by their ranges.

The sort is a range partitioning of narrow rows; places in the global order come from the partitions' row counts (one
row for each partition), never from a window over all rows. Ties on the curve go by checksum, then by doc_id.

Defined cases: a null text counts 0 bytes and has checksum 0; null dimensions fall in cell 0; null doc_ids sort first;
repeated rows each take a slot; fewer rows than shards leave the last shards empty; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lorekit.llm.common import packed, settle

BITS = 5


def hilbert_index(axes: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The place of each row of axes (n, dims) on the curve that visits all cells of a cube with 2**bits cells a side."""
    x = np.array(axes, np.int64).T.copy()
    dims, top = len(x), 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(dims):
            turned = (x[i] & q) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip, q = np.zeros_like(x[0]), top
    while q > 1:
        flip ^= np.where(x[-1] & q, q - 1, 0)
        q >>= 1
    x ^= flip
    out = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << 1) | ((x[i] >> bit) & 1)
    return out


def curve(dims: list[Column]) -> Column:
    def place(*axes: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.stack(axes, axis=1)))

    return F.pandas_udf(place, T.LongType())(*dims)


def _cuts(docs: DataFrame, column: str) -> list[str]:
    """The least value of each cell: distinct values in order, as many to a cell, or one where there are few."""
    values = docs.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    by = W.orderBy(column)  # distinct values, not rows
    cell = F.floor((F.row_number().over(by) - 1) * (1 << BITS) / F.greatest(F.count(F.lit(1)).over(W.partitionBy()), F.lit(1 << BITS)))
    ranked = values.select(F.col(column).alias("value"), cell.alias("cell")).groupBy("cell").agg(F.min("value").alias("value"))
    return sorted(r.value for r in ranked.collect())  # a row for each cell


def cells(docs: DataFrame) -> list[Column]:
    """Language, source and size of a document, each as a number of BITS bits that grows with the value."""

    def named(column: str) -> Column:
        cuts = _cuts(docs, column)
        below = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda x: x <= F.col(column))) - 1 if cuts else F.lit(0)
        return F.coalesce(F.when(F.col(column).isNotNull(), below), F.lit(0))

    return [named("lang"), named("source"), F.least(F.lit((1 << BITS) - 1), F.floor(2 * F.log2(F.col("size") + 1)) - 8).cast("int")]


def hilbert_shards(docs: DataFrame, shards: int = 40, dims: list[Column] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, and curve: each row's place among the cells.

    dims: numbers below 2**BITS, expressions over the columns of docs and size.
    """
    rows = docs if dims else docs.select("doc_id", "text", "lang", "source")
    return _place(rows.withColumn("_row", F.lit(0).cast("long")), shards, dims).drop("_row")


def _place(docs: DataFrame, shards: int, dims: list[Column] | None) -> DataFrame:
    """hilbert_shards, with the column _row of docs, which sets apart rows that are alike in all else."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = docs.withColumn("size", F.octet_length(text).cast("long") + 16)
    dims = [F.greatest(F.lit(0), d) for d in dims or cells(docs)]
    rows = rows.select("_row", "doc_id", "size", F.crc32(text.cast("binary")).alias("text_crc32"), curve(dims).alias("curve"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["curve", "text_crc32", "doc_id", "size", "_row"]
    placed = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    part, seat = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    placed = settle(placed.select("_row", "doc_id", "size", "text_crc32", "curve", part.alias("part"), seat.alias("seat")), "curve")
    counts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), F.sum("n").over(W.partitionBy()).alias("total"))
    out = placed.join(F.broadcast(starts), "part")  # a row for each shuffle partition
    rank, short, more = F.col("start") + F.col("seat"), F.floor(F.col("total") / shards), F.col("total") % shards
    out = out.select("_row", "doc_id", "size", "text_crc32", "curve", rank.alias("rank"), short.alias("short"), more.alias("more"))
    long = F.col("more") * (F.col("short") + 1)
    late = F.greatest(F.col("short"), F.lit(1))
    shard = F.when(F.col("rank") < long, F.floor(F.col("rank") / (F.col("short") + 1))).otherwise(F.col("more") + F.floor((F.col("rank") - long) / late))
    slot = F.when(F.col("rank") < long, F.col("rank") % (F.col("short") + 1)).otherwise((F.col("rank") - long) % late)
    return out.select("_row", "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), shard.cast("int").alias("shard"), slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve")


def write_shards(docs: DataFrame, path: str, shards: int = 40, columns: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """docs as Parquet under path, one folder of files for each shard (column `shard` in the folder's name, which docs must
    not have), rows in slot order. Returns the manifest: for each shard its rows, bytes and the least and greatest value
    of each of columns, for a reader to prune by. Each row is written once, also where rows repeat a doc_id or have none."""
    if "shard" in map(str.lower, docs.columns):
        raise ValueError("the files' folders are named by shard")
    rows = settle(docs.select(packed(docs), F.monotonically_increasing_id().alias("_row")), "rows")
    placed = settle(_place(rows.select("_row", "row.doc_id", "row.text", "row.lang", "row.source"), shards, None).select("_row", "shard", "slot", F.col("size").alias("bytes")), "placed")
    rows = rows.join(placed, "_row")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows.repartitionByRange(n, "shard", "slot").sortWithinPartitions("shard", "slot").select("row.*", "shard").write.partitionBy("shard").parquet(path)
    ends = [f(f"row.{c}").alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))]
    return rows.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.sum("bytes").alias("bytes"), *ends)
