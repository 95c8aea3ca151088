"""What the corpus operators share: written intermediate tables, grouped streaming, hashing and components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import json
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

GOLD = np.uint64(0x9E3779B97F4A7C15)
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch(spark: SparkSession) -> str:
    """The shared folder of the cluster (spark.checkpoint.dir); on a single machine a temporary one where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = f"file://{tempfile.mkdtemp(prefix='lorekit-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/lorekit"


def settle(df: DataFrame, tag: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write df once to the shared folder and read it back: lineage is cut, lost executors recompute nothing before it."""
    path, conf = f"{scratch(df.sparkSession)}/{tag}-{uuid.uuid4().hex}", df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")  # its shuffle files go with the end of the write
    try:
        df.write.options(**(options or {})).parquet(path)
    finally:
        conf.set(CLEANUP, before)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.settled_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete settled tables that nothing reads any more."""
    for t in tables:
        jvm = t.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(t.settled_at)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def salted(rows: DataFrame, one: DataFrame, key: str, spread: str, salts: int = 16) -> DataFrame:
    """rows joined with one, which has a row for each key: rows of a hot key are dealt over so many tasks."""
    salt = F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")
    copies = one.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("_salt", salt).join(copies, [key, "_salt"]).drop("_salt")


def sweep(spark: SparkSession) -> None:
    """Have the driver collect garbage: shuffle files go once it finds the plans behind settled tables unused."""
    gc.collect()  # Python's frames hold the JVM's
    spark._jvm.System.gc()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)  # what Python has freed goes back to the system


def with_batches(spark: SparkSession, rows: int) -> SparkSession:
    """A session like spark whose Arrow batches have so many rows: large rows would else fill memory a batch."""
    other = type(spark)(spark.sparkContext, spark._jsparkSession.cloneSession())
    other.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return other


def resettled(table: DataFrame, spark: SparkSession) -> DataFrame:
    """A settled table, read in another session."""
    out = spark.read.schema(table.schema).parquet(table.settled_at)
    out.settled_at = table.settled_at
    return out


def packed(df: DataFrame, name: str = "row") -> Column:
    """All columns of df as one, so that no name of theirs meets another."""
    return F.struct(*(F.col(f"`{c.replace('`', '``')}`") for c in df.columns)).alias(name)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit words that spreads every input bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Rows of sorted batches, one table for each run of equal keys, whatever the batch borders."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        if held and held[-1].column(held[-1].schema.get_field_index(key))[-1].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        edges = [0, *cuts.tolist(), n]
        for a, b in zip(edges[:-2], edges[1:-1], strict=True):
            yield pa.Table.from_batches([*held, batch.slice(a, b - a)])
            held = []
        held.append(batch.slice(edges[-2], n - edges[-2]))
    if held:
        yield pa.Table.from_batches(held)


def grouped(df: DataFrame, key: str, fn: Callable[[pa.Table], dict[str, list] | None], schema: str) -> DataFrame:
    """fn for each group of key; groups stream through sorted partitions, so thousands of small ones cost little.

    fn returns columns by name, or None for no rows. One group at a time is in memory: callers bound group sizes.
    """

    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, n = None, 0
        for t in runs(batches, key):
            got = fn(t)
            if got is None:
                continue
            out = out or {k: [] for k in got}
            for k, v in got.items():
                out[k].extend(v)
            n += len(next(iter(got.values())))
            if n >= 20_000:
                yield pa.RecordBatch.from_pydict(out, schema=kinds)
                out, n = None, 0
        if out:
            yield pa.RecordBatch.from_pydict(out, schema=kinds)

    return df.repartition(key).sortWithinPartitions(key).mapInArrow(stream, schema)


def tiles(df: DataFrame, key: str, id: str, blocks: Column) -> DataFrame:
    """df with tile, lower: rows of a group of one block keep together; the blocks of a larger group meet two by two.

    lower marks the rows of a tile's lower block. In a tile of two blocks only rows of different blocks need comparing,
    as every block also meets itself.
    """
    df = df.withColumn("_n", F.greatest(blocks.cast("int"), F.lit(1))).withColumn("_k", F.pmod(F.xxhash64(id), F.col("_n")).cast("int"))
    df = df.withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    tile = F.xxhash64(key, F.least("_k", "_j"), F.greatest("_k", "_j"))
    return df.withColumn("tile", tile).withColumn("lower", F.col("_k") <= F.col("_j")).drop("_n", "_k", "_j")


#: A node with more than one in so many of all links counts as a hub; there are at most twice as many hubs.
HUBS = 1000


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (a, b): label is the smallest node it can reach.

    Alternating stars: a node tells its larger neighbours of its least one, then all smaller ones. A round deals the links
    by their nodes twice, and the number of rounds follows the logarithm of the longest chain. Links of a hub are dealt
    over many tasks: the driver takes the least neighbour of each hub, whose number is bounded, and a row of totals,
    nothing else.
    """
    spark = edges.sparkSession
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    e = settle(e, "links")
    links, old = e.count(), []
    while links:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        node = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        hub = F.when(F.col("n") > links // HUBS + 64, F.struct("u", F.least("u", "m").alias("m")))
        # Stars are done when each node is a least one or has one neighbour. Hubs: 2 * HUBS at most.
        now = node.agg(F.count_if(F.expr("m < u and n > 1")).alias("open"), (F.sum("n") / 2).cast("long").alias("links"), F.collect_list(hub).alias("hubs")).first()
        discard(*old)
        if not now.open:
            break
        links = now.links
        known = None
        if now.hubs:
            hubs = json.dumps([{"u": h.u, "hub": h.m} for h in now.hubs])
            known = F.broadcast(spark.range(1).select(F.inline(F.from_json(F.lit(hubs), "array<struct<u:long,hub:long>>"))))

        def least(rows: DataFrame, known: DataFrame | None = known) -> DataFrame:
            """rows (u, v) with m, the least v of u; for a hub its least neighbour, so that its rows need not meet."""
            if known is None:
                return rows.withColumn("m", F.min("v").over(W.partitionBy("u")))
            rows = rows.join(known, "u", "left").withColumn("salt", F.when(F.col("hub").isNotNull(), F.pmod(F.xxhash64("v"), F.lit(64))).otherwise(0))
            return rows.withColumn("m", F.coalesce("hub", F.min("v").over(W.partitionBy("u", "salt"))))

        large = least(both).withColumn("m", F.least("u", "m")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pair = lambda x: F.struct(F.greatest(x, "m").alias("u"), F.least(x, "m").alias("v"))
        old = [e]
        e = settle(least(large).select(F.inline(F.array(pair("u"), pair("v")))).where("u <> v").distinct(), "links")
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).union(e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
