"""A pool as a value: each change gives a new pool. Rows: key, record fields, pos (the order of entry)."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorekit.schema import FIELDS, LOOSE, typed


@dataclass(frozen=True)
class Pool:
    """Records by id. Inserting an id that is there replaces its record and keeps its place."""

    rows: DataFrame

    @classmethod
    def of(cls, records: DataFrame, order: str = "pos") -> Pool:
        key = F.col("key") if "key" in records.columns else F.col("id")
        return cls(records.select(key.alias("key"), *FIELDS, F.col(order).cast("long").alias("pos")))

    def _one(self, record: dict) -> DataFrame:
        spark: SparkSession = self.rows.sparkSession
        row = typed(F.from_json(F.lit(json.dumps(record)), LOOSE))
        return spark.range(1).select(row.alias("r")).select(F.col("r.id").alias("key"), *(F.col(f"r.{f}").alias(f) for f in FIELDS))

    def insert(self, record: dict) -> Pool:
        key = record["id"]
        place = self.rows.agg(F.coalesce(F.max(F.when(F.col("key") == key, F.col("pos"))), F.max("pos") + 1, F.lit(0).cast("long")).alias("pos"))
        return Pool(self.rows.where(F.col("key") != key).unionByName(self._one(record).crossJoin(F.broadcast(place))))  # one row each

    def delete(self, key: str) -> Pool:
        return Pool(self.rows.where(F.col("key") != key))

    def replace(self, old: str, record: dict) -> Pool:
        return self.delete(old).insert(record)

    def get(self, key: str) -> dict | None:
        row = self.rows.where(F.col("key") == key).select(F.to_json(F.struct(*FIELDS)).alias("j")).first()
        return json.loads(row.j) if row else None

    def get_all(self) -> DataFrame:
        return self.rows.select(*FIELDS, "pos").orderBy("pos")

    def __len__(self) -> int:
        return self.rows.count()

    def to_json(self) -> str:
        """All records in order; for pools, which their cap bounds."""
        rows = self.rows.select("pos", F.to_json(F.struct(*FIELDS)).alias("j")).orderBy("pos").toLocalIterator()
        return json.dumps([json.loads(r.j) for r in rows], ensure_ascii=False, indent=2)
