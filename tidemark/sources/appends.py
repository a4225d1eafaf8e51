"""Audits of a declared key that follow appends.

The numbers of rows of each key and load stand on shelves by key. An append is counted
by key and meets the stored keys of its own shelves alone; a load given again takes
the place of what it was.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tidemark.functions.scalars import all_of, any_of
from tidemark.operators.quality import key_counts
from tidemark.sources.schemas import LOAD_SHELVES, Table
from tidemark.sources.store import ShelfStore, shelved


class AppendAudit:
    """Keys of a declared table, told load by load."""

    def __init__(self, store: ShelfStore, table: Table) -> None:
        self.store, self.key = store, list(table.key)
        fields = [table.schema[k] for k in self.key]
        fields += [StructField("load", IntegerType()), StructField("n_rows", LongType())]
        told = replace(
            table,
            name=f"{table.name}_keys",
            schema=StructType(fields),
            key=(*table.key, "load"),
            domains={},
        )
        self.keys = shelved(told)
        self.tables = (self.keys, LOAD_SHELVES)

    def append(self, rows: DataFrame, load: int) -> DataFrame:
        """Tell the rows of a load, and give the violations among its keys.

        The shelves of a load are noted before they are written, so a load that failed
        halfway or has lost rows since is replaced everywhere when given again.
        """
        counts = key_counts(rows, self.key).withColumn("load", F.lit(load))
        new = self.store.on_shelves(counts, *self.key).checkpoint()
        before = self.store.touched(self.store.read(LOAD_SHELVES, load))
        shelves = sorted({*self.store.touched(new), *before})
        if shelves:
            noted = [(shelf, load) for shelf in shelves]
            spark = rows.sparkSession
            self.store.replace(
                LOAD_SHELVES, spark.createDataFrame(noted, LOAD_SHELVES.schema).coalesce(1)
            )
            others = self.store.read_shelves(self.keys, shelves).where(F.col("load") != load)
            names = self.keys.schema.names
            self.store.rewrite(
                self.keys, others.select(*names).unionByName(new.select(*names)), shelves
            )
        stored = self.store.read_shelves(self.keys, shelves).alias("o")
        same = all_of([F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in self.key])
        return self._broken(stored.join(new.alias("n"), same, "left_semi"))

    def violations(self) -> DataFrame:
        """What ``key_audit`` gives for the rows of all loads."""
        return self._broken(self.store.read(self.keys))

    def _broken(self, counts: DataFrame) -> DataFrame:
        keys = counts.groupBy(*self.key).agg(F.sum("n_rows").alias("n_rows"))
        has_null = any_of([F.col(k).isNull() for k in self.key])
        return keys.withColumn("has_null", has_null).where(
            (F.col("n_rows") > 1) | F.col("has_null")
        )
