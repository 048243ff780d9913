"""Running sums over a whole table in a given order, without bringing the table to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import save


def running_sums(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """df with, for each name, the sum of its (integer) column over all rows before this one in the order, which must be total.

    Rows are range-partitioned; only one row for each partition is summed up centrally.
    """
    parts = save(df.select("*", *[c.cast("long").alias(f"_{n}") for n, c in sums.items()]).repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranged")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy("_part").agg(*[F.sum(f"_{n}").alias(f"_t_{n}") for n in sums])
    totals = totals.select("_part", *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_t_{n}") for n in sums])
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = parts.select("*", *[F.coalesce(F.sum(f"_{n}").over(inside), F.lit(0)).alias(f"_i_{n}") for n in sums]).join(F.broadcast(totals), "_part")
    return out.select(*df.columns, *[(F.col(f"_t_{n}") + F.col(f"_i_{n}")).alias(n) for n in sums])
