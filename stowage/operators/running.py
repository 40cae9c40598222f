"""Running sums in a global order, without bringing all rows to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stowage.session import scratch


def running_sums(df: DataFrame, order: str, columns: list[str], ranges: int | None = None, suffix: str = "_so_far") -> DataFrame:
    """df with <column><suffix> (long): the sum of a column over the rows up to and with this one, by `order`, whose values should be distinct.

    A distributed prefix sum: rows are dealt to ranges of `order` and stored, each range is summed, the ranges' sums are added up, which are as
    many numbers as there are ranges, and each range is scanned by itself from where the one before ended. Nulls of `order` come first, nulls
    of a column count as zero. A value that many rows share stays in one range.
    """
    spark = df.sparkSession
    many = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    where = scratch(spark)
    dealt = df.repartitionByRange(many, F.col(order).asc_nulls_first()).withColumn("_range", F.spark_partition_id())
    dealt.write.parquet(where)  # so that a range is the same rows in both passes
    dealt = spark.read.schema(dealt.schema).parquet(where)
    sums = dealt.groupBy("_range").agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in columns])
    before, offsets = dict.fromkeys(columns, 0), []
    for r in sorted(sums.collect(), key=lambda r: r["_range"]):  # one row a range
        offsets.append((r["_range"], *before.values()))
        before = {c: before[c] + r[c] for c in columns}
    names = [f"_before_{k}" for k in range(len(columns))]
    starts = spark.createDataFrame(offsets, ", ".join(["_range int", *(f"{n} long" for n in names)]))
    local = Window.partitionBy("_range").orderBy(F.col(order).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    rows = dealt.join(F.broadcast(starts), "_range")
    told = [(F.coalesce(F.sum(c).over(local), F.lit(0)) + F.col(n)).cast("long").alias(f"{c}{suffix}") for c, n in zip(columns, names)]
    return rows.select(*df.columns, *told)
