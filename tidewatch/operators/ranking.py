"""Numbering all rows of a table in one order, without bringing them to one task."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.plans.tables import settled


def numbered(df: DataFrame, order: list[Column], name: str, parts: int | None = None) -> DataFrame:
    """df with `name`: 1 for the first row in the order, and so on. The order has to be one of all rows, else equal ones are numbered
    in any order. Rows are dealt by ranges of the order and numbered there; only the ranges' sizes, a row each, meet in one place."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = settled(df.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()))
    own = dealt.withColumn("_place", F.row_number().over(Window.partitionBy("_range").orderBy(*order)))
    sizes = dealt.groupBy("_range").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("_range", before.alias("_before"))
    return own.join(F.broadcast(sizes), "_range").withColumn(name, (F.col("_before") + F.col("_place")).cast("long")).drop("_range", "_place", "_before")
