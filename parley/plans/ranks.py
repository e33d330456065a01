"""Exact global ranks without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def with_rank(df: DataFrame, order: list[Column | str], name: str, bucket: Column | None = None, buckets: int = 64) -> DataFrame:
    """A 0-based rank by ``order`` (a total order). Rows are numbered inside buckets that follow the order, and the
    buckets' sizes, a few rows, are added up.

    ``bucket`` is an expression that does not fall along the order; without one the first order column, a number, is cut at
    its quantiles, so that outlying values do not leave most rows in one bucket.
    """
    if bucket is None:
        name_of = order[0] if isinstance(order[0], str) else "_first"
        df = df if isinstance(order[0], str) else df.withColumn("_first", order[0])
        limits = sorted({float(x) for x in df.approxQuantile(name_of, [k / buckets for k in range(1, buckets)], 0.5 / buckets)})
        below = F.array_size(F.filter(F.lit(limits).cast("array<double>"), lambda x: x <= F.col(name_of))) if limits else F.lit(0)
        df = df.withColumn("_bucket", F.coalesce(below, F.lit(-1)).cast("int")).drop("_first")
    else:
        df = df.withColumn("_bucket", bucket)
    sizes = df.groupBy("_bucket").agg(F.count("*").alias("_size"))
    before = sizes.select("_bucket", (F.sum("_size").over(Window.orderBy("_bucket")) - F.col("_size")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order))
    return df.withColumn("_inside", inside).join(F.broadcast(before), "_bucket").withColumn(name, F.col("_before") + F.col("_inside") - 1).drop("_bucket", "_inside", "_before")
