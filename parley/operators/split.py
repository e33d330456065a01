"""Exact splits and samples by hashed order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parley.plans.ranks import with_rank

SEED = 42


def _hash(keys, seed: int) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def split(df: DataFrame, train: float = 0.8, validation: float = 0.1, seed: int = SEED, keys=("row_id",), group_by: str | None = None) -> DataFrame:
    """``df`` with ``split``: the first floor(n * train) rows in hashed order are train, the next floor(n * validation)
    validation, the rest test. Ranks are counted in 256 buckets of the hash. With ``group_by``, rows of one group stay
    together and the sizes are by group."""
    if group_by:
        groups = split(df.select(group_by).distinct(), train, validation, seed, (group_by,))
        return df.join(groups, group_by)
    n = df.agg(F.count("*").alias("_n"))
    ranked = with_rank(df.withColumn("_h", _hash(keys, seed)), ["_h", *keys], "_rank", F.conv(F.substring("_h", 1, 2), 16, 10).cast("int"))
    first = F.floor(F.col("_n") * train)
    at = F.when(F.col("_rank") < first, "train").when(F.col("_rank") < first + F.floor(F.col("_n") * validation), "validation").otherwise("test")
    return ranked.join(F.broadcast(n), how="cross").withColumn("split", at).drop("_h", "_rank", "_n")  # one row


def split_groups(df: DataFrame, group: str, train: float = 0.8, validation: float = 0.1, seed: int = SEED) -> DataFrame:
    """``df`` with ``split``, rows of one group together, and the sizes counted in rows.

    Groups stand in hashed order, each on as many places as it has rows. The first floor(n * train) places are train, the next
    floor(n * validation) validation, the rest test. A group that reaches over a border goes whole to the split that has most of
    its places, the earlier of equal ones; so a border moves by less than half a group. Rows without a group are one group.

    The groups' sizes are added up within 4,096 ranges of the hash, and the ranges' sums, a few rows, before them. What comes of
    that are the groups at the two borders alone: the rows themselves are compared with these, and neither shuffled nor
    joined, however large a group is."""
    order = F.md5(F.concat_ws("|", F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")), F.lit(str(seed))))
    sizes = df.select(order.alias("_h")).groupBy("_h").agg(F.count("*").alias("_n")).withColumn("_range", F.substring("_h", 1, 3))
    sums = sizes.groupBy("_range").agg(F.sum("_n").alias("_sum"))
    before = sums.select("_range", (F.sum("_sum").over(Window.orderBy("_range")) - F.col("_sum")).alias("_before"))
    inside = F.sum("_n").over(Window.partitionBy("_range").orderBy("_h"))
    placed = sizes.withColumn("_stop", inside).join(F.broadcast(before), "_range").withColumn("_stop", F.col("_stop") + F.col("_before")).withColumn("_start", F.col("_stop") - F.col("_n"))
    total = sums.agg(F.sum("_sum").alias("_all")).select(F.floor(F.col("_all") * train).alias("_a"), (F.floor(F.col("_all") * train) + F.floor(F.col("_all") * validation)).alias("_b"), "_all")
    shares = [F.least(F.col("_stop"), high) - F.greatest(F.col("_start"), low) for low, high in ((F.lit(0), F.col("_a")), (F.col("_a"), F.col("_b")), (F.col("_b"), F.col("_all")))]
    most = F.greatest(*shares)
    which = F.when(shares[0] == most, "train").when(shares[1] == most, "validation").otherwise("test")
    held = lambda place: (F.col("_start") <= place) & (place < F.col("_stop"))
    at = placed.join(F.broadcast(total), held(F.col("_a")) | held(F.col("_b")))
    border = lambda place, name: F.max(F.when(held(place), F.struct(F.col("_h").alias("h"), which.alias("split")))).alias(name)
    borders = at.agg(border(F.col("_a"), "_first"), border(F.col("_b"), "_second"))  # one row
    rows = df.withColumn("_h", order).join(F.broadcast(borders), how="cross")
    # no group at a border: the border is behind all groups
    first, second = F.coalesce("_first.h", F.lit("~")), F.coalesce("_second.h", F.lit("~"))
    split = F.when(F.col("_h") == first, F.col("_first.split")).when(F.col("_h") == second, F.col("_second.split")).when(F.col("_h") < first, "train").when(F.col("_h") < second, "validation").otherwise("test")
    return rows.withColumn("split", split).drop("_h", "_first", "_second")


def split_sizes(df: DataFrame, **options) -> DataFrame:
    return split(df, **options).groupBy("split").agg(F.count("*").alias("n"))


def intent_counts(df: DataFrame, intent: str = "intent", **options) -> DataFrame:
    return split(df, **options).groupBy("split", F.coalesce(intent, F.lit("unknown")).alias("intent")).agg(F.count("*").alias("n"))


def sample(df: DataFrame, k: int, seed: int = SEED, keys=("row_id",)) -> DataFrame:
    """Exactly min(k, n) rows, the same in every run."""
    return df.orderBy(_hash(keys, seed), *keys).limit(k)
