"""Quota sampling: rows of a group in a pseudo-random order until their seconds reach a target, with backfill.

A running sum over a whole group would sort the group in one task. Here a group is cut into buckets by the leading
digits of its hash-valued order: bucket sums and their running totals, of a bounded number of rows, come first, and
a window then only orders the rows of one bucket. So work is spread however few groups there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from lodeweave.scratch import written

#: Hexadecimal digits of the order that make a bucket: 16 ** DIGITS buckets a group.
DIGITS = 3


def prior_sum(rows: DataFrame, by: list[str], value: Column, order: str = "priority", name: str = "prior") -> DataFrame:
    """Adds the sum of ``value`` over the rows of the group that come before in ``order``, a lower-case hexadecimal hash."""
    rows = rows.withColumn("__bucket", F.substring(order, 1, DIGITS)).withColumn("__value", value)
    sums = rows.groupBy(*by, "__bucket").agg(F.sum("__value").alias("__sum"))
    before = W.partitionBy(*by).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    base = sums.select(*[F.col(c).alias(f"__{c}") for c in by], F.col("__bucket").alias("__of"), F.coalesce(F.sum("__sum").over(before), F.lit(0.0)).alias("__base"))
    same = F.col("__bucket").eqNullSafe(F.col("__of"))
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    inside = W.partitionBy(*by, "__bucket").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    joined = rows.join(base, same)
    return joined.withColumn(name, F.col("__base") + F.coalesce(F.sum("__value").over(inside), F.lit(0.0))).drop("__bucket", "__value", "__of", "__base", *[f"__{c}" for c in by])


def until(rows: DataFrame, by: list[str], target: Column, seconds: str = "estimated_ja_seconds", order: str = "priority") -> DataFrame:
    """Adds taken: true while what has been taken before is below the target, so a group exceeds it by a row at most."""
    return prior_sum(rows, by, F.col(seconds), order).withColumn("taken", F.coalesce(F.col("prior") < target, F.lit(False))).drop("prior")


def targets_of(hours: dict[str, float], shares: dict[str, float]) -> list[tuple[str, str, float, float]]:
    """(corpus, length_bin, seconds of the bin, seconds of the corpus), worked out in double precision on the driver."""
    return [(c, b, h * s * 3600, h * 3600) for c, h in hours.items() for b, s in shares.items()]


def selected(train: DataFrame, hours: dict[str, float], shares: dict[str, float], seconds: str = "estimated_ja_seconds") -> DataFrame:
    """Adds selected: each length bin up to its share of the corpus's hours, then any rows, by priority, for what is missing.

    Rows of a corpus or bin without a target aren't selected. priority is a hash, unique in a corpus.
    """
    spark = train.sparkSession
    goals = spark.createDataFrame(targets_of(hours, shares), "__c string, __b string, __bin_goal double, __goal double")
    # a row for each corpus and bin of the configuration, whatever the input
    train = written(train, "quota-rows")  # it is read several times
    df = train.join(F.broadcast(goals), (F.col("corpus") == F.col("__c")) & (F.col("length_bin") == F.col("__b")), "left").drop("__c", "__b")
    first = until(df, ["corpus", "length_bin"], F.col("__bin_goal"), seconds).withColumnRenamed("taken", "__first")
    # a row for each corpus of the configuration; as a join by shuffle it would bring all rows of a corpus, texts included, to one task
    got = first.where("__goal is not null").groupBy("corpus").agg(F.coalesce(F.sum(F.when(F.col("__first"), F.col(seconds))), F.lit(0.0)).alias("__got")).withColumnRenamed("corpus", "__corpus")
    both = first.join(F.broadcast(got), F.col("corpus") == F.col("__corpus"), "left").drop("__corpus")
    # hours and back, as the missing time is asked for in hours
    missing = (F.col("__goal") / 3600 - F.col("__got") / 3600) * 3600
    short = F.col("__got") < F.col("__goal")
    rest = prior_sum(both, ["corpus"], F.when(F.col("__first") | F.col("__goal").isNull(), 0.0).otherwise(F.col(seconds)), name="__prior")
    more = ~F.col("__first") & short & (F.col("__prior") < missing)
    return rest.withColumn("selected", F.col("__first") | F.coalesce(more, F.lit(False))).drop("__first", "__got", "__goal", "__bin_goal", "__prior")


def selection_summary(rows: DataFrame, seconds: str = "estimated_ja_seconds") -> DataFrame:
    """(corpus, length_bin, selected_pairs, selected_hours, available_hours) of training rows with selected."""
    s = F.col(seconds)
    return rows.groupBy("corpus", "length_bin").agg(
        F.count_if("selected").alias("selected_pairs"),
        (F.coalesce(F.sum(F.when(F.col("selected"), s)), F.lit(0.0)) / 3600).alias("selected_hours"),
        (F.coalesce(F.sum(s), F.lit(0.0)) / 3600).alias("available_hours"),
    )


def require(rows: DataFrame, hours: dict[str, float], seconds: str = "estimated_ja_seconds") -> None:
    """ValueError where a corpus's selected rows fall short of its hours."""
    have = {r.corpus: (r.got, r.all) for r in rows.groupBy("corpus").agg(F.coalesce(F.sum(F.when(F.col("selected"), F.col(seconds))), F.lit(0.0)).alias("got"), F.sum(seconds).alias("all")).where(F.col("corpus").isin(list(hours))).collect()}
    for corpus, h in hours.items():
        got, all_ = have.get(corpus, (0.0, 0.0))
        if got < h * 3600:
            raise ValueError(f"{corpus}: {h:.2f} training hours are asked for, {all_ / 3600:.2f} are there")
