"""Best per group, ordered neighbours and exact medians, without one-task groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_in_group(tallies: DataFrame, group: Sequence[str], measure: str) -> DataFrame:
    """Rows whose measure is the largest of their group; every tied row is kept.

    The maximum is an ordinary aggregate and the rows are matched to it by an equi-join, so
    neither a large group nor a large tie has to fit in one task.
    """
    tops = tallies.groupBy(*group).agg(F.max(measure).alias(measure))
    return tallies.join(tops, [*group, measure], "left_semi")


def with_previous(df: DataFrame, group: Sequence[str], block: Sequence[str], row_id: str,
                  value: str, output: str) -> DataFrame:
    """Add the value of the previous row of the group, in the order (block, row id).

    ``block`` columns cut each group into ordered pieces. Neighbours are found inside the
    pieces; the first row of a piece takes the last value of the piece before it. So a hot
    group is spread over its pieces, and only one row per piece meets in the group window.
    Both halves read the same shuffle.
    """
    pieces = Window.partitionBy(*group, *block)
    in_piece = pieces.orderBy(row_id)
    whole_piece = in_piece.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = df.withColumns({
        "_nth": F.row_number().over(in_piece),
        "_before": F.lag(value).over(in_piece),
        "_last": F.last(value).over(whole_piece),
    })
    across = Window.partitionBy(*group).orderBy(*block)
    firsts = rows.where("_nth = 1").withColumn(output, F.lag("_last").over(across))
    others = rows.where("_nth > 1").withColumn(output, F.col("_before"))
    return firsts.unionByName(others).drop("_nth", "_before", "_last")


def exact_median(counts: DataFrame, group: str, value: str, n: str, bucket_size: int = 1000) -> DataFrame:
    """Exact median per group of a whole-number value, from a table of (group, value, n).

    The middle ranks are located first among coarse buckets, then among the values of the
    one or two buckets that hold them. A group never gathers more than its buckets or the
    ``bucket_size`` values of one bucket.
    """
    bucket: Column = F.floor(F.col(value) / bucket_size)
    fine = counts.withColumn("_bucket", bucket)
    coarse = fine.groupBy(group, "_bucket").agg(F.sum(n).alias("_in_bucket"))
    up_to_here = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(group)
    coarse = coarse.withColumns({
        "_end": F.sum("_in_bucket").over(up_to_here),
        "_total": F.sum("_in_bucket").over(whole),
    }).withColumn("_start", F.col("_end") - F.col("_in_bucket"))
    # The two middle ranks (equal for an odd total).
    low = F.floor((F.col("_total") + 1) / 2)
    high = F.floor((F.col("_total") + 2) / 2)
    middle = coarse.withColumns({"_low": low, "_high": high}).where(
        ((F.col("_start") < F.col("_low")) & (F.col("_low") <= F.col("_end")))
        | ((F.col("_start") < F.col("_high")) & (F.col("_high") <= F.col("_end")))
    ).select(group, "_bucket", "_start", "_low", "_high")
    in_bucket = (
        Window.partitionBy(group, "_bucket").orderBy(value)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    # A null-safe bucket adds no filter below the join, so all uses of the counts stay one plan.
    middle = middle.toDF("_group", "_middle", "_start", "_low", "_high")
    same_bucket = (F.col(group) == F.col("_group")) & F.col("_bucket").eqNullSafe(F.col("_middle"))
    values = fine.join(middle, same_bucket).withColumn(
        "_value_end", F.col("_start") + F.sum(n).over(in_bucket))
    # The first value whose running count reaches a rank is the value at that rank.
    low_value = F.min(F.when(F.col("_value_end") >= F.col("_low"), F.col(value)))
    high_value = F.min(F.when(F.col("_value_end") >= F.col("_high"), F.col(value)))
    return values.groupBy(group).agg(((low_value + high_value) / 2.0).alias("median"))
