"""Joins on keys whose rows multiply."""

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Joined rows that one part of a key is meant to make.
PART_ROWS = 20_000


def split_left_join(
    left: DataFrame, right: DataFrame, key: str, salt: Column, right_salt: Column, part_rows: int = PART_ROWS
) -> DataFrame:
    """``left.join(right, key, "left")``, each key's pairs dealt to a grid of parts of about ``part_rows``.

    The rows and columns of a key's grid follow from its rows on both sides; most keys have one part.
    Both sides are dealt, the left to the rows of the grid by ``salt`` and the right to its columns
    by ``right_salt``, which must be the same when a task runs again; each row of the grid meets a
    copy of what lies in each column. So neither side of a key has to fit into a task. A side of few
    rows isn't cut. Nothing is grouped but the key, and values stay as they are.
    """
    side = isqrt(part_rows)
    pairs = left.groupBy(key).agg(F.count("*").alias("_l")).join(right.groupBy(key).agg(F.count("*").alias("_r")), key)
    all_parts = F.ceil(F.col("_l") * F.col("_r") / part_rows)

    def cut(own: str, other: str) -> Column:
        one_side = F.when(F.col(own) <= side, F.lit(1).cast("long")).when(F.col(other) <= side, all_parts)
        return one_side.otherwise(F.ceil(F.col(own) / side))

    heavy = pairs.where(F.col("_l") * F.col("_r") > part_rows)
    heavy = heavy.select(key, cut("_l", "_r").alias("_rows"), cut("_r", "_l").alias("_columns"))
    rows, columns, one = F.coalesce("_rows", F.lit(1)), F.coalesce("_columns", F.lit(1)), F.lit(1).cast("long")

    def every(n: Column) -> Column:
        return F.explode(F.sequence(one, n.cast("long")))

    dealt = left.withColumn("_salt", salt).join(heavy, key, "left")
    dealt = dealt.withColumn("_row", F.pmod(F.xxhash64("_salt"), rows) + 1).withColumn("_column", every(columns))
    dealt = dealt.withColumn("_cut", columns > 1).drop("_salt", "_rows", "_columns")
    copied = right.withColumn("_salt", right_salt).join(heavy, key, "left")
    copied = copied.withColumn("_column", F.pmod(F.xxhash64("_salt"), columns) + 1).withColumn("_row", every(rows))
    copied = copied.withColumn("_met", F.lit(True)).drop("_salt", "_rows", "_columns")
    joined = dealt.join(copied, [key, "_row", "_column"], "left")
    # A key with several columns has rows on the right: a row that met none in a column met some in another.
    return joined.where(~F.col("_cut") | F.col("_met").isNotNull()).drop("_row", "_column", "_cut", "_met")
