"""Do two stores hold the same rows? Compared by contents, through digests.

Rows are hashed over all compared columns; a bucket's digest is its number of rows and two
order-free sums of the hashes. Only buckets whose digests differ are compared row by row, so equal
stores cost one aggregate each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 256


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def digests(rows: DataFrame, day: str, keys: list[str], columns: list[str],
            buckets: int = BUCKETS) -> DataFrame:
    """Per day and bucket of the keys: rows, and two sums of row hashes that no order changes."""
    # A null is hashed as its own mark, so that it does not vanish beside its neighbours.
    parts = [part for c in columns for part in (F.col(c), F.col(c).isNull())]
    hashed = rows.select(F.col(day).alias("day"), _bucket(keys, buckets).alias("bucket"),
                         F.xxhash64(*parts).alias("h"), F.hash(*parts).alias("g"))
    return hashed.groupBy("day", "bucket").agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor("h").alias("mixed"),
        F.sum((F.col("h") % (1 << 31)).cast("long") + F.col("g")).alias("summed"))


def differing(left: DataFrame, right: DataFrame, day: str, keys: list[str], columns: list[str],
              buckets: int = BUCKETS) -> DataFrame:
    """Days and buckets whose digests differ."""
    a, b = (digests(side, day, keys, columns, buckets) for side in (left, right))
    b = b.select(*[F.col(c).alias(f"right_{c}") for c in b.columns])
    both = a.join(b, F.col("day").eqNullSafe(F.col("right_day"))
                  & (F.col("bucket") == F.col("right_bucket")), "full_outer")
    same = reduce(lambda x, y: x & y, (F.col(c).eqNullSafe(F.col(f"right_{c}"))
                                       for c in ("rows", "mixed", "summed")))
    return both.filter(~same).select(F.coalesce("day", "right_day").alias("day"),
                                     F.coalesce("bucket", "right_bucket").alias("bucket"))


def differences(left: DataFrame, right: DataFrame, day: str, keys: list[str], columns: list[str],
                buckets: int = BUCKETS) -> DataFrame:
    """One row per key and column that differs: keys, day, column, left_value, right_value.

    A key that only one store has is one row with column `only_left` or `only_right`; copies of a key
    are told by `copies`, their number on each side. `day` and `keys` name a row of a store.
    """
    found = differing(left, right, day, keys, columns, buckets)

    def part(side: DataFrame) -> DataFrame:
        wanted = found.select(F.col("day").alias("__day"), F.col("bucket").alias("__bucket"))
        rows = side.withColumn("__own", _bucket(keys, buckets)).join(
            wanted, F.col(day).eqNullSafe(F.col("__day")) & (F.col("__own") == F.col("__bucket")),
            "left_semi")
        values = F.struct(*[F.col(c).cast("string").alias(c) for c in columns])
        return rows.groupBy(*dict.fromkeys([*keys, day])).agg(
            F.count(F.lit(1)).alias("copies"), F.min(values).alias("values"))

    names = list(dict.fromkeys([*keys, day]))
    a = part(left)
    b = part(right).select(*[F.col(c).alias(f"__{c}") for c in names],
                           F.col("copies").alias("other_copies"), F.col("values").alias("others"))
    both = a.join(b, reduce(lambda x, y: x & y, (
        F.col(c).eqNullSafe(F.col(f"__{c}")) for c in names)), "full_outer")
    fact = lambda name, x, y: F.struct(F.lit(name).alias("column"),
                                       x.cast("string").alias("left_value"),
                                       y.cast("string").alias("right_value"))
    none = F.lit(None)
    lone = F.when(F.col("other_copies").isNull(), F.array(fact("only_left", F.col("copies"), none))) \
        .when(F.col("copies").isNull(), F.array(fact("only_right", none, F.col("other_copies"))))
    told = F.array(fact("copies", F.col("copies"), F.col("other_copies")),
                   *[fact(c, F.col(f"values.{c}"), F.col(f"others.{c}")) for c in columns])
    changed = F.filter(told, lambda f: ~f["left_value"].eqNullSafe(f["right_value"]))
    return both.select(*[F.coalesce(c, f"__{c}").alias(c) for c in names],
                       F.explode(F.coalesce(lone, changed)).alias("f")).select(*names, "f.*")
