"""Order-dependent building blocks that stay balanced under a hot key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F


def time_span(ts: str, width: str) -> Column:
    """Index of the fixed-width time span a timestamp falls in."""
    micros, width_us = F.unix_micros(ts), F.lit(interval_micros(width))
    return F.call_function("div", micros - F.pmod(micros, width_us), width_us)


def interval_micros(text: str) -> int:
    amount, unit = text.split()
    micros = {"millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
              "hour": 3_600_000_000, "day": 86_400_000_000}[unit.rstrip("s")]
    return int(amount) * micros


def rows_since(events: DataFrame, bound: Column) -> DataFrame:
    """Events from a moment on; on a stored history only the days from it on are read."""
    kept = events.filter(F.col("event_timestamp") >= bound)
    if "event_date" in events.columns:
        kept = kept.filter(F.col("event_date") >= F.to_date(bound))
    return kept


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key, in `order`; works on batches and on streams.

    An aggregate rather than a window: every task reduces a key to one row before
    the shuffle, so a key with a third of the rows costs no more than another.
    """
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("last")
    return df.groupBy(*keys).agg(last).select(*keys, *[f"last.{c}" for c in rest])


def first_rows_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first `n` rows of each key.

    The row_number filter is pushed below the shuffle by the optimizer: a task
    forwards at most `n` rows per key.
    """
    by = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("row_no", F.row_number().over(by))
              .filter(F.col("row_no") <= n))


# Pieces of the value range in which distinct values are ranked.
RANK_PIECES = 1000


def global_ranks(rows: DataFrame, keys: list[str], measures: dict[str, bool]) -> DataFrame:
    """Adds `<name>_rank` for every measure: its rank over all rows, 1 first, ties alike.

    `measures` maps a column to whether the largest value comes first. No window sees all rows: equal
    values are counted first, the distinct values are cut into pieces by approximate percentiles,
    ordered within their piece, and start behind the counts of the pieces before, of which there are
    RANK_PIECES at most. Values must not be null; `keys` name a row.
    """
    long = rows.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(name).alias("measure"),
                 ((-1 if down else 1) * F.col(name).cast("double")).alias("value"))
        for name, down in measures.items()])).alias("m")).select(*keys, "m.measure", "m.value")
    counted = long.groupBy("measure", "value").agg(F.count(F.lit(1)).alias("n"))
    share = [i / RANK_PIECES for i in range(1, RANK_PIECES)]
    cuts = counted.groupBy("measure").agg(F.array_distinct(F.percentile_approx(
        "value", share, F.lit(RANK_PIECES * 10))).alias("cuts"))
    piece = F.size(F.filter("cuts", lambda cut: cut < F.col("value")))
    placed = counted.join(F.broadcast(cuts), "measure").withColumn("piece", piece).drop("cuts")
    totals = placed.groupBy("measure", "piece").agg(F.sum("n").alias("total"))
    before = F.sum("total").over(Window.partitionBy("measure").orderBy("piece")) - F.col("total")
    starts = totals.select("measure", "piece", before.alias("before"))
    own = F.sum("n").over(Window.partitionBy("measure", "piece").orderBy("value")) - F.col("n")
    ranked = placed.withColumn("own", own).join(starts, ["measure", "piece"]).select(
        "measure", "value", (F.col("before") + F.col("own") + 1).alias("rank"))
    named = long.join(ranked, ["measure", "value"])
    found = named.groupBy(*keys).agg(*[
        F.max(F.when(F.col("measure") == name, F.col("rank"))).alias(f"{name}_rank")
        for name in measures])
    return rows.join(found, keys)


# Spans of falling width in which the rows of a key are ordered: rows within the narrowest, then
# only the last row of every span within the next wider one.
WIDTHS = ("1 hour", "1 second", "1 millisecond")


def _join_on(left: DataFrame, right: DataFrame, names: list[str], how: str) -> DataFrame:
    """Join on columns of one name; null meets null, as in a window's groups."""
    renamed = right.withColumnsRenamed({name: f"__{name}" for name in names})
    met = [F.col(name).eqNullSafe(F.col(f"__{name}")) for name in names]
    return left.join(renamed, met, how).drop(*[f"__{name}" for name in names])


def with_previous(df: DataFrame, keys: list[str], ts: str, tie: str, columns: list[str],
                  widths: tuple[str, ...] = WIDTHS) -> DataFrame:
    """Adds `prev`: the struct of `columns` from the preceding row of the key.

    Rows are ordered by (ts, tie). No window sees the whole of a busy key: rows are ordered within
    a millisecond, the last rows of milliseconds within a second, those of seconds within an hour,
    and those of hours over the key. What crosses a border comes from the level above. Exact,
    whatever the widths; the input is read twice.
    """
    spans = [f"span_{i}" for i in range(len(widths))]
    placed = df.withColumns({span: time_span(ts, width)
                             for span, width in zip(spans, widths, strict=True)})
    inside = Window.partitionBy(*keys, *spans).orderBy(ts, tie)
    local = placed.withColumn("prev", F.lag(F.struct(*columns)).over(inside))

    last = F.max_by(F.struct(*columns), F.struct(ts, tie)).alias("tail")
    tails = {len(spans): placed.groupBy(*keys, *spans).agg(last, F.max(F.struct(ts, tie)).alias(
        "at"))}
    for level in range(len(spans) - 1, 0, -1):
        tails[level] = tails[level + 1].groupBy(*keys, *spans[:level]).agg(
            F.max_by("tail", "at").alias("tail"), F.max("at").alias("at"))
    carried = None
    for level in range(1, len(spans) + 1):
        group = [*keys, *spans[:level - 1]]
        before = F.lag("tail").over(Window.partitionBy(*group).orderBy(spans[level - 1]))
        own = tails[level].select(*group, spans[level - 1], before.alias("carried"))
        if carried is not None:
            wider = carried.withColumnRenamed("carried", "from_wider")
            own = _join_on(own, wider, group, "inner").withColumn(
                "carried", F.coalesce("carried", "from_wider")).drop("from_wider")
        carried = own
    return (_join_on(local, carried, [*keys, *spans], "left")
                 .withColumn("prev", F.coalesce("prev", "carried"))
                 .drop(*spans, "carried"))
