"""Histories: streaks, gaps, reappearances, rates, first sightings, online duplicate states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rastro.session import cut


def streaks(days: DataFrame, keys: list[str], day: str) -> DataFrame:
    """Runs of consecutive days: ``start, days``, one row per run; a day given twice counts once."""
    distinct = days.select(*keys, day).distinct()
    island = F.date_sub(F.col(day), F.row_number().over(Window.partitionBy(*keys).orderBy(day)))
    return distinct.withColumn("_i", island).groupBy(*keys, "_i").agg(F.min(day).alias("start"), F.count(F.lit(1)).alias("days")).drop("_i")


def missing_ranges(values: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Missing integers between the least and the greatest of a key, as ranges ``from_value, to_value``."""
    after = F.lead(value).over(Window.partitionBy(*keys).orderBy(value))
    return values.select(*keys, value).distinct().withColumn("_next", after).filter(F.col("_next") > F.col(value) + 1).select(*keys, (F.col(value) + 1).alias("from_value"), (F.col("_next") - 1).alias("to_value"))


def reappearances(states: DataFrame, keys: list[str], day: str, state: str) -> DataFrame:
    """Days on which a key is ``present`` after the calendar day before proved it ``absent``, having been present earlier."""
    w = Window.partitionBy(*keys).orderBy(day)
    seen = F.min(F.when(F.col(state) == "present", F.col(day))).over(w)
    marked = states.withColumns({"_day": F.lag(day).over(w), "_state": F.lag(state).over(w), "_seen": seen})
    back = (F.col(state) == "present") & (F.col("_state") == "absent") & (F.datediff(day, "_day") == 1) & (F.col("_seen") < F.col(day))
    return marked.filter(back).select(*keys, day)


def gaps_between(rows: DataFrame, keys: list[str], at: str, tie: str) -> DataFrame:
    """Whole seconds since the row before, per key, as ``gap_s``; null for the first. Rows without a time come first.

    A key with a third of all rows is spread over many tasks: rows are range-partitioned in their order, and the first row
    of a key in a partition takes the key's last time in the partitions before.
    """
    spread = cut(rows.repartitionByRange(*keys, at, tie).withColumn("_p", F.spark_partition_id()))
    ends = spread.groupBy(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_p").alias("_q")).agg(F.max(at).alias("_end"))
    ends = ends.withColumn("_end", F.lag("_end").over(Window.partitionBy(*[f"_{k}" for k in keys]).orderBy("_q")))
    same = F.col("_p") == F.col("_q")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    inner = Window.partitionBy("_p", *keys).orderBy(at, tie)
    marked = spread.withColumns({"_first": F.row_number().over(inner) == 1, "_before": F.lag(at).over(inner)}).join(ends, same)
    before = F.when(F.col("_first"), F.col("_end")).otherwise(F.col("_before"))
    return marked.withColumn("gap_s", F.timestamp_diff("SECOND", before, F.col(at))).select(*rows.columns, "gap_s")


def trailing_rate(rows: DataFrame, keys: list[str], at: str, tie: str, seconds: int, target: int = 0) -> DataFrame:
    """Rows per hour since the last row at least ``seconds`` back, else since the first, and the hours to ``target`` rows at that rate.

    Both are null where there is one sample only.
    """
    order = Window.partitionBy(*keys).orderBy(at, tie)
    numbered = rows.withColumns({"_n": F.row_number().over(order), "_s": F.unix_seconds(F.col(at).cast("timestamp"))})
    ranged = Window.partitionBy(*keys).orderBy("_s").rangeBetween(Window.unboundedPreceding, -seconds)
    first = F.first(F.struct("_s", "_n")).over(order)
    base = F.coalesce(F.max(F.struct("_s", "_n")).over(ranged), first)
    out = numbered.withColumn("_base", base)
    rate = F.try_divide((F.col("_n") - F.col("_base._n")) * 3600, F.col("_s") - F.col("_base._s"))
    left = F.greatest(F.lit(target) - F.col("_n"), F.lit(0))
    eta = F.when(F.col("_n") > F.col("_base._n"), F.try_divide(left * (F.col("_s") - F.col("_base._s")), (F.col("_n") - F.col("_base._n")) * 3600))
    return out.withColumns({"per_hour": rate, "eta_hours": F.when(rate.isNotNull(), eta)}).drop("_n", "_s", "_base")


def cumulative_distinct(rows: DataFrame, keys: list[str], at: str, item: str) -> DataFrame:
    """Per time: how many items had been seen by then, how many were new, and how many an hour since the time before.

    The first time of a key has no rate: what it brought may have gathered for any while.
    """
    first = rows.groupBy(*keys, item).agg(F.min(at).alias(at))
    times = rows.select(*keys, at).distinct().join(first.groupBy(*keys, at).agg(F.count(F.lit(1)).alias("new")), [*keys, at], "left").fillna(0, ["new"])
    order = Window.partitionBy(*keys).orderBy(at)
    hours = (F.unix_seconds(F.col(at).cast("timestamp")) - F.lag(F.unix_seconds(F.col(at).cast("timestamp"))).over(order)) / 3600
    return times.withColumns({"seen": F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)), "per_hour": F.try_divide(F.col("new").cast("double"), hours)})


def duplicate_status(rows: DataFrame, run: str, item: str, raw: str, order: list[Column], eligible: Column, valid: Column) -> DataFrame:
    """Online state of each row: the first eligible row of an item is UNIQUE; later ones are EXACT_DUPLICATE if the same raw
    value came before, else NORMALIZED_DUPLICATE; ineligible ones IDENTITY_UNCONFIRMED, invalid ones INVALID."""
    before = (Window.unboundedPreceding, -1)
    sorted_ = rows.withColumns({"_ok": eligible & valid})
    earlier = F.coalesce(F.sum(F.col("_ok").cast("int")).over(Window.partitionBy(run, item).orderBy(*order).rowsBetween(*before)), F.lit(0))
    same = F.count(F.lit(1)).over(Window.partitionBy(run, item, raw).orderBy(*order).rowsBetween(*before))
    status = F.when(~valid, "INVALID").when(~eligible, "IDENTITY_UNCONFIRMED").when(earlier == 0, "UNIQUE").when(same > 0, "EXACT_DUPLICATE").otherwise("NORMALIZED_DUPLICATE")
    return sorted_.withColumn("status", status).drop("_ok")


def rank_changes(before: DataFrame, after: DataFrame, keys: list[str], rank: str) -> DataFrame:
    """Least positive rank per key on either side and the change between them; only keys on both."""

    def least(df: DataFrame, name: str) -> DataFrame:
        return df.filter(F.col(rank) > 0).groupBy(*keys).agg(F.min(rank).alias(name))

    joined = least(before, "rank_before").join(least(after, "rank_after"), keys)
    delta = F.col("rank_before") - F.col("rank_after")
    return joined.withColumn("delta", delta).withColumn("movement", F.when(delta > 0, "UP").when(delta < 0, "DOWN").otherwise("UNCHANGED"))


def sightings(rows: DataFrame, keys: list[str], item: str, day: str, order: list[Column]) -> DataFrame:
    """FIRST_SEEN, REUSED_OTHER_DAY or REUSED_SAME_DAY of each row within its origin; over all days, whichever are shown then."""
    first = F.min(day).over(Window.partitionBy(*keys, item))
    at = F.row_number().over(Window.partitionBy(*keys, item, day).orderBy(*order))
    return rows.withColumn("sighting", F.when(at > 1, "REUSED_SAME_DAY").when(F.col(day) > first, "REUSED_OTHER_DAY").otherwise("FIRST_SEEN"))


def latest_widest_pages(captures: DataFrame, source: list[str], frame: list[str], at: str, page: str, size: str, latest: int) -> DataFrame:
    """The ``latest`` newest frames of a source, each with its retained page: that of the largest capture, of equal ones the
    greatest ``page``. A null size is smaller than any other. Columns ``source, frame, at, page, size``."""
    best = captures.groupBy(*source, *frame, at).agg(F.max(F.struct(F.col(size), F.col(page))).alias("_b"))
    newest = Window.partitionBy(*source).orderBy(F.desc(at), *frame)
    kept = best.withColumn("_n", F.row_number().over(newest)).filter(F.col("_n") <= latest)
    return kept.select(*source, *frame, at, F.col(f"_b.{page}").alias(page), F.col(f"_b.{size}").alias(size))


def sighting_history(rows: DataFrame, keys: list[str], day: str, latest: int) -> DataFrame:
    """Per key and day, for the ``latest`` days that have rows: rows of each kind of :func:`sightings`."""
    days = rows.select(day).distinct().orderBy(F.desc(day)).limit(latest)
    kinds = ("FIRST_SEEN", "REUSED_OTHER_DAY", "REUSED_SAME_DAY")
    return rows.join(F.broadcast(days), day).groupBy(*keys, day).agg(*[F.count_if(F.col("sighting") == k).alias(k.lower()) for k in kinds])


def full_windows(days: DataFrame, keys: list[str], day: str, length: int) -> DataFrame:
    """``keys, start``: the days from which a key has rows on ``length`` days without a break; overlapping ones each."""
    last = F.lead(day, length - 1).over(Window.partitionBy(*keys).orderBy(day))
    found = days.select(*keys, day).distinct().withColumn("_last", last)
    return found.filter(F.datediff("_last", day) == length - 1).select(*keys, F.col(day).alias("start"))
