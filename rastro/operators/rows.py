"""Picking and ordering rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rastro.session import cut


def first_by(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key in a stated order; the order must be total for the result to be determined."""
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_at", at).filter(F.col("_at") <= n).drop("_at")


def page_of(df: DataFrame, order: list[Column], offset: int, limit: int) -> DataFrame:
    """``limit`` rows after ``offset`` in a total order."""
    return df.orderBy(*order).offset(offset).limit(limit)


def positions(df: DataFrame, key: str, order: list[Column], name: str, count: str | None = None) -> DataFrame:
    """``df`` with the place of each row within its key, from 1 on in a total order, as ``name``; and the key's rows as ``count``.

    A key that holds a third of all rows is spread over many tasks: rows are range-partitioned in their order, numbered
    within a partition, and moved on by the key's rows in the partitions before. A null key is a key.
    """
    spread = cut(df.repartitionByRange(F.col(key), *order).withColumn("_p", F.spark_partition_id()))
    parts = spread.groupBy(F.col(key).alias("_key"), F.col("_p").alias("_q")).agg(F.count(F.lit(1)).alias("_m"))
    w = Window.partitionBy("_key")
    parts = parts.withColumns({"_before": F.coalesce(F.sum("_m").over(w.orderBy("_q").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "_all": F.sum("_m").over(w)})
    own = F.row_number().over(Window.partitionBy("_p", key).orderBy(*order))
    placed = spread.withColumn("_own", own).join(parts, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_p") == F.col("_q")))
    more = [F.col("_all").alias(count)] if count else []
    return placed.select(*df.columns, (F.col("_own") + F.col("_before")).alias(name), *more)


def interleave(df: DataFrame, group: str, order: list[Column], ranks: Column) -> DataFrame:
    """Round robin over groups in a fixed order, stable within a group: ``turn`` and ``group_rank`` are the order."""
    return positions(df, group, order, "turn").withColumn("group_rank", ranks)


def stratified(df: DataFrame, stratum: str, order: list[Column], n: int) -> DataFrame:
    """``n`` rows, one per stratum and turn: within a stratum the even positions, then the odd ones from the end."""
    placed = positions(df, stratum, order, "_p", "_n").withColumn("_p", F.col("_p") - 1)
    turn = F.when(F.col("_p") % 2 == 0, F.col("_p") / 2).otherwise(F.ceil(F.col("_n") / 2) + F.floor((F.col("_n") - 1 - F.col("_p")) / 2))
    return placed.withColumn("turn", turn.cast("bigint")).drop("_p", "_n").orderBy("turn", stratum).limit(n)


def filled(*columns: Column) -> Column:
    """How many of the columns state something: the tie break by quality."""
    out = F.lit(0)
    for c in columns:
        out = out + F.when(F.coalesce(F.trim(c.cast("string")), F.lit("")) != "", 1).otherwise(0)
    return out


def quota(df: DataFrame, group: str, key: str, order: list[Column], share_of: str, quota: int, share: float) -> DataFrame:
    """Greedy quota, group after group from the scarcest on; a key is used once; no source gives more than its share.

    The groups are few and fixed (at most 1,000, checked); each step is distributed, and only the group names are listed.
    """
    best = cut(first_by(df, [group, key], order))
    sizes = best.groupBy(group).agg(F.countDistinct(key).alias("n")).orderBy("n", group).limit(1_001).collect()
    if len(sizes) > 1_000:
        raise ValueError("more than 1,000 groups: a quota is set per named group")
    cap = max(1, -int(-quota * share // 1))
    taken: DataFrame | None = None
    for row in sizes:
        mine = best.filter(F.col(group) == row[group])
        if taken is not None:
            mine = mine.join(taken.select(key), key, "left_anti").select(best.columns)
        capped = first_by(mine, [share_of], order, cap)
        chosen = cut(first_by(capped, [group], order, quota))
        taken = chosen if taken is None else taken.unionByName(chosen)
    return taken if taken is not None else best


def confirmed(df: DataFrame) -> DataFrame:
    """Rows whose entity is confirmed: a ``product_id``, ``identity_status`` CONFIRMED, and no ``conflicts``; never by a raw id alone."""
    free = F.coalesce(F.size("conflicts"), F.lit(0)) <= 0
    return df.filter((F.coalesce("product_id", F.lit("")) != "") & (F.col("identity_status") == "CONFIRMED") & free)


def qualification(url: Column, recomputed: Column, stated: Column, eligible: Column, evidence: Column) -> Column:
    """``excluded`` without an address; ``qualified`` if it is the recomputed one, what must be stated is, nothing speaks
    against the row and there is evidence; else ``invalid``."""
    fine = (url == recomputed) & stated.isNotNull() & eligible & (F.coalesce(F.trim(evidence), F.lit("")) != "")
    return F.when(url.isNull(), "excluded").when(F.coalesce(fine, F.lit(False)), "qualified").otherwise("invalid")


def refresh_decision(seen: Column, unreliable: Column, old_schema: Column, missing: Column, stale: Column) -> Column:
    """NEW, UNRELIABLE, OLD_SCHEMA, MISSING_FIELDS, STALE or FRESH: the first that holds; null holds not."""
    return (
        F.when(seen.isNull(), "NEW").when(unreliable, "UNRELIABLE").when(old_schema, "OLD_SCHEMA").when(missing, "MISSING_FIELDS").when(stale, "STALE").otherwise("FRESH")
    )
