"""Aggregations of catalogue records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rastro.session import cut


def missing(c: Column) -> Column:
    return F.coalesce(F.trim(c.cast("string")), F.lit("")) == ""


def group_statistics(rows: DataFrame, labels: DataFrame, label: str, item: str, valid: Column) -> DataFrame:
    """Per expected label, then the observed others (null as UNMAPPED): rows, valid rows, distinct items, duplicates, invalid."""
    named = rows.withColumn(label, F.coalesce(F.col(label), F.lit("UNMAPPED")))
    stats = named.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.count_if(valid).alias("n_valid"), F.countDistinct(F.when(valid, F.col(item))).alias("n_items"))
    out = labels.select(label).distinct().join(stats, label, "full").fillna(0, ["n", "n_valid", "n_items"])
    return out.withColumns({"duplicates": F.col("n_valid") - F.col("n_items"), "invalid": F.col("n") - F.col("n_valid")})


def value_conflicts(rows: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``key, field, n_values, evidence`` where a key has several non-null values of a field; evidence are the least three."""
    long = rows.select(key, *[F.col(f).cast("string").alias(f) for f in fields]).unpivot(key, fields, "field", "value")
    values = long.filter("value is not null").distinct()
    nth = F.row_number().over(Window.partitionBy(key, "field").orderBy("value"))  # ranked, so that no more than three are gathered
    return values.withColumn("_i", nth).groupBy(key, "field").agg(F.count(F.lit(1)).alias("n_values"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("_i") <= 3, F.col("value")))), ";").alias("evidence")).filter("n_values > 1")


def contribution(rows: DataFrame, source: str, item: str) -> DataFrame:
    """Per source: its items, those that others have too, those only it has, and its share of all items."""
    spread = rows.groupBy(item).agg(F.collect_set(source).alias("_s"))
    per = spread.select(item, F.size("_s").alias("_n"), F.explode("_s").alias(source))
    total = spread.agg(F.count(F.lit(1)).alias("_total"))
    out = per.groupBy(source).agg(F.count(F.lit(1)).alias("items"), F.count_if(F.col("_n") > 1).alias("shared"), F.count_if(F.col("_n") == 1).alias("only_here"))
    return out.join(F.broadcast(total)).withColumn("coverage", F.col("items") / F.col("_total")).drop("_total")


def accounting(rows: DataFrame, source: str, raw: str, item: str, group: str, valid: Column, target: int) -> DataFrame:
    """The accounts of a collection, per source and over all (source null).

    Rows, distinct raw addresses, valid rows, distinct items and groups of those; for the total also the sum of the
    sources' items, which isn't the number of items, as sources overlap; and what is short of ``target`` items. Rows
    without a source belong to none and must be left out before.
    """
    named = rows.withColumns({"_item": F.when(valid, F.col(item)), "_group": F.when(valid, F.col(group))})
    sets = named.groupingSets([[F.col(source)], []], F.col(source))
    out = sets.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(raw).alias("raw_urls"), F.count("_item").alias("valid"), F.countDistinct("_item").alias("items"), F.countDistinct("_group").alias("groups"))
    added = cut(out)
    total = added.filter(F.col(source).isNotNull()).agg(F.sum("items").alias("_sum"))
    return added.join(F.broadcast(total)).select("*", F.when(F.col(source).isNull(), F.col("_sum")).alias("sum_of_sources"), F.greatest(F.lit(target) - F.col("items"), F.lit(0)).alias("shortfall")).drop("_sum")


def percentiles(rows: DataFrame, key: str, value: str, shares: dict[str, float]) -> DataFrame:
    """``key`` and one interpolated percentile of ``value`` per name in ``shares``; nulls count for nothing.

    Exact, and no key's values meet in one task: values are counted, range-partitioned in their order, and the counts of the
    partitions are added up, so that each value knows which places it takes. A null key is a key; a key without values
    has no row.
    """
    counts = rows.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("_k"))
    spread = cut(counts.repartitionByRange(key, value).withColumn("_p", F.spark_partition_id()))
    parts = spread.groupBy(F.col(key).alias("_key"), F.col("_p").alias("_q")).agg(F.sum("_k").alias("_s"))
    w = Window.partitionBy("_key")
    parts = parts.withColumns({"_before": F.coalesce(F.sum("_s").over(w.orderBy("_q").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "_n": F.sum("_s").over(w)})
    own = F.sum("_k").over(Window.partitionBy("_p", key).orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    placed = spread.withColumn("_own", own).join(parts, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_p") == F.col("_q")))
    upto = F.col("_own") + F.col("_before")

    def at(place: Column) -> Column:
        return F.max(F.when((place < upto) & (place >= upto - F.col("_k")), F.col(value)))

    picked = {}
    for name, share in shares.items():
        place = (F.col("_n") - 1) * share
        picked |= {f"_lo_{name}": at(F.floor(place)), f"_hi_{name}": at(F.ceil(place)), f"_f_{name}": F.max(place - F.floor(place))}
    found = placed.groupBy(key).agg(*[c.alias(n) for n, c in picked.items()])
    return found.select(key, *[(F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_f_{n}")).alias(n) for n in shares])


def fill_rates(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``field, filled, rate`` per column, in one pass."""
    one = rows.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(~missing(F.col(c))).alias(c) for c in columns])
    return one.unpivot("_n", columns, "field", "filled").select("field", "filled", F.try_divide(F.col("filled"), F.col("_n")).alias("rate"))


def frequencies(rows: DataFrame, fields: list[str], key: str, top: int, samples: int = 5) -> DataFrame:
    """Per field its ``top`` most frequent values with their number and the ``samples`` least keys that have them."""
    long = rows.select(key, *[F.col(f).cast("string").alias(f) for f in fields]).unpivot(key, fields, "field", "value").filter("value is not null")
    counts = long.groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.withColumn("_r", F.row_number().over(Window.partitionBy("field").orderBy(F.desc("n"), "value"))).filter(F.col("_r") <= top).drop("_r")
    keyed = long.join(F.broadcast(best), ["field", "value"]).select("field", "value", "n", key).distinct()
    ranked = keyed.withColumn("_r", F.row_number().over(Window.partitionBy("field", "value").orderBy(key))).filter(F.col("_r") <= samples)
    return ranked.groupBy("field", "value", "n").agg(F.array_join(F.array_sort(F.collect_list(F.col(key).cast("bigint"))), ",").alias("samples"))


def page_gate(rows: DataFrame, page: str, rank: str, item: str, expected: int) -> DataFrame:
    """Per page: rows, distinct items, missing ranks, duplicates, and reasons why it is incomplete (empty if it isn't)."""
    span = F.max(rank).cast("bigint") - F.min(rank) + 1 - F.countDistinct(rank)
    agg = rows.groupBy(page).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(item).alias("items"), F.coalesce(span, F.lit(0)).alias("gaps"))
    out = agg.withColumn("duplicates", F.col("n") - F.col("items"))
    reasons = F.array_join(F.array_compact(F.array(F.when(F.col("items") < expected, "TOO_FEW"), F.when(F.col("gaps") > 0, "RANK_GAP"), F.when(F.col("duplicates") > 0, "DUPLICATE"))), ";")
    return out.withColumn("reasons", reasons)


def latest_rating(rows: DataFrame, key: str, at: str, tie: str, rating: str, reviews: str) -> DataFrame:
    """``key, rating, evidence, reviews, basis``: what the latest rows with a rating say, else the latest count of reviews.

    Missing ratings and counts are null. If the rows of the latest rating's time disagree, no rating stands (``TIE``);
    ``evidence`` is the least ``tie`` among them. ``reviews`` is the latest stated count, of equal times that of the
    greatest ``tie``. Each key costs two aggregates, however many rows it has.
    """
    rated = rows.filter(F.col(rating).isNotNull())
    last = rated.groupBy(key).agg(F.max(at).alias("_at"))
    of_time = rated.join(last, key).filter(F.col(at) == F.col("_at")).groupBy(key)
    best = of_time.agg(F.min(rating).alias("_lo"), F.max(rating).alias("_hi"), F.min(tie).alias("evidence"))
    counts = rows.groupBy(key).agg(F.max(F.when(F.col(reviews).isNotNull(), F.struct(at, tie, reviews))).alias("_r"))
    one = F.col("_lo") == F.col("_hi")
    basis = F.when(one, "RATING").when(F.col("_lo").isNotNull(), "TIE").when(F.col("_r").isNotNull(), "REVIEWS").otherwise("NONE")
    return counts.join(best, key, "left").select(key, F.when(one, F.col("_lo")).alias(rating), "evidence", F.col(f"_r.{reviews}").alias(reviews), basis.alias("basis"))


def progress(first: DataFrame, group: str, at: str, start: Column, now: Column, target: float, share: float) -> DataFrame:
    """Per group: items first seen after ``start`` up to ``now``, how many of ``target`` were due after ``share`` of the time, the ratio, and whether it is below 0.8."""
    captured = first.groupBy(group).agg(F.count_if((F.col(at) > start) & (F.col(at) <= now)).alias("captured"))
    expected = F.lit(target * share)
    return captured.withColumns({"expected": expected, "ratio": F.col("captured") / expected, "alert": F.col("captured") / expected < 0.8})


def worst(rows: DataFrame, key: str, status: str, order: list[str]) -> DataFrame:
    """The status of a key that comes first in ``order``, and how often each comes."""
    rank = F.array_position(F.array(*map(F.lit, order)), F.col(status))
    return rows.groupBy(key).agg(F.min_by(status, rank).alias("worst"), *[F.count_if(F.col(status) == s).alias(f"n_{s.lower()}") for s in order])


def components(edges: DataFrame) -> DataFrame:
    """``node, component``: the least node of each connected component, by alternating hooking and shortcutting of labels.

    Every round joins each node's label to its neighbours' and to its label's label, so that chains shorten by half; rounds
    go on until no label changes. Labels only fall, so they end.
    """
    both = cut(edges.toDF("a", "b").unionAll(edges.toDF("b", "a").select("a", "b")).distinct())
    labels = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")))
    while True:
        near = both.join(labels.withColumnRenamed("a", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        hooked = labels.join(near, "a", "left").select("a", F.least("label", F.coalesce("near", "label")).alias("label"))
        above = hooked.select(F.col("a").alias("label"), F.col("label").alias("above"))
        following = cut(hooked.join(above, "label", "left").select("a", F.least("label", F.coalesce("above", "label")).alias("label")))
        if not following.join(labels.withColumnRenamed("label", "old"), "a").filter("label <> old").take(1):
            return following.toDF("node", "component")
        labels = following


def coverage(grid: DataFrame, evidence: DataFrame, keys: list[str], state: str) -> DataFrame:
    """Each cell of a grid with the best state its evidence gives: AVAILABLE, then BLOCKED, TEMPORARY; UNSUPPORTED only if all
    say so; UNVERIFIED without evidence."""
    best = evidence.groupBy(*keys).agg(
        F.bool_or(F.col(state) == "AVAILABLE").alias("_a"), F.bool_or(F.col(state) == "BLOCKED").alias("_b"), F.bool_or(F.col(state) == "TEMPORARY").alias("_t"), F.every(F.col(state) == "UNSUPPORTED").alias("_u")
    )
    out = grid.join(best, keys, "left")
    return out.withColumn("coverage", F.when(F.col("_a"), "AVAILABLE").when(F.col("_b"), "BLOCKED").when(F.col("_t"), "TEMPORARY").when(F.col("_u"), "UNSUPPORTED").otherwise("UNVERIFIED")).drop("_a", "_b", "_t", "_u")
