"""Joins of catalogue records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rastro.operators.rows import first_by

BROADCAST_ROWS = 50_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def merge_first(left: DataFrame, right: DataFrame, key: str, left_order: list[Column], right_order: list[Column]) -> DataFrame:
    """Full outer join of the first row per key of either side; common columns are taken from the left where it has them."""
    a, b = first_by(left, [key], left_order), first_by(right, [key], right_order)
    common = [c for c in a.columns if c in b.columns and c != key]
    joined = a.alias("a").join(b.alias("b"), key, "full")
    picked = [F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c) for c in common]
    return joined.select(key, *picked, *[F.col(f"a.{c}") for c in a.columns if c not in (*common, key)], *[F.col(f"b.{c}") for c in b.columns if c not in (*common, key)])


def exact_then_normal(rows: DataFrame, table: DataFrame, term: str, key: Column, value: str) -> DataFrame:
    """Look a term up as it is, then by its key; ``table(term, key, value)`` holds one value per term, the least per key."""
    exact = small(table.select(F.col("term").alias("_t"), F.col("value").alias("_exact")).dropDuplicates(["_t"]))
    normal = small(table.groupBy(F.col("key").alias("_k")).agg(F.min("value").alias("_normal")))
    joined = rows.join(exact, F.col(term) == F.col("_t"), "left").join(normal, key == F.col("_k"), "left")
    return joined.withColumn(value, F.coalesce("_exact", "_normal")).drop("_t", "_k", "_exact", "_normal")


def unique_fallback(rows: DataFrame, facts: DataFrame, full: list[str], part: str, columns: list[str]) -> DataFrame:
    """Join on the whole key, else on ``part`` of it where the other side has one row only."""
    a = facts.select(*full, *[F.col(c).alias(f"_a_{c}") for c in columns])
    alone = facts.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(part))).filter("_n = 1").select(part, *[F.col(c).alias(f"_b_{c}") for c in columns])
    joined = rows.join(a, full, "left").join(alone, part, "left")
    return joined.select(*rows.columns, *[F.coalesce(f"_a_{c}", f"_b_{c}").alias(c) for c in columns])


def within(points: DataFrame, spans: DataFrame, key: str, at: str, start: str, end: str, hours: int = 24) -> DataFrame:
    """Interval join: points inside ``[start, end)`` of a span with the same key, by buckets of ``hours``, so that no
    point meets spans far from it."""
    size = hours * 3600

    def bucket(c: str) -> Column:
        return F.floor(F.unix_seconds(F.col(c).cast("timestamp")) / size)

    p = points.withColumn("_bucket", bucket(at))
    s = spans.filter(F.col(start) < F.col(end)).withColumn("_bucket", F.explode(F.sequence(bucket(start), bucket(end))))
    return p.join(s, [key, "_bucket"]).filter((F.col(at) >= F.col(start)) & (F.col(at) < F.col(end))).drop("_bucket")


def as_of(rows: DataFrame, facts: DataFrame, key: str, at: str, fact_at: str, columns: list[str], tie: str) -> DataFrame:
    """As-of join without a self product: both sides are merged in time order per key and the last fact is carried on."""
    fact = facts.select(key, F.col(fact_at).alias("_at"), F.lit(0).alias("_side"), F.col(tie).alias("_tie"), F.struct(F.col(fact_at), *columns).alias("_fact"), *[F.lit(None).cast(t).alias(c) for c, t in rows.dtypes if c != key])
    row = rows.select(key, F.col(at).alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast(dict(facts.dtypes)[tie]).alias("_tie"), F.lit(None).cast(fact.schema["_fact"].dataType).alias("_fact"), *[F.col(c) for c in rows.columns if c != key])
    w = Window.partitionBy(key).orderBy("_at", "_side", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    both = fact.unionByName(row).withColumn("_last", F.last("_fact", ignorenulls=True).over(w)).filter("_side = 1")
    return both.select(*rows.columns, F.col(f"_last.{fact_at}").alias(f"last_{fact_at}"), *[F.col(f"_last.{c}").alias(f"last_{c}") for c in columns])


def reconcile(target: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """``key, state``: MISSING, EXTRA or DUPLICATE of the found rows against a target set."""
    n = found.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    joined = target.select(key).distinct().withColumn("_wanted", F.lit(True)).join(n, key, "full")
    state = F.when(F.col("n").isNull(), "MISSING").when(F.col("_wanted").isNull(), "EXTRA").when(F.col("n") > 1, "DUPLICATE")
    return joined.withColumn("state", state).filter("state is not null").select(key, "state")


def field_differences(before: DataFrame, after: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``key, field, change`` of fields whose values differ: ADDED, REMOVED or CHANGED; a missing row has all its fields missing."""
    a = before.select(key, *[F.col(f).cast("string").alias(f) for f in fields]).unpivot(key, fields, "field", "before")
    b = after.select(key, *[F.col(f).cast("string").alias(f) for f in fields]).unpivot(key, fields, "field", "after")
    joined = a.join(b, [key, "field"], "full").filter(~F.col("before").eqNullSafe(F.col("after")))
    return joined.select(key, "field", F.when(F.col("before").isNull(), "ADDED").when(F.col("after").isNull(), "REMOVED").otherwise("CHANGED").alias("change"))


def field_extensions(before: DataFrame, after: DataFrame, key: str, fields: list[str], documents: list[str], regions: list[str]) -> DataFrame:
    """``key, field, change`` of records present on both sides: how a later reading differs from an earlier one.

    EMPTY_SCHEMA_EXTENSION if both are missing in different ways (null, empty), METADATA_EXTENSION if a JSON object of
    ``documents`` keeps every entry it had, NEW_RAW_REGION for other changes of ``regions``, FIELD_ADDED if nothing was
    there before, else FIELD_CHANGED.
    """
    both = before.select(key, *[F.col(f).cast("string").alias(f"a_{f}") for f in fields]).join(after.select(key, *[F.col(f).cast("string").alias(f"b_{f}") for f in fields]), key)
    cells = both.select(key, F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"a_{f}").alias("a"), F.col(f"b_{f}").alias("b")) for f in fields])))
    empty = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")).isin("", "{}", "[]")
    entries = lambda c: F.map_entries(F.from_json(c, "map<string,string>"))
    kept = F.col("field").isin(documents) & F.coalesce(F.size(F.array_except(entries("a"), entries("b"))) == 0, F.lit(False))
    change = F.when(empty("a") & empty("b"), "EMPTY_SCHEMA_EXTENSION").when(kept, "METADATA_EXTENSION").when(F.col("field").isin(regions), "NEW_RAW_REGION").when(empty("a"), "FIELD_ADDED").otherwise("FIELD_CHANGED")
    return cells.filter(~F.col("a").eqNullSafe(F.col("b"))).select(key, "field", change.alias("change"))


def bag_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that one side has more often than the other, with ``side``: the two are equal as bags exactly if it is empty."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionAll(b.exceptAll(a).withColumn("side", F.lit("right")))


def fill_from(base: DataFrame, sources: list[DataFrame], key: str, columns: list[str]) -> DataFrame:
    """Columns of ``base`` filled where missing from sources in their order; each source holds one row per key."""
    out = base
    for i, s in enumerate(sources):
        out = out.join(s.select(key, *[F.col(c).alias(f"_{i}_{c}") for c in columns]), key, "left")
    picks = [reduce(lambda x, y: F.coalesce(x, y), [F.col(c), *[F.col(f"_{i}_{c}") for i in range(len(sources))]]).alias(c) for c in columns]
    return out.select(*[c for c in base.columns if c not in columns], *picks)


def best_rule(rows: DataFrame, rules: DataFrame, conditions: list[Column], row_key: str, category: str) -> DataFrame:
    """The category of the most specific matching rules: earlier conditions beat later ones; several categories conflict.

    ``rules`` must be few: their number is checked before they are broadcast.
    """
    scope = reduce(lambda x, pair: F.when(pair[1], pair[0]).otherwise(x), list(reversed(list(enumerate(conditions)))), F.lit(None).cast("int"))
    matched = rows.join(small(rules), reduce(lambda a, b: a | b, conditions)).withColumn("_scope", scope)
    top = matched.withColumn("_best", F.min("_scope").over(Window.partitionBy(row_key))).filter("_scope = _best")
    return top.groupBy(row_key).agg(F.when(F.countDistinct(category) == 1, F.min(category)).alias(category), (F.countDistinct(category) > 1).alias("conflict"))


def closest_evidence(rows: DataFrame, key: str, parent: str, value: str) -> DataFrame:
    """``key, value, taken_from``: each row's own value, else its parent's, else that of the least of its siblings that has one.

    ``rows`` holds one row per key. A parent with very many children costs one row per child: siblings are reduced to the
    least before they are joined.
    """
    up = rows.select(F.col(key).alias("_p"), F.col(value).alias("_up"))
    family = rows.filter(F.col(value).isNotNull() & F.col(parent).isNotNull()).groupBy(F.col(parent).alias("_f")).agg(F.min(F.struct(key, value)).alias("_m"))
    joined = rows.join(up, F.col(parent) == F.col("_p"), "left").join(family, F.col(parent) == F.col("_f"), "left")
    taken = F.when(F.col(value).isNotNull(), "OWN").when(F.col("_up").isNotNull(), "PARENT").when(F.col(f"_m.{value}").isNotNull(), "FAMILY").otherwise("NONE")
    return joined.select(key, F.coalesce(value, "_up", f"_m.{value}").alias(value), taken.alias("taken_from"))


def supplement(base: DataFrame, extra: DataFrame, key: str, context: list[str]) -> DataFrame:
    """Rows of ``extra`` whose (key, context) ``base`` doesn't have yet, each once, with ``merged``: whether the key is known."""
    known = base.select(key).distinct().withColumn("merged", F.lit(True))
    new = extra.select(key, *context).distinct().join(base.select(key, *context).distinct(), [key, *context], "left_anti")
    return new.join(known, key, "left").fillna(False, ["merged"])
