"""Running totals over a total order, and allocation under quotas as a maximum flow."""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rastro.operators.rows import first_by
from rastro.session import cut

MAX_ARCS = 1_000_000  # links of the part of the network that is solved on the driver; their number is checked


def running_total(rows: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """Sum of ``value`` over all rows up to each one in a total order, without gathering the rows in one task.

    Rows are range-partitioned by the order; the partitions' sums (one row each) are added up and handed back.
    """
    spread = cut(rows.repartitionByRange(*[F.col(c) for c in order]).withColumn("_p", F.spark_partition_id()))
    sums = spread.groupBy("_p").agg(F.sum(value).alias("_s"))
    before = sums.withColumn("_before", F.coalesce(F.sum("_s").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))).select("_p", "_before")
    own = F.sum(value).over(Window.partitionBy("_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return spread.withColumn("_own", own).join(F.broadcast(before), "_p").withColumn(name, F.col("_own") + F.col("_before")).drop("_p", "_own", "_before")


def tiered_plan(sources: DataFrame, kind: str, category: str, gap: int, max_pages: int, max_requests: int, left: dict[str, int], cross: bool = False) -> DataFrame:
    """``source_id, source_type, tier, page_count, requests, quantity``: what to take from which source to fill a gap.

    ``sources(source_id, source_type, research_category, pages, page_capacity, request_cost)``: the first row of an id in
    the order of its columns holds; rows without a positive capacity and cost are left out. Tier 1 has the missing kind and
    category, tier 2 the kind, tier 3 (only if ``cross``) neither. In the order of tier and id each source gives as much as
    the gap, its kind's budget ``left``, the pages and the requests left allow; what it takes shrinks all four for those
    behind it. The walk is sequential by definition: sources are sorted and streamed through one task, which holds only
    the four budgets and ends with them.
    """
    usable = (F.col("page_capacity") > 0) & (F.col("request_cost") > 0) & (F.col("pages") > 0) & F.col("source_type").isin(list(left)) & (F.coalesce(F.col("source_id"), F.lit("")) != "")
    one = sources.filter(usable).groupBy("source_id").agg(F.min(F.struct("source_type", "research_category", "pages", "page_capacity", "request_cost")).alias("s")).select("source_id", "s.*")
    tier = F.when((F.col("source_type") == kind) & (F.col("research_category") == category), 1).when(F.col("source_type") == kind, 2).otherwise(3)
    ranked = one.withColumn("tier", tier).filter(F.col("tier") < (4 if cross else 3)).repartition(1).sortWithinPartitions("tier", "source_id")

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted, pages, requests, budgets = gap, max_pages, max_requests, dict(left)
        for frame in frames:
            out = []
            for s in frame.itertuples():
                quantity = min(wanted, budgets[s.source_type], min(s.pages, pages, requests // s.request_cost) * s.page_capacity)
                if quantity > 0:
                    used = -(-quantity // s.page_capacity)
                    out.append((s.source_id, s.source_type, s.tier, used, used * s.request_cost, quantity))
                    wanted, pages, requests = wanted - quantity, pages - used, requests - used * s.request_cost
                    budgets[s.source_type] -= quantity
            yield pd.DataFrame(out, columns=["source_id", "source_type", "tier", "page_count", "requests", "quantity"])
            if not (wanted and pages and requests):
                return

    return ranked.mapInPandas(walk, "source_id string, source_type string, tier int, page_count bigint, requests bigint, quantity bigint")


def _max_flow(arcs: dict[tuple, int], source: str, sink: str) -> int:
    """Value of a maximum flow: per round, distances to the sink, then paths along falling distances until none is left."""
    left: dict = defaultdict(dict)
    for (a, b), cap in arcs.items():
        left[a][b] = left[a].get(b, 0) + cap
        left[b].setdefault(a, 0)
    total = 0
    while True:
        away, queue = {sink: 0}, deque([sink])
        while queue:
            b = queue.popleft()
            for a in left[b]:
                if a not in away and left[a][b] > 0:
                    away[a] = away[b] + 1
                    queue.append(a)
        if source not in away:
            return total
        untried = {a: list(left[a]) for a in away}
        path = [source]
        while path:
            at = path[-1]
            if at == sink:
                steps = list(zip(path, path[1:], strict=False))
                push = min(left[a][b] for a, b in steps)
                for a, b in steps:
                    left[a][b] -= push
                    left[b][a] += push
                total += push
                full = next(i for i, (a, b) in enumerate(steps) if not left[a][b])
                del path[full + 1 :]
                continue
            onward = untried[at]
            while onward and not (left[at][onward[-1]] > 0 and away.get(onward[-1], -1) == away[at] - 1):
                onward.pop()
            if onward:
                path.append(onward[-1])
            else:
                path.pop()
                if path:
                    untried[path[-1]].pop()


def _listed(options: DataFrame, column: str, name: str, values: list[tuple], more: str = "") -> DataFrame:
    """A few values of a column of ``options``, to be broadcast, as ``name`` with what stands beside them."""
    kind = options.schema[column].dataType.simpleString()
    return F.broadcast(options.sparkSession.createDataFrame(values, f"`{name}` {kind}{more}"))


def _offers(options: DataFrame, categories: list, open_: list[int], full: dict[int, set]) -> DataFrame:
    """``entity, has`` (of each category) and, per open category, ``_fromN``, a source not full for it, if ``_anyN``."""
    where = defaultdict(list)
    for i, sources in full.items():
        for s in sources:
            where[s].append(i)
    rows = options.withColumn("_h", F.xxhash64("entity", "source"))
    if where:
        rows = rows.join(_listed(options, "source", "_s", list(where.items()), ", _full array<int>"), F.col("source").eqNullSafe(F.col("_s")), "left")
    has = [F.max(F.coalesce(F.col("category").eqNullSafe(F.lit(c)), F.lit(False))) for c in categories]
    picks = []
    for i in open_:
        h = F.when(~F.coalesce(F.array_contains("_full", i), F.lit(False)), F.col("_h")) if where else F.col("_h")
        picks += [F.min_by("source", h).alias(f"_from{i}"), F.min(h).isNotNull().alias(f"_any{i}")]
    offers = rows.groupBy("entity").agg(*[x.alias(f"_has{i}") for i, x in enumerate(has)], *picks)
    held = F.array(*[F.col(f"_has{i}") for i in range(len(has))])
    return cut(offers.withColumn("has", held).drop(*[f"_has{i}" for i in range(len(has))]).filter(F.array_contains("has", True)))


def _kernel(options: DataFrame, quota: int, categories: list, most: int) -> list:
    """Rows ``_e, source, has``: a part of the network whose flow is that of the whole one, at most ``most`` by its quotas.

    Each category by itself is matched greedily to sources with room, until it has ``most`` entities or no free entity has
    a source with room left. Three steps then keep the flow, since other units than a given one are fewer than ``most``:

    * A category with ``most`` matched entities keeps only those: sets that can be matched are a matroid, so any unit of
      another entity can be handed to one of them.
    * In any other category an unmatched entity has only sources full for it. Each of these keeps ``most`` entities of the
      category: one is always free to take the place of one left out.
    * A matched entity keeps as many sources as have room for ``most`` units: one always has room.
    """
    matched: dict[int, set] = {i: set() for i in range(len(categories))}
    used: dict[int, dict] = {i: defaultdict(int) for i in matched}
    open_ = list(matched)
    while open_:
        full = {i: {s for s, n in used[i].items() if n == quota} for i in open_}
        offers = _offers(options, categories, open_, full)
        for i in list(open_):
            mine = offers.filter(F.element_at("has", i + 1) & F.col(f"_any{i}")).select("entity", F.col(f"_from{i}").alias("source"))
            if matched[i]:
                mine = mine.join(_listed(options, "entity", "_e", [(e,) for e in matched[i]]), F.col("entity").eqNullSafe(F.col("_e")), "left_anti")
            turn = F.row_number().over(Window.partitionBy("source").orderBy(F.xxhash64("entity")))
            found = mine.withColumn("_at", turn).filter(F.col("_at") <= quota).orderBy("_at").limit(most - len(matched[i])).collect()
            for row in found:
                if used[i][row.source] < quota:
                    used[i][row.source] += 1
                    matched[i].add(row.entity)
            if not found or len(matched[i]) == most:
                open_.remove(i)

    ids = _listed(options, "entity", "_e", [(e,) for e in set().union(*matched.values())])
    near = offers.join(ids, F.col("entity").eqNullSafe(F.col("_e"))).select("_e", "has")
    links = options.select("entity", "source").join(F.broadcast(near), F.col("entity").eqNullSafe(F.col("_e"))).select("_e", "source", "has").distinct()
    parts = [first_by(links, ["_e"], [F.xxhash64("source")], -(-most // quota))]
    where = defaultdict(list)
    for i in matched:
        for s, n in used[i].items():
            if n == quota and len(matched[i]) < most:
                where[s].append(i)
    if where:
        of_full = options.select("entity", "source").join(_listed(options, "source", "_s", list(where.items()), ", _full array<int>"), F.col("source").eqNullSafe(F.col("_s"))).select("entity", "source", "_full").distinct()
        held = offers.select(F.col("entity").alias("_e"), "has")
        each = of_full.join(held, F.col("entity").eqNullSafe(F.col("_e"))).select("_e", "source", "has", F.explode("_full").alias("_i")).filter(F.expr("has[_i]"))
        parts.append(first_by(each, ["_i", "source"], [F.xxhash64("_e")], most).select("_e", "source", "has"))
    found, left = [], MAX_ARCS
    for part in parts:
        found += part.limit(left + 1).collect()
        left = MAX_ARCS - len(found)
        if left < 0:
            raise ValueError("the network that holds the flow is too large for the driver: the quotas are")
    return found


def allocate(options: DataFrame, source_quota: int, category_quota: dict[str, int]) -> DataFrame:
    """How many entities can be allocated, each once, to a source and category of its ``options(source, entity, category)``,
    with at most ``source_quota`` per source and the given number per category; with the shortfall.

    Any of an entity's sources goes with any of its categories; null is a value like others. No more than the sum of the
    category quotas W can be allocated, so a part of the network has the same flow as the whole (:func:`_kernel`). It is found
    in Spark and solved on the driver; its size depends on the quotas alone, not on the options: at most W * categories *
    (ceil(W / source_quota) + W / source_quota) links, of which the driver takes ``MAX_ARCS``.
    """
    quotas = {c: n for c, n in category_quota.items() if n > 0}
    most, wanted, got = sum(quotas.values()), sum(category_quota.values()), 0
    if source_quota > 0 and most:
        arcs: dict[tuple, int] = {(("c", i), "T"): n for i, n in enumerate(quotas.values())}
        for e, source, has in _kernel(options, min(source_quota, most), list(quotas), most):
            arcs["S", ("s", source)] = source_quota
            arcs[("s", source), ("e", e)] = arcs[("e", e), ("f", e)] = 1
            for i, held in enumerate(has):
                if held:
                    arcs[("f", e), ("c", i)] = 1
        got = _max_flow(arcs, "S", "T")
    return options.sparkSession.createDataFrame([(got, wanted - got)], "allocated bigint, shortfall bigint")
