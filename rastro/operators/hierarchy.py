"""Parent-child links to full hierarchies.

Method: nodes are spread over partitions; every partition follows its own chains of parents to the node where they leave
it (the fragment's exit). The exits of all partitions form a smaller quotient forest, which is solved the same way, until
it fits one task of at most ``solve_rows`` nodes. Going back, each fragment is expanded with its exit's result. A chain
that runs into itself inside a partition is a local circle; one that closes in a quotient is a global circle.

Before each contraction the leaves (nodes that are nobody's parent) are put aside, and a coin thrown per node and level
places about a quarter of the others beside their parents, so that every level shrinks by a constant factor whatever the
shape of the trees: the work of all levels together is in proportion to the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rastro.session import cut

SOLVE_ROWS = 1_000
PARTITION_ROWS = 50_000
HOT_CHILDREN = 50_000  # more children than this: the join on their parent is salted
_LOCAL = "id string, top string, top_d bigint, exit string, exit_d bigint, loop boolean, path array<string>"


def _solve(frame: pd.DataFrame, paths: bool) -> pd.DataFrame:
    """Follow parents within ``frame`` by pointer doubling; one row per node with its last local ancestor."""
    n = len(frame)
    ids, up = frame["id"].to_numpy(object), frame["up"].to_numpy(object)
    to = pd.Index(ids).get_indexer(pd.Index(up, dtype=object))
    to[pd.isna(up)] = -1
    w = frame["w"].to_numpy(np.int64)
    top, dist = np.where(to >= 0, to, np.arange(n)), np.where(to >= 0, w, 0)
    for _ in range(n.bit_length() + 1):
        dist = dist + dist[top]
        top = top[top]
    loop = to[top] >= 0  # after more steps than there are nodes, still not at an end
    dist[loop] = 0
    exit_ = up[top].copy()
    exit_[loop] = None
    out = pd.DataFrame({"id": ids, "top": frame["base"].to_numpy(object)[top], "top_d": dist + frame["base_d"].to_numpy(np.int64)[top], "exit": exit_, "exit_d": dist + w[top], "loop": loop})
    if not paths:
        out["path"] = None
        return out
    own = frame["path"].to_numpy(object)  # the nodes a link passes over, from below its upper end down to the node itself
    trail: list[list[str] | None] = [None] * n
    for i in np.argsort(dist, kind="stable"):
        if not loop[i]:
            trail[i] = list(own[i]) if to[i] < 0 else trail[to[i]] + list(own[i])
    out["path"] = trail
    return out


def _solve_all(frames: Iterator[pd.DataFrame], paths: bool) -> Iterator[pd.DataFrame]:
    parts = [f for f in frames if len(f)]
    if parts:
        yield _solve(pd.concat(parts, ignore_index=True), paths)


def _hot(children: DataFrame, rows: int, hot_children: int) -> dict[str, int]:
    """Parents with so many children that a join on them must be salted; at most 1,000, as the limit grows with the rows."""
    limit = max(hot_children, rows // 1000)
    return {r.exit: -(-r.n // limit) for r in children.filter(F.col("n") > limit).collect()}


def _attach(lower: DataFrame, results: DataFrame, hot: dict[str, int]) -> DataFrame:
    """Left join of ``lower.exit`` to ``results.r_id``; children of a hot parent are spread by a salt."""
    if not hot:
        return lower.join(results, lower["exit"] == results["r_id"], "left")
    salts = F.create_map(*[F.lit(x) for kv in hot.items() for x in kv])
    a = lower.withColumn("_salt", F.pmod(F.xxhash64("id"), F.coalesce(F.try_element_at(salts, F.col("exit")), F.lit(1))).cast("int"))
    b = results.withColumn("_s", F.explode(F.sequence(F.lit(0), F.coalesce(F.try_element_at(salts, F.col("r_id")), F.lit(1)) - 1)))
    return a.join(b, (a["exit"] == b["r_id"]) & (a["_salt"] == b["_s"]), "left").drop("_salt", "_s")


def _resolve(nodes: DataFrame, paths: bool, solve_rows: int, partition_rows: int, level: int, hot_children: int) -> DataFrame:
    """``nodes(id, up, w, base, base_d, path)`` -> ``r_id, r_root, r_depth, r_loop, r_path``.

    ``w`` counts the links up to ``up``; where ``up`` is none or not in the table, ``base`` is the root, ``base_d`` links up.
    """
    rows = nodes.count()
    if rows <= solve_rows:
        local = nodes.repartition(1).mapInPandas(lambda it: _solve_all(it, paths), _LOCAL)
        return local.select(
            F.col("id").alias("r_id"),
            F.when(~F.col("loop"), F.col("top")).alias("r_root"),
            F.when(F.col("loop"), -1).otherwise(F.col("top_d")).alias("r_depth"),
            F.col("loop").alias("r_loop"),
            F.col("path").alias("r_path"),
        )
    children = cut(nodes.filter(F.col("up").isNotNull()).groupBy(F.col("up").alias("exit")).agg(F.count(F.lit(1)).alias("n")))
    hot = _hot(children, rows, hot_children)
    parents = children.select(F.col("exit").alias("id"))
    inner, leaves = nodes.join(parents, "id", "left_semi"), nodes.join(parents, "id", "left_anti")
    beside = F.col("up").isNotNull() & (_coin("id", level) == 0) & (_coin("up", level) == 1)
    if hot:
        beside &= ~F.col("up").isin(list(hot))
    at = F.when(beside, F.col("up")).otherwise(F.col("id"))
    spread = inner.withColumn("_at", at).repartition(max(1, -(-rows // partition_rows)), "_at").drop("_at")
    local = cut(spread.mapInPandas(lambda it: _solve_all(it, paths), _LOCAL))
    exits = cut(local.filter("exit is not null").groupBy("exit").agg(F.count(F.lit(1)).alias("n")))
    # A local circle that other fragments lead into stays in the quotient as a node that is its own parent.
    quotient = local.join(exits.select(F.col("exit").alias("id")), "id", "left_semi").select(
        "id", F.when(F.col("loop"), F.col("id")).otherwise(F.col("exit")).alias("up"), F.when(F.col("loop"), 1).otherwise(F.col("exit_d")).cast("bigint").alias("w"), F.col("top").alias("base"), F.col("top_d").alias("base_d"), "path"
    )
    solved = _resolve(cut(quotient), paths, solve_rows, partition_rows, level + 1, hot_children)
    done = cut(_expand(local, solved, _hot(exits, rows, hot_children)))
    low = leaves.select("id", F.col("base").alias("top"), F.col("base_d").alias("top_d"), F.col("up").alias("exit"), F.col("w").alias("exit_d"), F.lit(False).alias("loop"), "path")
    return done.unionByName(_expand(low, done, hot))


def _coin(name: str, level: int) -> Column:
    return F.pmod(F.xxhash64(F.col(name), F.lit(level)), F.lit(2))


def _expand(lower: DataFrame, results: DataFrame, hot: dict[str, int]) -> DataFrame:
    """Results of fragments: those of their exit, or their own where the exit is none or not in the table."""
    joined = _attach(lower, results, hot)
    found, loop = F.col("r_id").isNotNull(), F.col("loop") | F.coalesce(F.col("r_loop"), F.lit(False))
    return joined.select(
        F.col("id").alias("_id"),
        F.when(~loop, F.when(found, F.col("r_root")).otherwise(F.col("top"))).alias("_root"),
        F.when(loop, -1).when(found, F.col("r_depth") + F.col("exit_d")).otherwise(F.col("top_d")).cast("bigint").alias("_depth"),
        loop.alias("_loop"),
        F.when(~loop, F.when(found, F.concat("r_path", "path")).otherwise(F.col("path"))).alias("_path"),
    ).toDF("r_id", "r_root", "r_depth", "r_loop", "r_path")


def latest_rows(rows: DataFrame, key: str, seen: str) -> DataFrame:
    """Of each ``key`` the row with the greatest ``seen`` (ties: the greatest row). Rows with a null or empty key are no records."""
    others = [c for c in rows.columns if c not in (key, seen)]
    best = rows.filter(F.coalesce(F.col(key), F.lit("")) != "").groupBy(key).agg(F.max(F.struct(seen, *others)).alias("_best"))
    return best.select(key, "_best.*")


def resolve_hierarchy(
    links: DataFrame,
    node: str = "placement_id",
    parent: str = "parent_placement_id",
    *,
    paths: bool = True,
    solve_rows: int = SOLVE_ROWS,
    partition_rows: int = PARTITION_ROWS,
    hot_children: int = HOT_CHILDREN,
) -> DataFrame:
    """Each node's root, depth and path.

    ``links`` holds one row per node (see :func:`latest_rows`); a node without a parent (null or empty), or whose parent
    is not in the table, is a root of depth 0. Nodes in or below a circle of links get ``in_circle`` true, root and path
    null and depth -1. Other columns of ``links`` are ignored; an empty table gives an empty result.

    Returns ``node, root, depth, in_circle, path`` (``path`` from the root to the node; null without ``paths``). At most
    ``solve_rows`` nodes are solved in one task, ``partition_rows`` are expected in a partition of a contraction.
    """
    up = F.nullif(F.col(parent), F.lit(""))
    nodes = links.select(
        F.col(node).alias("id"),
        up.alias("up"),
        F.lit(1).cast("bigint").alias("w"),
        F.col(node).alias("base"),
        F.lit(0).cast("bigint").alias("base_d"),
        (F.array(F.col(node)) if paths else F.lit(None).cast("array<string>")).alias("path"),
    )
    return _resolve(cut(nodes), paths, solve_rows, partition_rows, 0, hot_children).toDF("node", "root", "depth", "in_circle", "path")


def descendants(hierarchy: DataFrame) -> DataFrame:
    """All ``ancestor, node, distance`` of a hierarchy resolved with paths (a node isn't its own descendant).

    Its size is the sum of all depths; every node expands only its own path.
    """
    pairs = hierarchy.filter(~F.col("in_circle")).select("node", "depth", F.posexplode("path").alias("at", "ancestor"))
    return pairs.filter(F.col("at") < F.col("depth")).select("ancestor", "node", (F.col("depth") - F.col("at")).alias("distance"))


def crawl_frontier(links: DataFrame, now: Column, retry_at: str = "next_retry_at") -> DataFrame:
    """``placement_id, level``: what a breadth-first crawl has to fetch next, ``level`` steps from a seed.

    ``links`` holds one row per placement, with ``parent_placement_id``, ``status`` and the time of the next try. Due are the
    PENDING ones, and those in RETRY_WAIT whose time isn't after ``now`` or isn't known. A placement that no seed (a
    placement without a parent) leads to, because its parent isn't in the table or it hangs on a circle, is never reached.
    """
    seeds = links.filter(F.coalesce("parent_placement_id", F.lit("")) == "").select(F.col("placement_id").alias("root"))
    reached = resolve_hierarchy(links, paths=False).filter("not in_circle").join(seeds, "root", "left_semi")
    waits = (F.col("status") == "RETRY_WAIT") & F.coalesce(F.col(retry_at) <= now, F.lit(True))
    due = links.filter((F.col("status") == "PENDING") | waits).select("placement_id")
    return due.join(reached.select(F.col("node").alias("placement_id"), F.col("depth").cast("bigint").alias("level")), "placement_id")
