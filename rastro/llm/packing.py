"""Filling containers of fixed capacity with texts.

Method: sum-of-squares online packing. A level array counts the partially filled containers of each level; every item
goes where the sum of the squared counts becomes least, an open container of some level or a new one. Rows are spread
over shards of bounded size by a hash of their id, each packed by itself; at the end of a shard the containers still
open are joined, fullest first, where two fit into one.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARD_ROWS = 50_000
MAX_KINDS = 1_000  # the list of capacities is part of the plan


class LevelArray:
    """Open containers by level, and the choice among them."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.count = np.zeros(capacity + 1, np.int64)
        self.open: dict[int, list[int]] = defaultdict(list)
        self.made = 0

    def place(self, size: int) -> int:
        """Container for an item of ``size`` (1 .. capacity)."""
        c, count = self.capacity, self.count
        new = 2 * count[size] + 1 if size < c else 0  # change of the sum of squares if a new container is opened
        levels = np.flatnonzero(count[1 : c - size + 1]) + 1
        best, at = new, 0
        if levels.size:
            after = np.where(levels + size < c, 2 * count[levels + size] + 1, 0)
            change = after - 2 * count[levels] + 1
            k = levels.size - 1 - int(change[::-1].argmin())  # of equal changes the fullest
            if change[k] <= best:
                best, at = change[k], int(levels[k])
        if at:
            box = self.open[at].pop()
            count[at] -= 1
        else:
            box, self.made = self.made, self.made + 1
        self._keep(box, at + size)
        return box

    def _keep(self, box: int, level: int) -> None:
        if level < self.capacity:
            self.open[level].append(box)
            self.count[level] += 1

    def join_open(self) -> dict[int, int]:
        """Move whole open containers into others: fullest first, each into the fullest other that has room."""
        moved: dict[int, int] = {}
        count, boxes = np.zeros(self.capacity + 1, np.int64), defaultdict(list)
        for level in range(self.capacity - 1, 0, -1):
            for box in self.open[level]:
                room = np.flatnonzero(count[: self.capacity - level + 1])
                at, host = (int(room[-1]), boxes[room[-1]].pop()) if room.size else (0, box)
                if at:
                    count[at] -= 1
                    moved[box] = host
                boxes[at + level].append(host)
                count[at + level] += 1
        return moved


def pack_shard(ids: np.ndarray, sizes: np.ndarray, capacity: int) -> pd.DataFrame:
    """Pieces of the items in the order given, with their containers numbered from 0."""
    levels = LevelArray(capacity)
    whole, rest = np.divmod(sizes, capacity)
    item, part, size, box = [], [], [], []
    for i, (w, r) in enumerate(zip(whole.tolist(), rest.tolist(), strict=True)):
        for p in range(w):
            item.append(i), part.append(p), size.append(capacity), box.append(levels.place(capacity))
        if r:
            item.append(i), part.append(w), size.append(r), box.append(levels.place(r))
        elif not w:
            item.append(i), part.append(0), size.append(0), box.append(0)  # without tokens: takes no room anywhere
    moved = levels.join_open()

    def home(b: int) -> int:
        while b in moved:
            b = moved[b]
        return b

    at = np.array([home(b) for b in box], np.int64)
    return pd.DataFrame({"doc_id": ids[np.array(item, int)], "part": np.array(part, np.int32), "n_tokens": np.array(size, np.int64), "box": at})


def pack(lengths: DataFrame, containers: DataFrame, *, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The container of every text, for each container kind.

    ``lengths(doc_id, n_tokens)``; ``containers(container_kind, capacity_tokens)``, where null or non-positive capacities
    make no container. A text is split only if it alone exceeds the capacity: into full containers and one rest, which is
    packed like a text. Texts without tokens (or with a null length) lie in their shard's first container. Repeated rows
    are packed as rows of their own; extra columns are ignored; empty tables give an empty result.

    Returns ``container_kind, capacity_tokens, container_id, doc_id, part, n_tokens``. ``container_id`` holds the shard and
    the container's number in it, so it is unique within a kind.
    """
    shards = max(1, -(-lengths.count() // shard_rows))
    schema = "container_kind string, capacity_tokens int, container_id string, doc_id bigint, part int, n_tokens bigint"
    kinds = containers.filter("capacity_tokens > 0").select("container_kind", "capacity_tokens").distinct().limit(MAX_KINDS + 1).collect()
    if len(kinds) > MAX_KINDS:
        raise ValueError(f"more than {MAX_KINDS} container kinds")
    if not kinds:
        return lengths.sparkSession.createDataFrame([], schema)
    each = F.array(*[F.struct(F.lit(k.container_kind).alias("container_kind"), F.lit(k.capacity_tokens).cast("int").alias("capacity_tokens")) for k in kinds])
    rows = (
        lengths.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("n_tokens"), F.lit(0)).cast("bigint").alias("n_tokens"))
        .withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(shards)).cast("int"))
        .select("*", F.inline(each))
    )

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        kind, capacity, shard = key
        frame = frame.sort_values(["doc_id", "n_tokens"], kind="stable")
        order = np.random.default_rng(0).permutation(len(frame))  # the stream's order carries no trend of the ids
        out = pack_shard(frame["doc_id"].to_numpy()[order], frame["n_tokens"].to_numpy()[order], int(capacity))
        out["container_kind"], out["capacity_tokens"] = kind, int(capacity)
        out["container_id"] = [f"{shard}-{b}" for b in out["box"]]
        return out[["container_kind", "capacity_tokens", "container_id", "doc_id", "part", "n_tokens"]]

    return rows.groupBy("container_kind", "capacity_tokens", "shard").applyInPandas(run, schema)


def fill_report(packed: DataFrame) -> DataFrame:
    """Per kind: texts, containers, tokens, the least number of containers any packing needs, and the share filled."""
    boxes = packed.groupBy("container_kind", "capacity_tokens", "container_id").agg(F.sum("n_tokens").alias("level"))
    report = boxes.groupBy("container_kind", "capacity_tokens").agg(
        F.count(F.lit(1)).alias("containers"), F.sum("level").alias("tokens"), F.max("level").alias("fullest")
    )
    return report.withColumn("least", F.ceil(F.col("tokens") / F.col("capacity_tokens"))).withColumn("filled", F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")))
