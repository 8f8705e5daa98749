"""What changed between consecutive full snapshots.

Method: every record key gets one ordinal that holds for all snapshots; a snapshot is a compressed bitmap over the
ordinals plus a vector of values aligned with them. AND-NOT of consecutive bitmaps gives additions and removals, and
comparing the aligned vectors where both bitmaps are set gives the changes.

Keys are hash-partitioned and sorted, so ordinals are dense within a partition and the bitmaps come in containers of at
most ``CONTAINER`` ordinals: a task holds one container at a time, however large its partition is.

:func:`snapshot_changes` compares all deliveries of a table in one pass and needs ordinals only within it.
:func:`advance_snapshot` takes one new delivery: keys keep their ordinals in a stored state, new keys get the next ones,
and only the state and the delivery are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rastro.session import cut

CONTAINER = 1 << 16
SPARSE = 1 << 12  # a container with fewer ordinals is kept as an array of them
MAX_SNAPSHOTS = 10_000  # the snapshot list is sent to every task
NO_RANK = -(1 << 63)  # in vectors of ranks: none
_RANKS = "20000000000000000000"  # more than there are ranks (bigints) and the lack of one; decimals of 20 digits
_FIRST_RANK = "9223372036854775809"


class Bitmap:
    """Ordinals below ``size`` (at most ``CONTAINER``), as a sorted array while sparse and as packed bits when dense."""

    __slots__ = ("bits", "items", "size")

    def __init__(self, items: np.ndarray, size: int):
        self.size, self.items, self.bits = size, None, None
        if len(items) < SPARSE:
            self.items = np.unique(items).astype(np.uint32)
        else:
            flags = np.zeros(size, bool)
            flags[items] = True
            self.bits = np.packbits(flags)

    def _packed(self) -> np.ndarray:
        if self.bits is not None:
            return self.bits
        flags = np.zeros(self.size, bool)
        flags[self.items] = True
        return np.packbits(flags)

    def _unpack(self, bits: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bits, count=self.size))

    def and_not(self, other: Bitmap) -> np.ndarray:
        """Ordinals in this bitmap and not in the other."""
        if self.items is not None and other.items is not None:
            return np.setdiff1d(self.items, other.items, assume_unique=True)
        return self._unpack(self._packed() & ~other._packed())

    def both(self, other: Bitmap) -> np.ndarray:
        """Ordinals in both bitmaps."""
        if self.items is not None and other.items is not None:
            return np.intersect1d(self.items, other.items, assume_unique=True)
        return self._unpack(self._packed() & other._packed())


def clean_page_url(url: Column) -> Column:
    """``url`` without query, fragment, any ``/ref=`` part and trailing slash."""
    bare = F.regexp_replace(F.trim(url), r"[?#].*$", "")
    return F.regexp_replace(F.regexp_replace(bare, r"/ref=[^/]*", ""), r"/+$", "")


def rank_number(rank: Column, rank_raw: Column) -> Column:
    """``rank``, else the first number in ``rank_raw`` (points and commas group thousands), else null."""
    digits = F.regexp_replace(F.regexp_extract(rank_raw, r"(\d[\d.,]*)", 1), r"[.,]", "")
    return F.coalesce(rank.cast("bigint"), F.nullif(digits, F.lit("")).try_cast("bigint"))


def ordered_snapshots(snapshots: DataFrame) -> list[str]:
    """Snapshot ids in the order of ``observed_at`` (ties by id; an id given twice counts once, at its first time)."""
    rows = (
        snapshots.filter(F.col("snapshot_id").isNotNull())
        .groupBy("snapshot_id")
        .agg(F.min("observed_at").alias("at"))
        .orderBy(F.col("at").asc_nulls_last(), "snapshot_id")
        .limit(MAX_SNAPSHOTS + 1)
        .collect()
    )
    if len(rows) > MAX_SNAPSHOTS:
        raise ValueError(f"more than {MAX_SNAPSHOTS} snapshots: compare them in runs of at most that many")
    return [r.snapshot_id for r in rows]


def _changes(table: pa.Table, ids: list[str]) -> pa.RecordBatch | None:
    """Changes of the keys in ``table``, which holds all rows of each of its keys, sorted by key."""
    page, asin = table.column("page_url").combine_chunks(), table.column("asin").combine_chunks()
    fresh = np.ones(len(page), bool)
    if len(page) > 1:
        differs = pc.or_(pc.not_equal(page[1:], page[:-1]), pc.not_equal(asin[1:], asin[:-1]))
        fresh[1:] = differs.to_numpy(zero_copy_only=False)
    ordinal, start = np.cumsum(fresh) - 1, np.flatnonzero(fresh)
    at = table.column("at").to_numpy()
    value = table.column("value").fill_null(NO_RANK).to_numpy()
    size, snap, key, kind = len(start), [], [], []
    order = np.argsort(at, kind="stable")
    edges = np.searchsorted(at[order], np.arange(len(ids) + 1))
    before, vector = Bitmap(np.empty(0, np.int64), size), np.full(size, NO_RANK, np.int64)
    for s in range(len(ids)):
        rows = order[edges[s] : edges[s + 1]]
        now, current = Bitmap(ordinal[rows], size), np.full(size, NO_RANK, np.int64)
        current[ordinal[rows]] = value[rows]
        if s:
            common = now.both(before)
            for code, found in enumerate((now.and_not(before), before.and_not(now), common[current[common] != vector[common]])):
                snap.append(np.full(len(found), s)), key.append(found), kind.append(np.full(len(found), code))
        before, vector = now, current
    if not key or not (chosen := np.concatenate(key)).size:
        return None
    first = pa.array(start[chosen])
    names = pa.array(ids, pa.string()).take(pa.array(np.concatenate(snap)))
    kinds = pa.array(["added", "removed", "changed"], pa.string()).take(pa.array(np.concatenate(kind)))
    return pa.RecordBatch.from_arrays([names, page.take(first), asin.take(first), kinds], names=["snapshot_id", "page_url", "asin", "change"])


def _stream(batches: Iterator[pa.RecordBatch], ids: list[str]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < CONTAINER:
            continue
        table = pa.Table.from_batches(held)
        page, asin = table.column("page_url"), table.column("asin")
        last = pc.and_(pc.equal(page, page[-1]), pc.equal(asin, asin[-1])).to_numpy()
        edge = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0  # the last key may go on in the next batch
        if edge and (out := _changes(table.slice(0, edge), ids)) is not None:
            yield out
        held = table.slice(edge).to_batches()
        rows = sum(b.num_rows for b in held)
    if held and (out := _changes(pa.Table.from_batches(held), ids)) is not None:
        yield out


def _latest(cards: DataFrame, *within: str) -> DataFrame:
    """``page_url, asin, packed`` of each record (per value of ``within``): its row ingested last, of equal times the larger rank.

    ``packed`` is one number that sorts by ingestion time, then rank, and holds the rank: it fits a hash aggregate's buffer.
    Times are taken in microseconds of years below 33,000; any bigint is a rank.
    """
    rank = rank_number(F.col("rank"), F.col("rank_raw"))
    stamp = F.coalesce(F.unix_micros(F.col("ingested_at").cast("timestamp")), F.lit(0)).cast("decimal(18,0)")
    place = F.coalesce(rank.cast("decimal(20,0)") + F.lit(_FIRST_RANK).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    packed = (stamp * F.lit(_RANKS).cast("decimal(20,0)") + place).cast("decimal(38,0)")
    named = cards.select(*within, clean_page_url(F.col("source_url")).alias("page_url"), F.upper(F.trim("asin")).alias("asin"), packed.alias("packed"))
    return named.filter((F.col("page_url") != "") & (F.col("asin") != "")).groupBy(*within, "page_url", "asin").agg(F.max("packed").alias("packed"))


def _rank_of(packed: Column) -> Column:
    place = F.pmod(packed, F.lit(_RANKS).cast("decimal(20,0)"))
    return F.when(place != 0, (place - F.lit(_FIRST_RANK).cast("decimal(20,0)")).cast("bigint"))


STATE = "page_url string, asin string, ordinal bigint, present boolean, rank bigint"


def empty_state(spark: SparkSession) -> DataFrame:
    """The state before the first delivery."""
    return spark.createDataFrame([], STATE)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Containers of ``ordinal, was, old, now, new`` sorted by ordinal: the ordinals that changed, and how."""
    held: pa.Table | None = None

    def changed(table: pa.Table) -> pa.RecordBatch:
        low = table.column("ordinal").to_numpy() & (CONTAINER - 1)
        flags = {c: table.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("was", "now")}
        before, now = (Bitmap(low[flags[c]], CONTAINER) for c in ("was", "now"))
        vectors = []
        for c in ("old", "new"):
            vector = np.full(CONTAINER, NO_RANK, np.int64)
            vector[low] = table.column(c).fill_null(NO_RANK).to_numpy()
            vectors.append(vector)
        common = now.both(before)
        found = [now.and_not(before), before.and_not(now), common[vectors[0][common] != vectors[1][common]]]
        at = np.full(CONTAINER, -1, np.int64)
        at[low] = np.arange(len(low))
        rows = pa.array(at[np.concatenate(found)])
        kinds = np.repeat(np.array(["added", "removed", "changed"], object), [len(f) for f in found])
        return pa.RecordBatch.from_arrays([*(table.column(c).combine_chunks().take(rows) for c in ("page_url", "asin")), pa.array(kinds, pa.string())], names=["page_url", "asin", "change"])

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        container = table.column("ordinal").to_numpy() >> 16
        edges = [0, *(np.flatnonzero(np.diff(container)) + 1).tolist()]
        for start, end in zip(edges, edges[1:], strict=False):
            yield changed(table.slice(start, end - start))
        held = table.slice(edges[-1])
    if held is not None and held.num_rows:
        yield changed(held)


def advance_snapshot(state: DataFrame, cards: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(changes, new state)`` of one new full delivery against the stored ``state`` (see :func:`empty_state`).

    Keys keep their ordinal for ever, also while they are absent; new keys get the ordinals after the last one. The rules
    for records, ranks and missing values are those of :func:`snapshot_changes`; an empty delivery removes everything.
    ``changes`` holds ``page_url, asin, change``. Write the new state before the next delivery; both results read the
    materialised join, so neither rereads the state's own folder.
    """
    fresh = _latest(cards).select("page_url", "asin", _rank_of(F.col("packed")).alias("new"), F.lit(True).alias("now"))
    old = state.select("page_url", "asin", "ordinal", F.col("present").alias("was"), F.col("rank").alias("old"))
    met = cut(old.join(fresh, ["page_url", "asin"], "full").withColumns({"was": F.coalesce("was", F.lit(False)), "now": F.coalesce("now", F.lit(False)), "_part": F.spark_partition_id()}))
    last = met.agg(F.coalesce(F.max("ordinal"), F.lit(-1))).first()[0]
    counts = {r["_part"]: r["count"] for r in met.filter("ordinal is null").groupBy("_part").count().collect()}  # one number per partition
    base, start = {}, last + 1
    for part in sorted(counts):
        base[part], start = start, start + counts[part]
    starts = F.create_map(*[F.lit(x) for kv in base.items() for x in kv]) if base else F.create_map().cast("map<int,bigint>")
    nth = F.row_number().over(Window.partitionBy("_part").orderBy("page_url", "asin")) - 1
    new = met.filter("ordinal is null").withColumn("ordinal", (F.try_element_at(starts, F.col("_part")) + nth).cast("bigint"))
    numbered = cut(met.filter("ordinal is not null").unionByName(new).drop("_part"))
    kept = numbered.select("page_url", "asin", "ordinal", F.col("now").alias("present"), F.col("new").alias("rank"))
    lined = numbered.withColumn("_box", F.shiftright("ordinal", 16)).repartition("_box").sortWithinPartitions("ordinal").drop("_box")
    return lined.mapInArrow(_compare, "page_url string, asin string, change string"), kept


def snapshot_changes(cards: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Records added, removed or changed between consecutive snapshots.

    A record is a page and an ``asin``; of several rows for one record in one snapshot the one ingested last holds (of
    equal times the larger rank). Only a different rank is a change; no rank differs from any rank. Rows without
    ``snapshot_id``, ``asin`` or ``source_url`` identify no record and count for nothing, nor do rows of snapshots that
    are missing from ``snapshots``. A snapshot without rows is an empty delivery: all records are removed. Extra columns
    are ignored; empty tables give an empty result.

    Returns ``snapshot_id, page_url, asin, change``.
    """
    ids = ordered_snapshots(snapshots)
    spark = cards.sparkSession
    schema = "snapshot_id string, page_url string, asin string, change string"
    if not ids:
        return spark.createDataFrame([], schema)
    order = F.broadcast(spark.createDataFrame(list(enumerate(ids)), "at int, snapshot_id string"))
    latest = _latest(cards.select("snapshot_id", "asin", "rank", "rank_raw", "source_url", "ingested_at").join(order, "snapshot_id"), "at").withColumn("value", _rank_of(F.col("packed")))
    keyed = latest.select("page_url", "asin", "at", "value").repartition("page_url", "asin").sortWithinPartitions("page_url", "asin")
    return keyed.mapInArrow(lambda batches: _stream(batches, ids), schema)
