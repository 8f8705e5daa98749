"""Structured Streaming forms of the incremental measures, and their folds in batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from rastro.session import passing_folder


def run_to_end(stream: DataFrame, mode: str, each: Callable[[DataFrame, int], None] | None = None) -> DataFrame:
    """Run a stream over all that is there and read the result as a table in the shared folder.

    ``append`` writes every batch, ``complete`` replaces the table by the last batch. In ``update`` mode a batch holds only
    the keys it changed, so ``each`` must merge it into the table.
    """
    if mode == "update" and each is None:
        raise ValueError("update mode needs a function that merges each batch")
    spark = stream.sparkSession
    place = passing_folder(spark, "stream")
    out = f"{place}/out"
    if mode == "append" and each is None:
        writer = stream.writeStream.format("parquet").option("path", out)
    else:
        def replace(batch: DataFrame, _: int) -> None:
            batch.write.mode("overwrite").parquet(out)

        writer = stream.writeStream.foreachBatch(each or replace)
    query = writer.outputMode(mode).option("checkpointLocation", f"{place}/offsets").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def with_event_time(stream: DataFrame, at: str, late: str) -> DataFrame:
    """Zone-less times as instants, with a watermark."""
    return stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)


def running_counts(stream: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Counts, sums and last times per key, exactly those of a full recompute."""
    return stream.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.max("ts").alias("last_seen"))


def local_day_counts(stream: DataFrame, at: str, zone: str) -> DataFrame:
    """Rows per local calendar day."""
    return stream.groupBy(F.to_date(F.from_utc_timestamp(F.col(at), zone)).alias("local_day")).agg(F.count(F.lit(1)).alias("n"))


def sliding_counts(stream: DataFrame, at: str, size: str, step: str) -> DataFrame:
    """Rows in sliding windows."""
    w = F.window(at, size, step)
    return stream.groupBy(w).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "n")


def sessions(stream: DataFrame, key: str, at: str, gap: str) -> DataFrame:
    """Sessions of a key, ended by a gap."""
    w = F.session_window(at, gap)
    return stream.groupBy(w, key).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def first_only(stream: DataFrame, keys: list[str]) -> DataFrame:
    """The first row of each key within the watermark's reach."""
    return stream.dropDuplicatesWithinWatermark(keys)


def slot_versions(stream: DataFrame, slot: str, digest: str, order: str) -> DataFrame:
    """``slot, version, digest`` for the first and every changed content of a slot; the same content again is skipped.

    State per slot is its last digest and version, whatever the number of rows.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, version = state.get if state.exists else (None, 0)
        out = []
        for row in pd.concat(list(frames)).sort_values([order]).itertuples():
            if (now := getattr(row, digest)) != last:
                last, version = now, version + 1
                out.append((key[0], version, now))
        state.update((last, version))
        yield pd.DataFrame(out, columns=[slot, "version", digest])

    kind = dict(stream.dtypes)[slot]
    return stream.select(slot, digest, order).groupBy(slot).applyInPandasWithState(step, f"{slot} {kind}, version int, {digest} string", "last string, version int", "append", GroupStateTimeout.NoTimeout)


# ---- folds over ordered events, in batch ------------------------------------------------------------------------


def claim_states(events: DataFrame, task: str, kind: str, order: list[Column]) -> DataFrame:
    """State of each task after its events: SAVED and COMMITTED need the state before, HELD and SKIPPED are final.

    Each step's first valid time is an aggregate, so the events of a task are never gathered.
    """
    at = events.select(task, F.col(kind).alias("_k"), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]).alias("_o"))
    out = at.groupBy(task).agg(F.min(F.when(F.col("_k") == "reserve", F.col("_o"))).alias("_r"), F.min(F.when(F.col("_k").isin("hold", "skip"), F.struct("_o", "_k"))).alias("_f"))
    for step, before, name in (("save", "_r", "_s"), ("commit", "_s", "_c")):
        ready = out.filter(F.col(before).isNotNull()).select(F.col(task).alias("_t"), F.col(before).alias("_b"))
        next_ = at.filter(F.col("_k") == step).join(ready, F.col(task) == F.col("_t")).filter(F.col("_o") > F.col("_b")).groupBy("_t").agg(F.min("_o").alias(name))
        out = out.join(next_, F.col(task) == F.col("_t"), "left").drop("_t")
    committed = F.col("_c").isNotNull() & (F.col("_f").isNull() | (F.col("_c") < F.col("_f._o")))
    state = (
        F.when(committed, "COMMITTED").when(F.col("_f._k") == "hold", "HELD").when(F.col("_f._k") == "skip", "SKIPPED").when(F.col("_s").isNotNull(), "SAVED").when(F.col("_r").isNotNull(), "RESERVED").otherwise("PENDING")
    )
    return out.select(task, state.alias("state"))


def standing_decisions(events: DataFrame, key: str, kind: str, undo: str, order: list[Column]) -> DataFrame:
    """The decision that stands for each key after replay, where an undo takes back the latest standing one.

    Decisions and undos are matched like brackets: a decision stands if the number of standing ones never falls below its own.
    """
    w = Window.partitionBy(key).orderBy(*order)
    up = w.rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(key).orderBy(*[c.desc() for c in order]).rowsBetween(Window.unboundedPreceding, -1)  # what follows, read from the end
    walk = events.withColumn("_s", F.sum(F.when(F.col(kind) == undo, -1).otherwise(1)).over(up))
    depth = walk.withColumn("_d", F.col("_s") - F.least(F.lit(0), F.min("_s").over(up)))
    stands = (F.col(kind) != undo) & (F.coalesce(F.min("_d").over(down), F.col("_d")) >= F.col("_d"))
    kept = depth.withColumn("_ok", stands).filter("_ok")
    return kept.groupBy(key).agg(F.max(F.struct("_d", *[c.alias(f"o{i}") for i, c in enumerate(order)], kind)).alias("b")).select(key, F.col(f"b.{kind}").alias("decision"))


def budget_states(reservations: DataFrame, account: str, order: list[Column], reserved: Column, used: Column, limit: float) -> DataFrame:
    """Reservations of an account in order: unknown use keeps the whole reservation; whether each still fits the limit."""
    charge = F.coalesce(used, reserved)
    spent = F.sum(charge).over(Window.partitionBy(account).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return reservations.withColumn("spent", spent).withColumn("fits", F.col("spent") <= limit)


def accepted_batches(observations: DataFrame, batch: str, observation: str, account: str, at: str, limit: int) -> DataFrame:
    """``account, batch, observations, spent, accepted``: one row per batch of an account, delivered once or repeatedly.

    A batch counts once however often it is delivered, in the order of its first delivery (then of its id). It is accepted
    if its observations still fit the account's ``limit``; a batch that doesn't is refused and uses nothing, so that a
    smaller one behind it may fit. ``spent`` is the account's use after the batch. Accounts are sorted, not gathered.
    """
    kinds = dict(observations.dtypes)
    batches = observations.groupBy(account, batch).agg(F.countDistinct(observation).alias("observations"), F.min(at).alias("_at"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, spent = None, 0
        for frame in frames:
            totals, fits = [], []
            for who, n in zip(frame[account], frame["observations"], strict=True):
                if who != now:
                    now, spent = who, 0
                fits.append(spent + n <= limit)
                spent += n if fits[-1] else 0
                totals.append(spent)
            yield frame.drop(columns="_at").assign(spent=totals, accepted=fits)

    shape = f"{account} {kinds[account]}, {batch} {kinds[batch]}, observations bigint, spent bigint, accepted boolean"
    return batches.filter(F.col(account).isNotNull()).repartition(account).sortWithinPartitions(account, "_at", batch).mapInPandas(run, shape)


def merge_shards(rows: DataFrame, keys: list[str], source_digest: str, stamp: str, value: str) -> DataFrame:
    """Latest value per key, only from rows made of the key's latest source; with how many versions were seen."""
    best = rows.groupBy(*keys).agg(F.max(F.struct(stamp, source_digest, value)).alias("b"), F.countDistinct(value).alias("versions"))
    return best.select(*keys, F.col(f"b.{value}").alias(value), F.col(f"b.{source_digest}").alias(source_digest), "versions")
