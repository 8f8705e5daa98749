"""Sinks of catalogue tables: written by tasks, committed as a whole, sealed by content, verified by reading back."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rastro.operators.joins import bag_difference


def row_text(rows: DataFrame) -> Column:
    """A row as JSON with its keys sorted: what digests are taken of."""
    return F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"})


def content_digest(rows: DataFrame) -> str:
    """A digest of a table as a bag of rows, whatever their order and partitions: sums of row digests, added up in tasks."""
    h = F.sha2(row_text(rows), 256)
    parts = [F.coalesce(F.sum(F.conv(F.substring(h, 1 + 12 * i, 12), 16, 10).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")) for i in range(5)]
    return rows.agg(F.sha2(F.concat_ws("|", F.count(F.lit(1)).cast("string"), *[p.cast("string") for p in parts]), 256).alias("d")).head().d


def write_once(rows: DataFrame, path: str) -> bool:
    """Write a table that must never change: True if it was written, False if the same rows are there; other rows are an error."""
    spark = rows.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        rows.write.mode("errorifexists").parquet(path)
        return True
    if content_digest(spark.read.parquet(path)) != content_digest(rows):
        raise ValueError(f"{path} holds other rows")
    return False


def seal(rows: DataFrame, version: int = 1) -> DataFrame:
    """Rows as ``schema_version, payload, payload_sha256``."""
    text = row_text(rows)
    return rows.select(F.lit(version).alias("schema_version"), text.alias("payload"), F.sha2(text, 256).alias("payload_sha256"))


def flat(rows: DataFrame) -> DataFrame:
    """Nested columns as JSON text."""
    nested = [n for n, t in rows.dtypes if t.startswith(("array", "struct", "map"))]
    return rows.withColumns({n: F.to_json(n) for n in nested}) if nested else rows


def preferred_first(rows: DataFrame, preferred: list[str]) -> DataFrame:
    """Preferred columns in their order, then the others in theirs."""
    return rows.select(*[c for c in preferred if c in rows.columns], *[c for c in rows.columns if c not in preferred])


def write_twin(rows: DataFrame, folder: str) -> None:
    """The same rows as JSON lines and as CSV (nested values as JSON text)."""
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{folder}/jsonl")
    flat(rows).write.mode("overwrite").csv(f"{folder}/csv", header=True, quoteAll=True, escape='"', nullValue="\\N", emptyValue="")


def read_twin_csv(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(f"{folder}/csv", header=True, multiLine=True, escape='"', nullValue="\\N", emptyValue="")


def twin_differences(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Rows that the two forms don't share; empty exactly if they hold the same."""
    return bag_difference(spark.read.schema(schema).json(f"{folder}/jsonl"), read_twin_csv(spark, folder, schema))


def publish_snapshot(rows: DataFrame, folder: str, snapshot: str, authoritative: bool) -> None:
    """Append a snapshot as its own partition; only an authoritative one moves the pointer to the latest."""
    write_once(rows, f"{folder}/snapshot_id={snapshot}")
    if authoritative:
        rows.sparkSession.createDataFrame([(snapshot,)], "snapshot_id string").coalesce(1).write.mode("overwrite").parquet(f"{folder}/_latest")


def manifest(rows: DataFrame, part: str) -> DataFrame:
    """Per part: rows and a digest of its rows in any order."""
    h = F.sha2(row_text(rows), 256)
    total = F.sum(F.conv(F.substring(h, 1, 12), 16, 10).cast("decimal(38,0)"))
    return rows.groupBy(part).agg(F.count(F.lit(1)).alias("n"), F.sha2(total.cast("string"), 256).alias("digest"))


def bounded(c: Column, size: int) -> Column:
    """Text cut to ``size`` characters, for a field of fixed width; whether it was cut is told beside it."""
    return F.struct(F.substring(c, 1, size).alias("text"), (F.length(c) > size).alias("cut"))


def upsert(old: DataFrame, new: DataFrame, key: str, stamp: str) -> DataFrame:
    """Rows of either side, per key the one with the greatest stamp; of equal stamps the new one."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    best = both.groupBy(key).agg(F.max(F.struct(stamp, "_new", *[c for c in old.columns if c not in (key, stamp)])).alias("_b"))
    return best.select(*[F.col(key) if c == key else F.col(f"_b.{c}").alias(c) for c in old.columns])


def markdown(rows: DataFrame, title: str, limit: int = 200) -> str:
    """A report of a small table as Markdown; a larger one than ``limit`` rows is an error, not a cut."""
    found = rows.limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"more than {limit} rows: aggregate before reporting")
    lines = [f"# {title}", "", "| " + " | ".join(rows.columns) + " |", "|" + "---|" * len(rows.columns)]
    lines += ["| " + " | ".join(json.dumps(v, ensure_ascii=False, default=str) for v in r) + " |" for r in found]
    return "\n".join(lines) + "\n"
