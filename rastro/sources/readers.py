"""Scans of catalogue files. Paths may be any the session can read; schemas are given, never guessed, where speed counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rastro.operators.rows import first_by


def json_records(spark: SparkSession, path: str, schema: str, wrappers: tuple[str, ...] = ("records", "rankings")) -> DataFrame:
    """Rows of JSON documents that hold a list, or an object with a list under one of ``wrappers``, or one keyed by id."""
    text = spark.read.text(path, wholetext=True).select("value")
    lists = F.coalesce(*[F.from_json(F.get_json_object("value", f"$.{w}"), f"array<struct<{schema}>>") for w in wrappers], F.when(F.ltrim("value").startswith("["), F.from_json("value", f"array<struct<{schema}>>")))
    keyed = F.map_values(F.from_json("value", f"map<string,struct<{schema}>>"))
    return text.select(F.inline(F.coalesce(lists, keyed)))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row per line; a line that is no JSON gives a row of nulls, which the caller can count."""
    return spark.read.schema(schema).json(path)


def with_aliases(rows: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Canonical columns from the first filled alias; the raw columns stay."""
    have = {c.lower(): c for c in rows.columns}
    made = {}
    for name, names in aliases.items():
        known = [F.nullif(F.trim(F.col(have[a.lower()]).cast("string")), F.lit("")) for a in names if a.lower() in have]
        made[name] = F.coalesce(*known) if known else F.lit(None).cast("string")
    return rows.withColumns(made)


def product_csv(spark: SparkSession, path: str, aliases: dict[str, list[str]]) -> DataFrame:
    """A CSV with a header (a byte-order mark is dropped), all columns as text, with canonical aliases."""
    rows = spark.read.csv(path, header=True, multiLine=True, escape='"')
    return with_aliases(rows.toDF(*[c.lstrip("﻿") for c in rows.columns]), aliases)


def html_index(spark: SparkSession, folder: str, pattern: str = r"([A-Z0-9]{10})\.html$", glob: str = "*.html") -> DataFrame:
    """``item, path, body, sha256`` of the first file per item, in the order of paths, in all folders below."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder)
    named = files.select(F.nullif(F.regexp_extract("path", pattern, 1), F.lit("")).alias("item"), "path", F.decode("content", "utf-8").alias("body"), F.sha2("content", 256).alias("sha256"))
    return first_by(named.filter("item is not null"), ["item"], [F.col("path")])


def sealed(rows: DataFrame, payload: str = "payload", digest: str = "payload_sha256", backup: str = "backup", backup_digest: str = "backup_sha256") -> DataFrame:
    """The payload of sealed rows: the one whose digest holds, else the backup whose digest holds, else null."""

    def holds(text: str, seal: str) -> Column:
        return F.sha2(F.col(text), 256) == F.col(seal)

    return rows.withColumn("verified", F.coalesce(F.when(holds(payload, digest), F.col(payload)), F.when(holds(backup, backup_digest), F.col(backup))))


def run_rows(rows: DataFrame, run: str, value: str, order: str) -> DataFrame:
    """Rows of one run in the order they came in."""
    return rows.filter(F.col(run) == value).orderBy(order)


def json_equals(rows: DataFrame, column: str, path: str, value: str) -> DataFrame:
    """Rows whose JSON text has ``value`` at ``path``."""
    return rows.filter(F.get_json_object(column, path) == value)


def header_rows(rows: DataFrame, order: str, cells: str, wanted: list[str], within: int = 10) -> DataFrame:
    """Rows below the first of the first ``within`` rows whose cells hold all of ``wanted``, as columns of those names."""
    head = rows.filter((F.col(order) < within) & F.forall(F.array(*map(F.lit, wanted)), lambda w: F.array_contains(F.col(cells), w))).agg(F.min_by(F.struct(F.col(order).alias("at"), F.col(cells).alias("names")), F.col(order)).alias("h"))
    below = rows.join(F.broadcast(head)).filter(F.col(order) > F.col("h.at"))
    return below.select(*[F.get(F.col(cells), (F.array_position("h.names", w) - 1).cast("int")).alias(w) for w in wanted])


def binary_by_item(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """``item, length`` of binary files named by their item."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select(F.regexp_extract("path", pattern, 1).alias("item"), "length").filter("item <> ''")


def stream_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table as a stream of its files, each read once (offsets are kept in the checkpoint)."""
    path = f"{sf_dir}/{table}.parquet"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(hadoop).isDirectory()
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    return reader.parquet(path) if folder else reader.option("pathGlobFilter", f"{table}.parquet").parquet(sf_dir)
