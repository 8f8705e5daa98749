"""Entity, attribute, value rows to one row per entity with typed columns.

Method: labels and values are read as expressions, and every (entity, column) is reduced to its smallest and largest
reading before anything is shuffled by entity, so an entity that holds a third of all rows costs one row per column.
Entities are then hash-bucketed; in each bucket entity and column are dictionary-encoded, the values are scattered into
one numpy array per type by row and column index, and leave as Arrow tables of the wide schema.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rastro.functions.quantities import UNITS, spanish_number, unit_factor
from rastro.functions.text import clean, fold, lookup_key

MAX_COLUMNS = 2_000  # the column list is sent to every task

# Texts that state nothing, as lookup keys.
UNREADABLE = ["", "n d", "n a", "na", "nd", "no aplicable", "no disponible", "desconocido", "consultar", "ver descripcion", "unknown", "null", "none", "sin datos", "sin especificar"]
YES = ["si", "yes", "true", "verdadero", "apto", "apta", "1", "y", "s"]
NO = ["no", "false", "falso", "no apto", "no apta", "0", "n"]
NUMERALS = ["cero", "uno", "dos", "tres", "cuatro", "cinco", "seis", "siete", "ocho", "nueve", "diez", "once", "doce", "trece", "catorce", "quince", "dieciseis", "diecisiete", "dieciocho", "diecinueve", "veinte"]
MONTHS = {
    1: "enero ene january jan", 2: "febrero feb february", 3: "marzo mar march", 4: "abril abr april apr", 5: "mayo may", 6: "junio jun june",
    7: "julio jul july", 8: "agosto ago august aug", 9: "septiembre setiembre sep sept set september", 10: "octubre oct october", 11: "noviembre nov november", 12: "diciembre dic december dec",
}


@dataclass(frozen=True)
class WideColumn:
    """One column of the wide table; ``unit`` is a base unit, ``n`` for counts, or none."""

    name: str
    kind: str
    unit: str | None


Labels = Mapping[str, Sequence[str]]


def wide_columns(columns: DataFrame, labels: Labels | None = None) -> tuple[list[WideColumn], dict[str, str]]:
    """The columns of the wide table and the column of each label key: its one label in ``columns``, and those in ``labels``."""
    rows = columns.select("column_name", "data_type", "unit", "label_es").distinct().orderBy("column_name").limit(MAX_COLUMNS + 1).collect()
    if len(rows) > MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} columns")
    own = {r.label_es: r.column_name for r in rows if r.label_es}
    given = [(label, name) for name, more in (labels or {}).items() for label in more] + list(own.items())
    keys: dict[str, str] = {}
    if given:
        spark = columns.sparkSession
        keyed = spark.createDataFrame(given, "label string, name string").select(lookup_key(F.col("label")).alias("key"), "name").collect()
        keys |= {r.key: r.name for r in keyed}
    wide = [WideColumn(r.column_name, (r.data_type or "string").lower(), r.unit or ("n" if (r.data_type or "").lower() == "bigint" else None)) for r in rows]
    return wide, {k: v for k, v in keys.items() if v in {w.name for w in wide}}


def _reading(rows: DataFrame, wide: list[WideColumn]) -> DataFrame:
    """``column_name, _unit, _value`` -> with ``number`` and ``text``, both null if the statement can't be read.

    Built in steps so that each pattern is matched once per row.
    """
    shown = rows.withColumn("_shown", clean(F.col("_value"))).withColumn("_text", fold(F.col("_shown"))).withColumn("_key", lookup_key(F.col("_text")))
    stated = ~F.coalesce("_key", F.lit("")).isin(UNREADABLE)
    text, key, column = F.col("_text"), F.col("_key"), F.col("column_name")

    def groups(df: DataFrame, pattern: str, *names: str) -> DataFrame:
        return df.withColumns({n: F.nullif(F.regexp_extract(text, pattern, i + 1), F.lit("")) for i, n in enumerate(names)})

    names_of = {kind: [w.name for w in wide if w.kind == kind] for kind in ("bigint", "boolean", "date")}
    months = F.create_map(*[F.lit(x) for n, names in MONTHS.items() for name in names.split() for x in (name, n)])
    numerals = F.create_map(*[F.lit(x) for n, word in enumerate(NUMERALS) for x in (word, float(n))], F.lit("una"), F.lit(1.0), F.lit("un"), F.lit(1.0))
    many = "(?:juego de |set de |pack de |set of |pack of )?"
    parts = groups(shown, r"^(?:aprox\.?|aproximadamente|approx\.?|unos|unas|ca\.?|~)? ?(\d[\d.,]*?)[.,]? ?([a-z\"″”][a-z0-9³. ]*)?$", "_n", "_u")
    parts = groups(parts, rf"^{many}([\d.]+?|[a-z]+)\.?(?: ?(?:piezas?|uds?|unidad(?:es)?|pcs?|pieces?)\.?)?$", "_c")
    parts = groups(parts, r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})(?:[t ].*)?$", "_y1", "_m1", "_d1")
    parts = groups(parts, r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})$", "_d2", "_m2", "_y2")
    parts = groups(parts, r"^(\d{1,2})\.? (?:de )?([a-z]+)\.?,? (?:de |del )?(\d{4})$", "_d3", "_w3", "_y3")
    parts = groups(parts, r"^([a-z]+)\.? (\d{1,2}),? (\d{4})$", "_w4", "_d4", "_y4")
    unit = F.trim(F.regexp_replace(F.coalesce("_u", "_unit"), r"[. ]+", " "))
    month = F.coalesce("_m1", "_m2", F.try_element_at(months, F.coalesce("_w3", "_w4")).cast("string"))
    made = F.concat_ws("-", F.coalesce("_y1", "_y2", "_y3", "_y4"), F.lpad(month, 2, "0"), F.lpad(F.coalesce("_d1", "_d2", "_d3", "_d4"), 2, "0"))
    parts = parts.withColumns({"_number": spanish_number(F.col("_n")), "_unit2": unit, "_date": made.try_cast("date"), "_count": F.coalesce(spanish_number(F.col("_c")), F.try_element_at(numerals, F.col("_c")))})
    serial = F.when(text.rlike(r"^[2-6]\d{4}$"), text.try_cast("int") - 25569)  # a spreadsheet's day number
    found = F.lit(None).cast("double")
    for base in UNITS:
        if names := [w.name for w in wide if w.unit == base and w.kind == "bigint"]:
            found = F.when(column.isin(names), F.col("_number") * unit_factor(F.col("_unit2"), base)).otherwise(found)
    if names := [w.name for w in wide if w.unit == "n" and w.kind == "bigint"]:
        found = F.when(column.isin(names), F.col("_count")).otherwise(found)
    if names_of["boolean"]:
        found = F.when(column.isin(names_of["boolean"]), F.when(key.isin(YES), 1.0).when(key.isin(NO), 0.0)).otherwise(found)
    if names_of["date"]:
        found = F.when(column.isin(names_of["date"]), F.coalesce(F.unix_date("_date"), serial).cast("double")).otherwise(found)
    texts = ~column.isin([n for names in names_of.values() for n in names])
    return parts.withColumns({"number": F.when(stated, found), "text": F.when(stated & texts, F.lower("_shown"))})


def statements(rows: DataFrame, columns: DataFrame, *, entity: str = "asin", label: str = "label_raw", value: str = "value_raw", labels: Labels | None = None) -> DataFrame:
    """Statements: ``entity, column_name, number, text``, both null if unreadable. Rows without entity, or of labels no column asks for, are left out.

    Unreadable ones are not filtered here: the filter would be pushed below the readings and evaluate them twice.
    """
    wide, keys = wide_columns(columns, labels)
    if not wide or not keys:
        return rows.sparkSession.createDataFrame([], "entity string, column_name string, number double, text string")
    visible = fold(clean(F.col(label)))
    label_unit = F.nullif(F.regexp_extract("_visible", r"\(([^()]*)\)[ :?]*$", 1), F.lit(""))
    table = F.create_map(*[F.lit(x) for kv in sorted(keys.items()) for x in kv])
    column = F.coalesce(F.try_element_at(table, F.col("_whole")), F.try_element_at(table, F.col("_bare")))
    known = (
        rows.select(F.upper(clean(F.col(entity))).alias("entity"), visible.alias("_visible"), F.col(value).alias("_value"))
        .filter(F.col("entity") != "")
        .select("entity", "_value", label_unit.alias("_unit"), lookup_key(F.col("_visible")).alias("_whole"), lookup_key(F.regexp_replace("_visible", r"\([^()]*\)[ :?]*$", "")).alias("_bare"))
        .withColumn("column_name", column)
        .filter("column_name is not null")
    )
    return _reading(known, wide).select("entity", "column_name", "number", "text")


def _scatter(table: pa.Table, wide: list[WideColumn]) -> pa.RecordBatch:
    """Rows (entity, column, value) of whole entities to rows of the wide schema."""
    entity = table.column("entity").combine_chunks().dictionary_encode()
    column = pc.index_in(table.column("column_name"), value_set=pa.array([w.name for w in wide])).to_numpy()
    row, n = entity.indices.to_numpy(), len(entity.dictionary)
    numbers = table.column("number").to_numpy()
    slots = {kind: [i for i, w in enumerate(wide) if (w.kind if w.kind in ("bigint", "boolean", "date") else "string") == kind] for kind in ("bigint", "boolean", "date", "string")}
    made: dict[int, pa.Array] = {}
    for kind, members in slots.items():
        place = np.full(len(wide), -1)
        place[members] = np.arange(len(members))
        mine = np.flatnonzero(place[column] >= 0)
        at, to = row[mine], place[column[mine]]
        filled = np.zeros((len(members), n), bool)
        filled[to, at] = True
        if kind == "string":
            source = np.zeros((len(members), n), np.int64)
            source[to, at] = mine
            texts = table.column("text").combine_chunks()
            for k, i in enumerate(members):
                made[i] = texts.take(pa.array(source[k], mask=~filled[k]))
            continue
        values = np.zeros((len(members), n), {"bigint": np.int64, "boolean": bool, "date": np.int32}[kind])
        values[to, at] = np.floor(numbers[mine] + 0.5)
        kinds = {"bigint": pa.int64(), "boolean": pa.bool_(), "date": pa.date32()}
        for k, i in enumerate(members):
            made[i] = pa.array(values[k], mask=~filled[k]).cast(kinds[kind])
    return pa.RecordBatch.from_arrays([entity.dictionary, *(made[i] for i in range(len(wide)))], names=["entity", *(w.name for w in wide)])


def _wide_batches(batches: Iterator[pa.RecordBatch], wide: list[WideColumn]) -> Iterator[pa.RecordBatch]:
    """Sorted by entity; the last entity of a batch waits for the next one."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        entity = table.column("entity")
        edge = int(np.argmax(pc.equal(entity, entity[-1]).to_numpy()))
        if edge:
            yield _scatter(table.slice(0, edge), wide)
        held = table.slice(edge)
    if held is not None and held.num_rows:
        yield _scatter(held, wide)


def wide_table(rows: DataFrame, columns: DataFrame, *, entity: str = "asin", label: str = "label_raw", value: str = "value_raw", labels: Labels | None = None) -> DataFrame:
    """One row per entity with the typed columns that ``columns`` lists; ``labels`` names more labels of a column beside its usual one.

    A cell is filled if at least one of its statements is readable and all readable ones agree after conversion to whole
    numbers of the column's unit (texts: ignoring case and blanks); contradicted and unread cells are null, and an entity none of whose statements is readable has no
    row. Rows with null or empty entity count for nothing, a null label or value states nothing; other columns of
    ``rows`` are ignored; empty tables give an empty result with the same columns.

    Returns the entity column (upper case, trimmed) and one column per row of ``columns``, in the order of their names.
    """
    wide, _ = wide_columns(columns)
    kinds = {"bigint": "bigint", "boolean": "boolean", "date": "date"}
    schema = ", ".join(["entity string", *(f"`{w.name}` {kinds.get(w.kind, 'string')}" for w in wide)])
    if not wide:
        return rows.select(F.upper(clean(F.col(entity))).alias(entity)).filter(F.col(entity) != "").limit(0)
    cells = (
        statements(rows, columns, entity=entity, label=label, value=value, labels=labels)
        .groupBy("entity", "column_name")
        .agg(F.min("number").alias("lo"), F.max("number").alias("hi"), F.min("text").alias("t_lo"), F.max("text").alias("t_hi"))
    )
    same = F.floor(F.col("lo") + 0.5) == F.floor(F.col("hi") + 0.5)
    kept = cells.select("entity", "column_name", F.when(same, F.col("lo")).alias("number"), F.when(F.col("t_lo") == F.col("t_hi"), F.col("t_lo")).alias("text"))
    cut_up = kept.filter("number is not null or text is not null").repartition("entity").sortWithinPartitions("entity")
    return cut_up.mapInArrow(lambda batches: _wide_batches(batches, wide), schema).withColumnRenamed("entity", entity)
