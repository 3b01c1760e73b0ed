"""From raw JSON text to typed columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

from panelkit.sources.feeds import INGESTED_AT, INGESTED_ON, type_at

# The fields of an API answer that may hold its records, in order of preference.
RECORD_FIELDS = ("items", "results", "data")


def _as_text(data_type: DataType) -> DataType:
    """The same structure with every scalar read as text."""
    if isinstance(data_type, StructType):
        return StructType([StructField(f.name, _as_text(f.dataType)) for f in data_type.fields])
    return StringType()


def parse_json_records(
    df: DataFrame,
    schema: StructType,
    mapping: Mapping[str, str],
    column: str = "value",
    compat: bool = False,
    raw_out: str | None = None,
    rest_out: str | None = None,
) -> DataFrame:
    """Read one JSON record per row and project it: ``mapping`` takes JSON paths to column names.

    Scalars are read as text and then cast, so a quoted number is a number, and a value that does
    not fit its type becomes NULL without touching the rest of the record. With ``compat`` the
    text is rewritten first as older pipelines did: apostrophes become asterisks and all-digit
    strings lose their quotes (which breaks records with leading zeros).

    A record that is not valid JSON gives NULL in every column. ``raw_out`` keeps the text of
    exactly those records, so they can be counted or set aside. ``rest_out`` keeps the fields that the schema does not know,
    as a variant (NULL if there are none), for ``typed_fields`` to read when the schema has learned them. With either of them
    records are parsed into variants, once, and everything is taken from these.
    """
    text = F.col(column).cast("string")
    if compat:
        text = F.regexp_replace(F.regexp_replace(text, "'", "*"), r'"(\d+)"', "$1")
    whole = bool(rest_out or (raw_out and not compat))
    # Two projections: reading the fields off the call itself would parse the text once per field.
    record = F.try_parse_json("_text") if whole else F.from_json("_text", schema if compat else _as_text(schema))
    parsed = df.select(text.alias("_text")).select("_text", record.alias("_record"))
    if whole:
        values = [F.try_variant_get("_record", _variant_path(path), "string") for path in mapping]
    else:
        values = [_nested(F.col("_record"), path) for path in mapping]
    if whole or not compat:
        values = [v.try_cast(type_at(schema, path)) for v, path in zip(values, mapping)]
    columns = [v.alias(name) for v, name in zip(values, mapping.values())]
    if raw_out:
        valid = F.col("_record") if whole else F.try_parse_json("_text")
        columns.append(F.when(valid.isNull(), F.col("_text")).alias(raw_out))
    if rest_out:
        columns.append(_unknown_fields(F.col("_record"), schema).alias(rest_out))
    return parsed.select(*columns)


def _variant_path(path: str) -> str:
    return "$" + "".join(f"['{name}']" for name in path.split("."))


def _unknown_fields(record: Column, schema: StructType) -> Column:
    """The fields of a record that a schema does not have, as an object; a field is kept whole if it has unknown ones."""
    entries = F.try_variant_get(record, "$", "map<string, variant>")

    def unknown(fields: Column, known: StructType) -> Callable[[Column, Column], Column]:
        nested = {f.name: f.dataType for f in known.fields if isinstance(f.dataType, StructType)}
        plain = [f.name for f in known.fields if f.name not in nested]

        def keep(name: Column, value: Column) -> Column:
            found = ~name.isin(*plain) if plain else F.lit(True)
            for own, kind in nested.items():
                inner = F.try_variant_get(value, "$", "map<string, variant>")
                more = F.size(F.map_filter(inner, unknown(inner, kind))) > 0
                found = F.when(name == own, F.coalesce(more, F.lit(False))).otherwise(found)
            return found

        return keep

    rest = F.map_filter(entries, unknown(entries, schema))
    return F.when(F.size(rest) > 0, F.to_variant_object(rest))


def typed_fields(df: DataFrame, schema: StructType, mapping: Mapping[str, str], rest: str) -> DataFrame:
    """Rows as the schema has them now: a field that came before the schema knew it is read from the ``rest``.

    Columns of the mapping that the rows do not have are added. A value in a column of its own goes first.
    """

    def late(path: str) -> Column:
        return F.try_variant_get(rest, _variant_path(path), "string").try_cast(type_at(schema, path))

    found = {
        name: F.coalesce(F.col(name), late(path)) if name in df.columns else late(path) for path, name in mapping.items()
    }
    return df.withColumns(found)


def _nested(record: Column, path: str) -> Column:
    return reduce(lambda c, name: c[name], path.split("."), record)


def _as_list(variant: Column) -> Column:
    return F.try_variant_get(variant, "$", "array<variant>")


def _is_object(variant: Column) -> Column:
    return F.try_variant_get(variant, "$", "map<string, variant>").isNotNull()


def _record_list(text: Column, page: Column) -> Column:
    """Where an API answer keeps its records; NULL if nowhere.

    An answer that is a list holds them in its first nested list (none: no records). An object
    holds them in one of the usual fields, or else in its first non-empty list of objects, in
    the order of the document.
    """
    nested = F.filter(_as_list(page), lambda item: _as_list(item).isNotNull())
    from_list = F.when(
        _as_list(page).isNotNull(),
        F.coalesce(_as_list(F.try_element_at(nested, F.lit(1))), F.array().cast("array<variant>")),
    )
    named = [F.try_variant_get(page, f"$.{field}", "array<variant>") for field in RECORD_FIELDS]
    entries = F.try_variant_get(page, "$", "map<string, variant>")
    lists = F.transform(F.json_object_keys(text), lambda key: _as_list(F.try_element_at(entries, key)))
    with_objects = F.filter(lists, lambda items: _is_object(F.try_element_at(items, F.lit(1))))
    return F.coalesce(from_list, *named, F.try_element_at(with_objects, F.lit(1)))


def unwrap_records(
    pages: DataFrame, column: str, out: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """One row of JSON text per record found in pages of API answers.

    Pages without a recognisable list of records give no row; see ``unreadable_pages``.
    """
    text = F.col(column).cast("string")
    page = pages.withColumn("_page", F.try_parse_json(text))
    records = page.select(*keep, F.explode(_record_list(text, F.col("_page"))).alias("_record"))
    return records.select(*keep, F.to_json("_record").alias(out))


def unreadable_pages(pages: DataFrame, column: str) -> DataFrame:
    """Pages that are not JSON or hold no list of records."""
    text = F.col(column).cast("string")
    return pages.filter(_record_list(text, F.try_parse_json(text)).isNull())


def stamp_ingested(df: DataFrame, out: str = "ingested_at") -> DataFrame:
    """Add the time of ingestion; one and the same for all rows of a micro-batch."""
    return df.withColumn(out, F.current_timestamp())


def read_since(
    df: DataFrame, ts: str = INGESTED_AT, since: date | datetime | str | None = None, day: str = INGESTED_ON
) -> DataFrame:
    """Rows ingested at or after a time, by default since the start of the current day.

    The stored column is compared as it is, so the condition reaches the Parquet statistics. Where the table is
    partitioned by the ``day`` of it, earlier days are not even listed.
    """
    start = F.current_date() if since is None else F.lit(since)
    recent = df.filter(F.col(ts) >= start.cast(df.schema[ts].dataType))
    return recent.filter(F.col(day) >= start.cast("timestamp").cast("date")) if day in df.columns else recent
