"""JSON documents, newline-delimited JSON and landed API pages.

Records are kept as VARIANT, so that a rule can tell a number from a string and
an absent key from an explicit null.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lauter.functions.text import strip
from lauter.operators.rules import ENTITIES, KIND, POSITION, PROBLEM, RECORD
from lauter.sources.json_scan import SURE_BYTES, page_udf, reduced_object
from lauter.sources.tables import with_position

VARIANT = "record"


def _kind(value: Column) -> Column:
    """``STRING``, ``BOOLEAN``, ``VOID`` (null), ``OBJECT``, ``ARRAY`` or a number's
    type; NULL for an absent value."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def _with_value(df: DataFrame, json: Column, out: str) -> DataFrame:
    """Add ``out``: the VARIANT of a text that is exactly one JSON value, else NULL.

    The parser stops after the first complete value; a marker placed behind the text
    shows that it got to the end. The marker is drawn anew for every frame, so no text
    can hold it.
    """
    end = uuid.uuid4().hex
    marked = F.try_parse_json(F.concat(F.lit("["), json, F.lit(f',"{end}"]')))
    complete = F.try_variant_get("_marked", "$[1]", "string") == end
    value = F.when(complete, F.try_variant_get("_marked", "$[0]", "variant"))
    return df.withColumn("_marked", marked).withColumn(out, value).drop("_marked")


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Classify JSON lines: adds ``record`` (VARIANT) and ``problem``.

    Blank lines vanish. ``problem`` is NULL for an object, otherwise
    ``malformed_json`` or ``not_an_object``; such lines are no records and do
    not count as failures. ``_record`` is the line's text. An object of more than
    ``SURE_BYTES`` is read member by member; if it has members too large for a VARIANT,
    ``record`` lacks those and ``problem`` is ``too_large``.
    """
    text = lines.withColumn(RECORD, strip(F.col(column))).where(F.col(RECORD) != "")
    large = F.when(F.octet_length(RECORD) > SURE_BYTES, F.col(RECORD))
    scanned = text.withColumn("_scan", reduced_object(large))
    whole = F.when(F.octet_length(RECORD) <= SURE_BYTES, F.col(RECORD)).otherwise(F.col("_scan.record"))
    parsed = _with_value(scanned, whole, "_value")
    # a text that is one value is an object if it begins like one
    objectlike = F.col(RECORD).startswith("{")
    problem = F.coalesce(
        F.col("_scan.problem"),
        F.when(F.col("_value").isNull(), "malformed_json").when(~objectlike, "not_an_object"),
    )
    return parsed.withColumns(
        {PROBLEM: problem, VARIANT: F.when(objectlike, F.col("_value"))}
    ).drop("_scan", "_value")


def line_records(lines: DataFrame, skipped: bool = False) -> DataFrame:
    """``record``, ``_record`` and ``_pos`` of the lines that hold an object.

    With ``skipped`` the other lines too, and every line's ``problem``: a load keeps them
    with the dead letters without counting them. Exploding a one-item array instead of
    filtering on ``problem`` keeps the parse out of a filter condition, so that each line
    is parsed once.
    """
    parsed = parse_lines(lines)
    if skipped:
        return parsed.select(VARIANT, RECORD, POSITION, PROBLEM)
    item = F.when(F.col(VARIANT).isNotNull(), F.array(VARIANT))
    return parsed.select(RECORD, POSITION, F.explode(item).alias(VARIANT)).select(VARIANT, RECORD, POSITION)


def read_ndjson(
    spark: SparkSession, path: str, encoding: str = "UTF-8", skipped: bool = False
) -> DataFrame:
    """Every object of a newline-delimited file as ``record``, ``_record``, ``_pos``.

    The scan is splittable. ``skipped`` as for :func:`line_records`.
    """
    reader = spark.read
    if encoding.upper() == "UTF-8":
        lines = reader.text(path)
    else:
        # the text source decodes UTF-8 only; CSV without separators decodes any
        reader = reader.option("encoding", encoding).option("sep", "\x01").option("quote", "")
        lines = reader.schema("value string").csv(path)
    return line_records(with_position(lines), skipped)


def _explode_document(document: Column) -> tuple[Column, Column]:
    """(array of VARIANT items, error message) of a whole JSON document."""
    wrapped = F.concat(F.lit('{"doc":'), document, F.lit(',"end":1}'))
    as_array = F.from_json(wrapped, "doc array<variant>, end int")
    as_value = F.from_json(wrapped, "doc variant, end int")
    first = F.substring(strip(document), 1, 1)
    items = F.when(first == "[", as_array["doc"]).when(first == "{", F.array(as_value["doc"]))
    complete = F.when(first == "[", as_array["end"]).otherwise(as_value["end"]) == 1
    error = F.when(~F.coalesce(complete, F.lit(False)), "malformed JSON document").when(
        ~first.isin("[", "{"), "expected a JSON array or object"
    )
    return items, error


def _objects(df: DataFrame, items: Column, *others: str) -> DataFrame:
    """One row per object in ``items``; other values are dropped."""
    rows = df.select(*others, F.posexplode(items).alias("_index", VARIANT))
    return rows.where(_kind(F.col(VARIANT)) == "OBJECT")


def parse_documents(documents: DataFrame, column: str, *others: str) -> DataFrame:
    """Records of whole JSON documents: the objects of an array, or a single object.

    Any other document fails the job, as does a malformed one.
    """
    items, error = _explode_document(F.col(column))
    checked = documents.withColumn("_items", items).withColumn("_error", error)
    safe = F.when(
        F.col("_error").isNotNull(), F.raise_error(F.col("_error")).cast("array<variant>")
    ).otherwise(F.col("_items"))
    return _objects(checked, safe, *others)


def read_json(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """Records of JSON document files as ``record``, ``_record``, ``_pos``.

    A malformed document fails the job; a file of no bytes is no document.
    """
    files = spark.read.format("binaryFile").load(path)
    documents = files.select(
        F.decode("content", encoding).alias("value"),
        F.col("path").alias("_path"),
    )
    rows = parse_documents(documents, "value", "_path")
    return rows.select(
        VARIANT,
        F.to_json(VARIANT).alias(RECORD),
        F.struct("_path", "_index").alias(POSITION),
    )


def flatten_pages(
    pages: DataFrame,
    payload: str,
    data_key: str | None = "results",
    next_key: str | None = "next",
) -> DataFrame:
    """Records of landed API payloads: ``record``, its text ``_record`` and ``next_url`` beside the page's columns.

    An object payload holds its records in the list under ``data_key`` (none when
    the key is missing) and the link to the next page under ``next_key``; a list
    payload is the records. Other shapes, and items that are not objects, yield nothing.

    A payload of more than ``SURE_BYTES`` is read record by record. A record that is itself
    too large lacks the members that are; its ``_record`` is the whole text. A payload of
    that size that is malformed is one record without fields: rules reject it, so that it
    is counted and its text kept with the dead letters.
    """
    text = F.col(payload)
    large = F.when(F.octet_length(text) > SURE_BYTES, text)
    scanned = pages.withColumn("_scan", page_udf(data_key, next_key)(large))
    small = F.when(F.octet_length(text) <= SURE_BYTES, text)
    value, kind = F.col("_payload"), F.col("_payload_kind")
    parsed = _with_value(scanned, small, "_payload").withColumn("_payload_kind", _container(value, text))
    items = F.when(kind == "[", value)
    following = F.col("_scan.next_url")
    if data_key:
        items = items.when(kind == "{", F.try_variant_get(value, _path(data_key), "variant"))
        if next_key:
            link = F.try_variant_get(value, _path(next_key), "string")
            following = F.coalesce(following, F.when((kind == "{") & (link != ""), link))
    others = [c for c in pages.columns if c not in (payload, RECORD)]
    nothing = F.parse_json(F.lit("{}"))
    lost = F.when(F.col("_scan.problem").isNotNull(), text)
    read = F.transform(F.col("_scan.items"), lambda i: F.coalesce(F.try_parse_json(i["small"]), nothing))
    listed = parsed.select(
        *others,
        following.alias("next_url"),
        F.coalesce(
            F.try_variant_get(items, "$", "array<variant>"), F.when(lost.isNotNull(), F.array(nothing)), read
        ).alias("_items"),
        F.when(lost.isNotNull(), F.array(lost)).otherwise(F.col("_scan.items.text")).alias("_texts"),
    )
    rows = _objects(listed, F.col("_items"), *others, "next_url", "_texts")
    whole = F.coalesce(F.get("_texts", F.col("_index")), F.to_json(VARIANT))
    return rows.select(*others, "next_url", VARIANT, whole.alias(RECORD))


def _container(value: Column, text: Column) -> Column:
    """``[`` or ``{`` for a text that was read and begins so."""
    first = F.substring(F.ltrim(text, F.lit(" \t\r\n")), 1, 1)
    return F.when(value.isNotNull(), first)


def _path(key: str) -> str:
    return "$['" + key.replace("'", "\\'") + "']"


def spread(records: DataFrame, fields: Sequence[str] | str, variant: str = VARIANT) -> DataFrame:
    """Turn VARIANT records into a table of text fields with their kinds.

    ``fields`` is a list of keys or the name of an entity. A field's kind column
    is NULL when the key is absent from that record.
    """
    names = ENTITIES[fields].field_names if isinstance(fields, str) else list(fields)
    columns, values = [], {}
    for name in names:
        values[f"_value_{name}"] = F.try_variant_get(F.col(variant), _path(name), "variant")
        value = F.col(f"_value_{name}")
        columns.append(F.try_variant_get(value, "$", "string").alias(name))
        columns.append(_kind(value).alias(f"{KIND}{name}"))
    internal = [c for c in (RECORD, POSITION, PROBLEM) if c in records.columns]
    return records.withColumns(values).select(*internal, *columns)


