"""Validation: declarative field rules per entity, accept / reject routing.

A *field* of a raw record is a value plus the kind of value it was:

* a table column ``f`` has the kind of its type (``STRING``, ``NUMBER``, ...),
* a JSON field is spread by ``sources.json_records.spread`` into a text column
  ``f`` and a column ``_kind_f``, whose NULL means that the key is absent.

Absent and NULL differ: a default replaces only an absent field.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lauter.functions import coerce, text
from lauter.operators.cleaning import clean
from lauter.schemas import AMOUNT, PRICE

POSITION = "_pos"
ERRORS = "_errors"
RECORD = "_record"
# why a line holds no record, or not all of it
PROBLEM = "problem"
KIND = "_kind_"

_REQUIRED = object()  # marks a field that has no default


@dataclass(frozen=True)
class Field:
    """How one field is parsed, judged and stored.

    ``parse`` turns text into a typed value once; ``faults`` lists
    ``(reason, condition)`` pairs over (text, kind, parsed), first match wins;
    ``store`` turns the parsed value into the stored one. ``default`` is used
    for an absent field only.
    """

    name: str
    parse: Callable[[Column, Column], Column]
    faults: Callable[[Column, Column, Column], list[tuple[str, Column]]]
    store: Callable[[Column], Column]
    nullable: bool = False
    default: Any = _REQUIRED

    def fault(self, value: Column, kind: Column, parsed: Column) -> Column:
        """The field's reason for rejection, or NULL."""
        missing = None if self.nullable else f"{self.name}: missing"
        reason = F.when(value.isNull(), F.lit(missing).cast("string"))
        for words, condition in self.faults(value, kind, parsed):
            reason = reason.when(condition, F.lit(f"{self.name}: {words}"))
        if self.default is not _REQUIRED:
            reason = F.when(kind.isNotNull(), reason)
        return reason

    def stored(self, kind: Column, parsed: Column) -> Column:
        value = self.store(parsed)
        if self.default is _REQUIRED:
            return value
        return F.when(kind.isNull(), F.lit(self.default)).otherwise(value)


def _text_field(
    name: str,
    *,
    max_length: int | None = None,
    store: Callable[[Column], Column] = text.strip,
    valid: Callable[[Column], Column] | None = None,
    nullable: bool = False,
    default: Any = _REQUIRED,
) -> Field:
    def faults(value: Column, kind: Column, parsed: Column) -> list[tuple[str, Column]]:
        found = [("not a string", kind != "STRING")]
        if max_length is not None:
            found.append((f"longer than {max_length}", F.length(value) > max_length))
        if valid is not None:
            found.append(("invalid", ~valid(value)))
        return found

    return Field(name, lambda value, kind: value, faults, store, nullable, default)


def _money_field(name: str, dtype: T.DecimalType, *, cents: bool, default: Any = _REQUIRED) -> Field:
    """Prices are rounded to cents before the sign check, amounts are not."""
    convert = coerce.to_price if cents else coerce.to_decimal

    def faults(value: Column, kind: Column, parsed: Column) -> list[tuple[str, Column]]:
        return [
            ("invalid", (kind == "BOOLEAN") | parsed.isNull()),
            ("negative", parsed < 0),
            ("out_of_range", parsed.try_cast(dtype).isNull()),
        ]

    return Field(
        name,
        lambda value, kind: convert(value),
        faults,
        lambda parsed: parsed.try_cast(dtype),
        default=default,
    )


def _integer_field(name: str, *, minimum: int | None, dtype: T.IntegralType) -> Field:
    def parse(value: Column, kind: Column) -> Column:
        flag = F.when(kind == "BOOLEAN", (value == "true").cast("bigint"))
        return F.coalesce(flag, coerce.to_integer(value))

    def faults(value: Column, kind: Column, parsed: Column) -> list[tuple[str, Column]]:
        found = [("invalid", parsed.isNull())]
        if minimum is not None:
            found.append((f"below {minimum}", parsed < minimum))
        return [*found, ("out_of_range", parsed.try_cast(dtype).isNull())]

    return Field(name, parse, faults, lambda parsed: parsed.try_cast(dtype))


def _timestamp_field(name: str) -> Field:
    def parse(value: Column, kind: Column) -> Column:
        native = F.when(kind == "TIMESTAMP", value.try_cast("timestamp_ntz"))
        return F.coalesce(native, coerce.to_timestamp(value))

    return Field(
        name,
        parse,
        lambda value, kind, parsed: [("invalid", parsed.isNull())],
        lambda parsed: parsed,
    )


def _upper_key(value: Column) -> Column:
    return F.upper(text.strip(value))


def _lower_label(value: Column) -> Column:
    return F.lower(text.strip(value))


def _title_label(value: Column) -> Column:
    return text.title_case(text.strip(value))


def _phone_number(value: Column) -> Column:
    return coerce.is_phone(text.strip(value))


@dataclass(frozen=True)
class Entity:
    """An entity's label in reject reasons, its fields and its dedup key."""

    label: str
    fields: tuple[Field, ...]
    key: str | None = None

    @property
    def field_names(self) -> list[str]:
        return [f.name for f in self.fields]


ENTITIES = {
    "customers": Entity(
        "customer",
        (
            _text_field("name", max_length=256),
            _text_field("email", valid=coerce.is_email, store=F.lower),
            _text_field("phone", valid=_phone_number, nullable=True),
        ),
        key="email",
    ),
    "categories": Entity(
        "category",
        (_text_field("name", max_length=128, store=_title_label),),
        key="name",
    ),
    "products": Entity(
        "product",
        (
            _text_field("sku", max_length=64, store=_upper_key),
            _text_field("name", max_length=256, store=lambda value: value),
            _text_field("category", store=text.title_case, nullable=True),
            _money_field("price", PRICE, cents=True),
        ),
        key="sku",
    ),
    "orders": Entity(
        "order",
        (
            _text_field("customer_email", store=F.lower),
            _text_field("status", max_length=32, store=_lower_label, default="pending"),
            _money_field("total_amount", AMOUNT, cents=False, default=Decimal("0.00")),
            _timestamp_field("ordered_at"),
        ),
    ),
    "order_items": Entity(
        "order item",
        (
            _integer_field("order_index", minimum=None, dtype=T.LongType()),
            _text_field("product_sku", store=_upper_key),
            _integer_field("quantity", minimum=1, dtype=T.IntegerType()),
            _money_field("unit_price", PRICE, cents=True),
        ),
    ),
}


def _kind_of(dtype: T.DataType) -> str:
    if isinstance(dtype, T.StringType):
        return "STRING"
    if isinstance(dtype, T.BooleanType):
        return "BOOLEAN"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return "TIMESTAMP"
    if isinstance(dtype, T.NumericType):
        return "NUMBER"
    return "OTHER"


def _spread_table(raw: DataFrame, names: list[str]) -> list[Column]:
    """Value and kind columns for ``names``, whichever way ``raw`` holds them."""
    types = {f.name: f.dataType for f in raw.schema.fields}
    columns = []
    for name in names:
        kind = f"{KIND}{name}"
        if name not in types:
            columns += [F.lit(None).cast("string").alias(name)]
            columns += [F.lit(None).cast("string").alias(kind)]
            continue
        column = F.col(f"`{name}`")
        if isinstance(types[name], T.TimestampType):
            column = column.cast("timestamp_ntz")
        columns.append(column.cast("string").alias(name))
        columns.append(
            F.col(kind) if kind in types else F.lit(_kind_of(types[name])).alias(kind)
        )
    return columns


def _raw_record(raw: DataFrame) -> Column:
    """The record as it arrived: its JSON text, or the row to be rendered as JSON."""
    if RECORD in raw.columns:
        return F.col(RECORD)
    return F.struct(*[F.col(f"`{c}`") for c in raw.columns if not c.startswith("_")])


def classify(
    raw: DataFrame,
    entity: str,
    *,
    order_by: Iterable[str] = (),
    keep: Iterable[str] = (),
) -> DataFrame:
    """Clean, coerce and judge every raw record.

    Returns the entity's stored fields, the columns named in ``keep``, ``_pos``
    (the record's place in the input), ``_errors`` (empty when accepted) and
    ``_record`` (the raw record as JSON, for rejected rows only).

    ``order_by`` names the columns that define "first"; a frame from
    :mod:`lauter.sources` carries ``_pos`` and needs none.
    """
    spec = ENTITIES[entity]
    keep = list(keep)
    place = [F.col(POSITION)] if POSITION in raw.columns else [F.col(c) for c in order_by]
    names = spec.field_names
    kept = [F.col(c).alias(f"_keep_{c}") for c in keep]
    spread = raw.select(
        F.struct(*place).alias("_place") if place else F.lit(None).alias("_place"),
        _raw_record(raw).alias(RECORD),
        *kept,
        *_spread_table(raw, names),
    )
    cleaned = clean(spread, names)
    parsed = cleaned.withColumns(
        {
            f"_parsed_{f.name}": f.parse(F.col(f.name), F.col(f"{KIND}{f.name}"))
            for f in spec.fields
        }
    )
    judged = parsed.select(
        *[
            f.stored(F.col(f"{KIND}{f.name}"), F.col(f"_parsed_{f.name}")).alias(f.name)
            for f in spec.fields
        ],
        *[F.col(f"_keep_{c}").alias(c) for c in keep],
        "_place",
        F.concat_ws(
            "; ",
            *[
                f.fault(F.col(f.name), F.col(f"{KIND}{f.name}"), F.col(f"_parsed_{f.name}"))
                for f in spec.fields
            ],
        ).alias(ERRORS),
        RECORD,
    )
    record = F.col(RECORD)
    if not isinstance(judged.schema[RECORD].dataType, T.StringType):
        record = F.to_json(record, {"ignoreNullFields": "false"})
    # Row numbers are added last and break ties in input order. _errors depends on
    # them so that a filter on it stays above: pushed down, it would run the text
    # cleaning and every rule a second time, in one enormous expression.
    row = F.monotonically_increasing_id()
    return judged.withColumns(
        {
            POSITION: F.struct(F.col("_place"), row),
            ERRORS: F.when(row >= 0, F.col(ERRORS)),
            RECORD: F.when(is_rejected(), record),
        }
    ).drop("_place")


def is_accepted() -> Column:
    return F.col(ERRORS) == ""


def is_rejected() -> Column:
    return F.col(ERRORS) != ""


def accepted(classified: DataFrame) -> DataFrame:
    return classified.where(is_accepted())


def rejected(classified: DataFrame) -> DataFrame:
    return classified.where(is_rejected())


def reason(entity: str) -> Column:
    """One line per rejected record: ``customer validation: email: invalid; ...``."""
    label = ENTITIES[entity].label
    return F.concat(F.lit(f"{label} validation: "), F.col(ERRORS))
