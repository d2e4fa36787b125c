"""Stored tables: types, natural keys and what an upsert may change."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

PRICE = T.DecimalType(10, 2)
AMOUNT = T.DecimalType(12, 2)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in columns.items()])


@dataclass(frozen=True)
class Table:
    """A stored table.

    Tables with a natural ``key`` are upserted (``updates`` lists the columns a
    conflict overwrites, ``sticky`` those where a NULL keeps the old value);
    the others are appended to, one folder per load.
    """

    name: str
    schema: T.StructType
    key: tuple[str, ...] = ()
    updates: tuple[str, ...] = ()
    sticky: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()

    @property
    def keyed(self) -> bool:
        return bool(self.key)


TABLES = {
    table.name: table
    for table in (
        Table(
            "categories",
            _schema(
                id=T.LongType(),
                name=T.StringType(),
                parent_id=T.LongType(),
                created_at=T.TimestampNTZType(),
            ),
            key=("name",),
            updates=("parent_id",),
            sticky=("parent_id",),
        ),
        Table(
            "products",
            _schema(
                id=T.LongType(),
                sku=T.StringType(),
                name=T.StringType(),
                category_id=T.LongType(),
                price=PRICE,
                created_at=T.TimestampNTZType(),
            ),
            key=("sku",),
            updates=("name", "category_id", "price"),
        ),
        Table(
            "customers",
            _schema(
                id=T.LongType(),
                name=T.StringType(),
                email=T.StringType(),
                phone=T.StringType(),
                created_at=T.TimestampNTZType(),
            ),
            key=("email",),
            updates=("name", "phone"),
        ),
        Table(
            "orders",
            _schema(
                id=T.LongType(),
                customer_id=T.LongType(),
                status=T.StringType(),
                total_amount=AMOUNT,
                ordered_at=T.TimestampNTZType(),
                created_at=T.TimestampNTZType(),
            ),
            # row-group statistics then serve both "one customer" and "date range"
            cluster_by=("customer_id", "ordered_at"),
        ),
        Table(
            "order_items",
            _schema(
                id=T.LongType(),
                order_id=T.LongType(),
                product_id=T.LongType(),
                quantity=T.IntegerType(),
                unit_price=PRICE,
            ),
        ),
        Table(
            "pipeline_runs",
            _schema(
                id=T.LongType(),
                source=T.StringType(),
                rows_ingested=T.LongType(),
                rows_failed=T.LongType(),
                error_log=T.StringType(),
                started_at=T.TimestampNTZType(),
                finished_at=T.TimestampNTZType(),
            ),
        ),
    )
}

# metrics of runs: one row per entity a load was given, kept apart from the tables
STEPS = Table(
    "_steps",
    _schema(
        run_id=T.StringType(),
        batch=T.StringType(),
        source=T.StringType(),
        entity=T.StringType(),
        status=T.StringType(),
        rows_ingested=T.LongType(),
        rows_failed=T.LongType(),
        rows_skipped=T.LongType(),
        chunks=T.LongType(),
        started_at=T.TimestampNTZType(),
        finished_at=T.TimestampNTZType(),
    ),
)

# (child table, foreign key, parent table), all referring to the parent's id
FOREIGN_KEYS = (
    ("categories", "parent_id", "categories"),
    ("products", "category_id", "categories"),
    ("orders", "customer_id", "customers"),
    ("order_items", "order_id", "orders"),
    ("order_items", "product_id", "products"),
)

# columns profiled after a load
PROFILE_COLUMNS = {
    "customers": ["name", "email", "phone"],
    "products": ["sku", "name", "price"],
    "orders": ["status", "total_amount", "ordered_at"],
    "categories": ["name"],
}
