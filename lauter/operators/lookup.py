"""Foreign-key lookups and referential checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lauter.operators.rules import ERRORS, POSITION, is_accepted

UNKNOWN_CUSTOMER = "Unknown customer email"
UNKNOWN_PRODUCT = "Unknown product sku"


def attach_id(df: DataFrame, key: Column, parent: DataFrame, parent_key: str, out: str) -> DataFrame:
    """Left-join ``parent.id`` as ``out`` on a text key; a miss gives NULL.

    No join hint: a small parent is broadcast on its measured size, a large one
    is shuffled, and adaptive execution splits the partitions of hot keys (the
    parent is unique on its key, so any split of the left side is safe). Rows
    without a key match nothing; they get throw-away keys so that they spread
    over all partitions instead of meeting in one.
    """
    nobody = F.concat(F.lit("\x01"), F.xxhash64(POSITION).cast("string"))
    ids = parent.select(F.col(parent_key).alias("_parent_key"), F.col("id").alias(out))
    keyed = df.withColumn("_key", F.coalesce(key, nobody))
    joined = keyed.join(ids, F.col("_key") == F.col("_parent_key"), "left")
    return joined.drop("_key", "_parent_key")


def resolve_customer(classified: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders get ``customer_id``; an accepted order of an unknown customer is rejected."""
    key = F.when(is_accepted(), F.col("customer_email"))
    joined = attach_id(classified, key, customers, "email", "customer_id")
    return _reject_miss(joined, "customer_id", UNKNOWN_CUSTOMER)


def resolve_category(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Products get ``category_id``, NULL when the category is unknown."""
    return attach_id(products, F.col("category"), categories, "name", "category_id")


def resolve_product(classified: DataFrame, products: DataFrame) -> DataFrame:
    """Order items get ``product_id``; an unknown SKU is rejected."""
    key = F.when(is_accepted(), F.col("product_sku"))
    joined = attach_id(classified, key, products, "sku", "product_id")
    return _reject_miss(joined, "product_id", UNKNOWN_PRODUCT)


def _reject_miss(joined: DataFrame, id_column: str, reason: str) -> DataFrame:
    miss = is_accepted() & F.col(id_column).isNull()
    return joined.withColumn(
        ERRORS, F.when(miss, F.lit(reason)).otherwise(F.col(ERRORS))
    )


def id_map(table: DataFrame, key: str) -> DataFrame:
    """``(key, id)`` projection of a parent table."""
    return table.select(key, "id")


def find_orphans(child: DataFrame, foreign_key: str, parent: DataFrame, parent_key: str = "id") -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent."""
    parents = parent.select(F.col(parent_key).alias("_parent_key"))
    present = child.where(F.col(foreign_key).isNotNull())
    return present.join(parents, F.col(foreign_key) == F.col("_parent_key"), "left_anti")


