"""Synthetic orders, products and customers.

Values are expressions over ``spark.range`` and a seed, so any number of rows is
generated in parallel and the same seed gives the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
STATUSES = ["pending", "completed", "shipped", "cancelled", "processing", "returned"]
STATUS_WEIGHTS = [0.35, 0.40, 0.15, 0.05, 0.03, 0.02]
FIRST_DAY, LAST_DAY = "2020-01-01", "2024-12-31"
BLANK_PHONE_RATE = 0.15
SKU_COUNT = 50_000
EMAIL_CYCLE = 1000
MAX_QUANTITY = 10
ORDER_PRICES, PRODUCT_PRICES = (99, 49_999), (99, 999_999)  # cents
# ----------------------------------------------------------------------------

CATEGORIES = ["Lamps", "Bicycles", "Tea", "Carpets", "Tools", "Instruments", "Tents"]
FIRST_NAMES = ["Ada", "Ben", "Chloe", "Dan", "Elif", "Finn", "Greta", "Hugo", "Ines", "Jonas"]
LAST_NAMES = ["Abel", "Berg", "Costa", "Dietz", "Evans", "Faber", "Gruber", "Hall"]
DOMAINS = ["example.com", "example.org", "example.net"]
PREFIXES = ["+43 1", "+61-2", "+81 3", "+358-9", "+56 2"]
ADJECTIVES = ["Plain", "Light", "Solid", "Quick", "Small", "Large"]
NOUNS = ["Ladder", "Teapot", "Hammock", "Lantern", "Saddle", "Compass"]


class _Dice:
    """Independent uniform draws per row: a hash of the row id, the seed and the draw's name."""

    def __init__(self, seed: int) -> None:
        self.seed = seed

    def below(self, name: str, limit: int) -> Column:
        return F.pmod(F.xxhash64(F.col("id"), F.lit(self.seed), F.lit(name)), F.lit(limit))

    def between(self, name: str, low: int, high: int) -> Column:
        return self.below(name, high - low + 1) + low

    def pick(self, name: str, values: Sequence[str]) -> Column:
        choices = F.array(*[F.lit(v) for v in values])
        return F.get(choices, self.below(name, len(values)).cast("int"))

    def share(self, name: str) -> Column:
        return self.below(name, 1_000_000) / 1_000_000


def _cents(amount: Column) -> Column:
    return (amount.cast("decimal(18,0)") * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(12,2)")


def _status(dice: _Dice) -> Column:
    drawn, reached, chosen = dice.share("status"), 0.0, None
    for status, weight in zip(STATUSES, STATUS_WEIGHTS, strict=True):
        reached += weight
        test = drawn < round(reached, 6)
        chosen = F.when(test, status) if chosen is None else chosen.when(test, status)
    return chosen


def _person(dice: _Dice) -> dict[str, Column]:
    first, last = dice.pick("first", FIRST_NAMES), dice.pick("last", LAST_NAMES)
    mailbox = F.concat_ws(".", F.lower(first), F.lower(last))
    number = (F.col("id") % EMAIL_CYCLE).cast("string")
    phone = F.concat_ws(
        "-", dice.pick("prefix", PREFIXES), dice.between("phone", 1_000_000, 9_999_999)
    )
    return {
        "name": F.concat_ws(" ", first, last),
        "email": F.concat(mailbox, number, F.lit("@"), dice.pick("domain", DOMAINS)),
        "phone": F.when(dice.share("blank") < BLANK_PHONE_RATE, "").otherwise(phone),
    }


def _sku(number: Column) -> Column:
    return F.concat(F.lit("SKU-"), F.lpad(number.cast("string"), 6, "0"))


def _rows(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(1, n + 1)


def generate_customers(spark: SparkSession, n: int, seed: int = 42) -> DataFrame:
    """``name, email, phone``; emails repeat, 15 % of the phones are blank."""
    person = _person(_Dice(seed))
    return _rows(spark, n).select(*[c.alias(name) for name, c in person.items()])


def generate_products(spark: SparkSession, n: int, seed: int = 42) -> DataFrame:
    """``sku, name, category, price`` with one row per SKU."""
    dice = _Dice(seed)
    return _rows(spark, n).select(
        _sku(F.col("id")).alias("sku"),
        F.concat_ws(
            " ", dice.pick("adjective", ADJECTIVES), dice.pick("noun", NOUNS), F.col("id")
        ).alias("name"),
        dice.pick("category", CATEGORIES).alias("category"),
        _cents(dice.between("price", *PRODUCT_PRICES)).cast("string").alias("price"),
    )


def generate_orders(spark: SparkSession, n: int, seed: int = 42) -> DataFrame:
    """The denormalised order file: ``total_amount`` is quantity times unit price."""
    dice = _Dice(seed)
    person = _person(dice)
    quantity = dice.between("quantity", 1, MAX_QUANTITY)
    cents = dice.between("price", *ORDER_PRICES)
    days = F.datediff(F.lit(LAST_DAY), F.lit(FIRST_DAY)) + 1
    day = F.date_add(
        F.lit(FIRST_DAY), F.pmod(F.xxhash64("id", F.lit(seed), F.lit("day")), days).cast("int")
    )
    return _rows(spark, n).select(
        F.col("id").cast("string").alias("order_id"),
        person["email"].alias("customer_email"),
        person["name"].alias("customer_name"),
        person["phone"].alias("customer_phone"),
        _status(dice).alias("status"),
        _cents(quantity * cents).cast("string").alias("total_amount"),
        F.concat(day.cast("string"), F.lit(" 00:00:00")).alias("ordered_at"),
        _sku(dice.between("sku", 1, SKU_COUNT)).alias("product_sku"),
        quantity.cast("string").alias("quantity"),
        _cents(cents).cast("string").alias("unit_price"),
        dice.pick("category", CATEGORIES).alias("category"),
    )
