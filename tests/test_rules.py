from datetime import datetime
from decimal import Decimal

import pytest

from lauter.functions import coerce
from lauter.operators.dedup import first_valid
from lauter.operators.rules import classify
from lauter.sources import parse_lines, spread


def judge(spark, entity, rows, **options):
    """Classify dicts of strings; every row has the same keys."""
    names = list(rows[0])
    frame = spark.createDataFrame(
        [(i, *[r[n] for n in names]) for i, r in enumerate(rows)],
        "i int, " + ", ".join(f"{n} string" for n in names),
    )
    found = classify(frame, entity, order_by=["i"], keep=["i"], **options).collect()
    return sorted(found, key=lambda r: r.i)


def errors(spark, entity, field, values, base):
    return [r["_errors"] for r in judge(spark, entity, [{**base, field: v} for v in values])]


CUSTOMER = {"name": "Ada Abel", "email": "ada@example.com", "phone": "+1-555-0101"}
PRODUCT = {"sku": "a-1", "name": "Thing", "category": "books", "price": "9.99"}
ORDER = {
    "customer_email": "Ada@Example.com",
    "status": " COMPLETED ",
    "total_amount": "10",
    "ordered_at": "2024-01-15",
}
ITEM = {"order_index": "1", "product_sku": " a-1 ", "quantity": "2", "unit_price": "1.005"}


def test_customer(spark):
    [row] = judge(spark, "customers", [{**CUSTOMER, "email": "ADA@Example.COM", "name": "  Ada "}])
    assert (row.name, row.email, row.phone, row["_errors"]) == ("Ada", "ada@example.com", "+1-555-0101", "")
    assert row["_record"] is None


def test_email(spark):
    good = ["a@b.co", "first.last+tag@mail.example.org", "x" * 64 + "@example.com"]
    bad = ["plain", "a@b", "@b.co", "a@.co", "a..b@c.de", "a@-b.co", "a b@c.de", "x" * 65 + "@example.com", "a@b.c"]
    assert errors(spark, "customers", "email", good, CUSTOMER) == [""] * len(good)
    assert errors(spark, "customers", "email", bad, CUSTOMER) == ["email: invalid"] * len(bad)
    assert errors(spark, "customers", "email", [None, "N/A"], CUSTOMER) == ["email: missing"] * 2


def test_phone(spark):
    rows = judge(
        spark,
        "customers",
        [{**CUSTOMER, "phone": p} for p in ["(020) 7946-0958", "null", None, " ", "abc", "123456", "1" * 21]],
    )
    assert [r.phone for r in rows][:4] == ["(020) 7946-0958", None, None, None]
    assert [r["_errors"] for r in rows] == [""] * 4 + ["phone: invalid"] * 3


def test_rejected_record_keeps_its_raw_form(spark):
    [row] = judge(spark, "customers", [{"name": " N/A ", "email": "bad", "phone": None}])
    assert row["_errors"] == "name: missing; email: invalid"
    assert row["_record"] == '{"i":0,"name":" N/A ","email":"bad","phone":null}'


def test_category(spark):
    rows = judge(spark, "categories", [{"name": n} for n in [" home & o'garden ", "", "x" * 129]])
    assert [r.name for r in rows][:1] == ["Home & O'Garden"]
    assert [r["_errors"] for r in rows] == ["", "name: missing", "name: longer than 128"]


def test_product_price(spark):
    cases = {
        "9.99": ("9.99", ""),
        "2.345": ("2.34", ""),
        "2.335": ("2.34", ""),
        "1e3": ("1000.00", ""),
        "1_000.5": ("1000.50", ""),
        "-0.001": ("0.00", ""),
        "-0.01": (None, "price: negative"),
        "free": (None, "price: invalid"),
        "NaN": (None, "price: invalid"),
        "Infinity": (None, "price: invalid"),
        "99999999.99": ("99999999.99", ""),
        "100000000": (None, "price: out_of_range"),
        "": (None, "price: missing"),
    }
    rows = judge(spark, "products", [{**PRODUCT, "price": p} for p in cases])
    for row, (price, reason) in zip(rows, cases.values(), strict=True):
        assert row["_errors"] == reason
        if not reason:
            assert row.price == Decimal(price)
    assert (rows[0].sku, rows[0].category) == ("A-1", "Books")


def test_order(spark):
    rows = judge(
        spark, "orders", [{**ORDER, "total_amount": a} for a in ["10", "0", "-0.001", "2.345", "x", "n/a"]]
    )
    assert (rows[0].customer_email, rows[0].status) == ("ada@example.com", "completed")
    assert [r["_errors"] for r in rows] == [
        "",
        "",
        "total_amount: negative",
        "",
        "total_amount: invalid",
        "total_amount: missing",
    ]
    assert rows[3].total_amount == Decimal("2.35")


def test_defaults_replace_only_absent_columns(spark):
    [row] = judge(spark, "orders", [{k: ORDER[k] for k in ("customer_email", "ordered_at")}])
    assert (row.status, row.total_amount, row["_errors"]) == ("pending", Decimal("0.00"), "")
    [row] = judge(spark, "orders", [{**ORDER, "status": "", "total_amount": "none"}])
    assert row["_errors"] == "status: missing; total_amount: missing"


def test_item(spark):
    assert errors(
        spark, "order_items", "quantity", ["2", "2.0", "+3", "1_0", "0", "2.5", "1e1", "2.", "9999999999"], ITEM
    ) == ["", "", "", "", "quantity: below 1", "quantity: invalid", "quantity: invalid", "quantity: invalid", "quantity: out_of_range"]
    [row] = judge(spark, "order_items", [ITEM])
    assert (row.order_index, row.product_sku, row.unit_price) == (1, "A-1", Decimal("1.00"))


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_timestamps(spark, column, zone):
    cases = {
        "2024-01-15 09:23:00": datetime(2024, 1, 15, 9, 23),
        "2024-1-5   9:3:0": datetime(2024, 1, 5, 9, 3),
        "2024-03-10T02:30:00": datetime(2024, 3, 10, 2, 30),
        "2024-01-15T10:00:00Z": datetime(2024, 1, 15, 10),
        "2024-01-15": datetime(2024, 1, 15),
        "15/01/2024": datetime(2024, 1, 15),
        "01/15/2024": datetime(2024, 1, 15),
        "03/04/2024": datetime(2024, 4, 3),
        "2024-02-30": None,
        "31/02/2024": None,
        "2024-01-15 24:00:00": None,
        "2024-01-15 10:00:60": None,
        "0000-01-01": None,
        "2024-01-15T10:00:00.5": None,
        "2024-01-15 10:00:00Z": None,
        "2024-01-15T10:00:00+01:00": None,
        "not-a-date": None,
    }
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert column(coerce.to_timestamp, list(cases)) == list(cases.values())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_json_types_matter(spark):
    lines = [
        '{"sku": "a", "name": "x", "price": 19.99}',
        '{"sku": 5, "name": "x", "price": "19.99"}',
        '{"sku": "a", "name": {"n": 1}, "price": true}',
        '{"sku": "a", "name": null, "price": 1e3, "category": 7}',
        '{"sku": "a", "price": null, "extra": 1}',
    ]
    frame = spark.createDataFrame(list(enumerate(lines)), "i int, value string")
    records = parse_lines(frame).withColumnRenamed("i", "_pos")
    found = sorted(classify(spread(records, "products"), "products").collect(), key=lambda r: r["_pos"][0])
    assert [r["_errors"] for r in found] == [
        "",
        "sku: not a string",
        "name: not a string; price: invalid",
        "name: missing; category: not a string",
        "name: missing; price: missing",
    ]
    assert found[0].price == Decimal("19.99")
    assert found[1]["_record"] == lines[1]


def test_json_defaults_are_per_record(spark):
    lines = [
        '{"customer_email": "a@b.co", "ordered_at": "2024-01-01"}',
        '{"customer_email": "a@b.co", "ordered_at": "2024-01-01", "status": null}',
    ]
    frame = spark.createDataFrame(list(enumerate(lines)), "i int, value string")
    records = spread(parse_lines(frame).withColumnRenamed("i", "_pos"), "orders")
    found = sorted(classify(records, "orders").collect(), key=lambda r: r["_pos"][0])
    assert [r["_errors"] for r in found] == ["", "status: missing"]
    assert found[0].status == "pending"


def test_typed_columns_pass(spark):
    frame = spark.sql(
        "SELECT 'a@b.co' customer_email, 'x' status, 12.5D total_amount, "
        "TIMESTAMP_NTZ'2024-01-15 09:23:00.25' ordered_at"
    )
    [row] = classify(frame, "orders").collect()
    assert row["_errors"] == ""
    assert row.ordered_at == datetime(2024, 1, 15, 9, 23, 0, 250000)
    assert row.total_amount == Decimal("12.50")


def test_first_valid_wins(spark):
    rows = [
        ("bad", "a@b.co", "x"),
        ("First", "A@b.co", None),
        ("Second", "a@B.co", None),
        ("Other", "c@d.de", None),
    ]
    frame = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)], "i int, name string, email string, phone string"
    ).repartition(8)
    kept = first_valid(classify(frame, "customers", order_by=["i"]), "customers")
    assert sorted((r.email, r.name) for r in kept.collect()) == [("a@b.co", "First"), ("c@d.de", "Other")]


def test_characters_of_an_atom(spark):
    allowed = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789!#$%&'*+/=?^_`{|}~-.")
    chars = [chr(c) for c in range(33, 127)] + ["ä", "İ"]
    found = errors(spark, "customers", "email", [f"a{c}b@example.com" for c in chars], CUSTOMER)
    assert [not e for e in found] == [c in allowed for c in chars]
