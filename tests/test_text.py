import unicodedata

import pytest
from pyspark.sql import functions as F
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lauter.functions import text
from lauter.operators.cleaning import clean

QUICK = settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
AWKWARD = st.text(
    alphabet=st.one_of(
        st.characters(exclude_categories=["Cs"]),
        st.sampled_from(" \t\n\r\x00\x1f\x85\xa0\xadé́‍﻿ 각"),
    ),
    max_size=30,
)


def fixed(value):
    composed = unicodedata.normalize("NFC", value)
    return "".join(c for c in composed if c in "\t\n" or unicodedata.category(c)[0] != "C")


@QUICK
@given(values=st.lists(AWKWARD, min_size=1, max_size=60))
def test_encoding_and_strip_match_python(column, values):
    assert column(text.fix_encoding, values) == [fixed(v) for v in values]
    assert column(text.strip, values) == [v.strip() for v in values]
    assert column(text.tidy, values) == [fixed(v).strip() for v in values]


def test_examples(column):
    assert column(text.fix_encoding, ["é", "Alice\x00\x01\x02", "a\tb\nc", "🫠 ok", None]) == [
        "é",
        "Alice",
        "a\tb\nc",
        "🫠 ok",
        None,
    ]


def test_plain_ranges_never_need_normalisation():
    plain = {chr(c) for low, high in text.PLAIN_RANGES for c in range(low, high + 1)}
    for char in plain:
        assert unicodedata.normalize("NFC", char) == char
        assert unicodedata.combining(char) == 0
        if unicodedata.category(char)[0] == "C":
            assert ord(char) < 0xA0 or char == "\xad"
    for code in range(0x110000):
        parts = unicodedata.decomposition(chr(code)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            assert chr(int(parts[1], 16)) not in plain
    vowels_and_tails = {chr(c) for c in range(0x1161, 0x11C3)}
    assert not plain & vowels_and_tails


@pytest.mark.parametrize(
    "spelling", ["", "null", "NULL", "None", "n/a", "NA", "nil", "Undefined", "-", "--"]
)
def test_sentinels(column, spelling):
    assert column(text.nullify, [spelling]) == [None]


def test_other_values_are_no_sentinels(column):
    assert column(text.nullify, ["---", "nothing", "0", None]) == ["---", "nothing", "0", None]


def test_truncation_is_by_column(column):
    long = "ä" * 300
    assert column(lambda c: text.truncate(c, "name"), [long]) == ["ä" * 256]
    assert column(lambda c: text.truncate(c, "sku"), [long]) == ["ä" * 64]
    assert column(lambda c: text.truncate(c, "customer_email"), [long]) == [long]


def test_title_case(column):
    words = ["o'neil e-books", "ELECTRONICS", "home & garden 2nd", "été", "", None]
    expected = [None if w is None else w.title() for w in words]
    assert column(text.title_case, words) == expected


@QUICK
@given(rows=st.lists(st.tuples(AWKWARD, st.integers(0, 9)), min_size=1, max_size=30))
def test_clean_keeps_rows_and_other_types(spark, rows):
    frame = spark.createDataFrame([(a, n, n > 4) for a, n in rows], "name string, n int, b boolean")
    cleaned = clean(frame).collect()
    assert sorted((r.n, r.b) for r in cleaned) == sorted((n, n > 4) for _, n in rows)
    assert all(r.name is None or 0 < len(r.name) <= 256 for r in cleaned)


def test_long_texts_reach_python_few_at_a_time(spark):
    @F.pandas_udf("int")
    def together(values):
        return values.map(lambda _: len(values))

    texts = spark.range(0, 200, 1, 1).select(F.repeat(F.lit("x"), 100_000).alias("t"))
    assert texts.select(F.max(together("t"))).first()[0] < 60
