"""CSV and JSON documents cut into small ranges give what one task gives."""

import csv
import io
import json
import random

import pytest
from hypothesis import HealthCheck, example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lauter.plans import catalog
from lauter.plans.load import run_entity
from lauter.sources import read_csv, read_csv_split, read_json, read_json_split
from lauter.sources.split_scan import BAD, IN, OUT, CsvLines, JsonBraces

RANGES = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")


@pytest.fixture
def ranges(spark):
    """Set the size of a range in bytes."""
    before = {k: spark.conf.get(k) for k in RANGES}

    def of(size):
        for k in RANGES:
            spark.conf.set(k, str(size))

    yield of
    for k, v in before.items():
        spark.conf.set(k, v)


def rows(frame):
    found = frame.drop("_pos").collect()
    return sorted((tuple(r) for r in found), key=str)


def in_order(frame):
    return [tuple(r)[:-1] for r in frame.orderBy("_pos").collect()]


# -- CSV ------------------------------------------------------------------------


def table(seed, n, end="\r\n"):
    rng = random.Random(seed)
    values = ["plain", "", 'a "quoted" word', "two\nlines", "cr\rhere", "crlf\r\nhere", "x,y", "ü漢🙂", '"', "\n\n\n", " pad "]
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(["id", "a", "b"])
    for i in range(n):
        writer.writerow([i, rng.choice(values), rng.choice(values) * rng.randrange(4)])
    return out.getvalue()


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
@pytest.mark.parametrize("size", [7, 64, 1000])
def test_csv_as_one_task(spark, tmp_path, ranges, end, size):
    path = tmp_path / "t.csv"
    path.write_bytes(table(size, 60, end).encode())
    expected = in_order(read_csv(spark, str(path)))
    ranges(size)
    found = read_csv_split(spark, str(path))
    assert in_order(found) == expected
    assert len(expected) == 60 and found.columns == ["id", "a", "b", "_pos"]


def test_csv_is_read_by_many_tasks(spark, tmp_path, ranges):
    path = tmp_path / "t.csv"
    path.write_text(table(1, 4000, "\n"), newline="")
    ranges(4096)
    found = read_csv_split(spark, str(path))
    tasks = found.where("id % 7 = 0").select(F.spark_partition_id().alias("t")).distinct().count()
    assert tasks > 20
    assert rows(found) == rows(read_csv(spark, str(path)))


def test_a_task_takes_many_small_ranges(spark, tmp_path, ranges):
    path, document = tmp_path / "t.csv", tmp_path / "t.json"
    path.write_text(table(1, 4000, "\n"), newline="")
    document.write_text(json.dumps([{"n": n, "s": '}"'} for n in range(4000)]))
    expected = rows(read_csv(spark, str(path)))
    ranges(256)
    # as many tasks as the cores call for, and those of the shuffle
    most = 4 * spark.sparkContext.defaultParallelism + int(spark.conf.get("spark.sql.shuffle.partitions"))
    for found in (read_csv_split(spark, str(path)), read_json_split(spark, str(document))):
        assert found.select(F.spark_partition_id().alias("t")).distinct().count() <= most
        assert found.count() == 4000
    assert rows(read_csv_split(spark, str(path))) == expected


def test_csv_quoted_field_over_many_ranges(spark, tmp_path, ranges):
    path = tmp_path / "t.csv"
    long = "line, one\nline \"\"two\"\"\n" * 200
    path.write_text(f'a,b\n1,"{long}"\n2,x\n3,"{long}"\n4,y', newline="")
    expected = in_order(read_csv(spark, str(path)))
    ranges(50)
    assert in_order(read_csv_split(spark, str(path))) == expected
    assert [r[0] for r in expected] == ["1", "2", "3", "4"]


def test_csv_files_of_a_folder(spark, tmp_path, ranges):
    for name, text in (("a", "x;y\n1;2\n"), ("b", '﻿x;y\n"3\n";4\n\n5\n'), ("c", "X;y"), ("d", "x;y\n6;7;8\n")):
        (tmp_path / f"{name}.csv").write_text(text, newline="")
    expected = rows(read_csv(spark, str(tmp_path), delimiter=";"))
    ranges(4)
    found = read_csv_split(spark, str(tmp_path), delimiter=";")
    assert rows(found) == expected == [("1", "2"), ("3\n", "4"), ("5", None), ("6", "7")]
    assert in_order(found) == [("1", "2"), ("3\n", "4"), ("5", None), ("6", "7")]


def test_csv_encoding_and_header(spark, tmp_path, ranges):
    (tmp_path / "l.csv").write_bytes('näme,"b ""c"""\nÄÖ,"ü\nß"\n'.encode("latin-1"))
    ranges(3)
    found = read_csv_split(spark, str(tmp_path / "l.csv"), encoding="ISO-8859-1")
    assert found.columns[:2] == ["näme", 'b "c"'] and in_order(found) == [("ÄÖ", "ü\nß")]
    (tmp_path / "two").mkdir()
    (tmp_path / "two" / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "two" / "b.csv").write_text("y,x\n1,2\n")
    with pytest.raises(Exception, match="another header"):
        read_csv_split(spark, str(tmp_path / "two")).collect()


def test_csv_text_behind_a_closing_quote_fails(spark, tmp_path, ranges):
    (tmp_path / "bad.csv").write_text('a,b\n1,2\n"x"y,3\n')
    with pytest.raises(ValueError, match="behind a closing quote"):
        read_csv_split(spark, str(tmp_path / "bad.csv"))
    (tmp_path / "fine.csv").write_text('a,b\n5" pipe,3\n')
    ranges(3)
    assert in_order(read_csv_split(spark, str(tmp_path / "fine.csv"))) == [('5" pipe', "3")]


def test_csv_of_nothing(spark, tmp_path):
    (tmp_path / "h.csv").write_text("a,b\n")
    assert rows(read_csv_split(spark, str(tmp_path / "h.csv"))) == []
    (tmp_path / "o.csv").write_text("a\n\n1\n\n")
    assert rows(read_csv_split(spark, str(tmp_path / "o.csv"))) == [("1",)]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.lists(st.text(st.sampled_from('ab,"\n\r é'), max_size=6), min_size=2, max_size=2), min_size=1, max_size=12),
    st.sampled_from([5, 9, 33]),
)
@example([["", ""], ['"', "\n"]], 5)
def test_any_csv_as_one_task(spark, tmp_path_factory, ranges, records, size):
    path = tmp_path_factory.mktemp("csv") / "t.csv"
    with path.open("w", newline="") as file:
        writer = csv.writer(file, quoting=csv.QUOTE_ALL, lineterminator="\n")
        writer.writerows([["x", "y"], *records])
    ranges(1 << 27)
    expected = in_order(read_csv(spark, str(path)))
    ranges(size)
    assert in_order(read_csv_split(spark, str(path))) == expected


@pytest.mark.parametrize(
    ("line", "out", "inside"),
    [
        (b"a,b", OUT, IN), (b'"a",b', OUT, BAD), (b'a,"b', IN, BAD), (b'a",b', OUT, OUT), (b'"a""', IN, BAD),
        (b'""', OUT, IN), (b'"a"\r', OUT, BAD), (b'x"', OUT, OUT), (b'"a"b', BAD, BAD), (b"", OUT, IN), (b',""', OUT, IN),
    ],
)
def test_csv_states(line, out, inside):
    automaton = CsvLines(b",")
    assert automaton.step(line, OUT)[0] == out
    assert automaton.step(line, IN)[0] == inside


# -- JSON -----------------------------------------------------------------------

JSONS = st.recursive(
    st.none() | st.booleans() | st.integers(-99, 99) | st.text(st.sampled_from('a"\\{}[],:é\n'), max_size=6),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.sampled_from(["a", "}", '"', "\\"]), inner, max_size=3),
    max_leaves=12,
)


def records(frame):
    return [json.loads(r["_record"]) for r in frame.orderBy("_pos").collect()]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(JSONS, max_size=8) | st.dictionaries(st.text("ab", max_size=2), JSONS, max_size=3), st.sampled_from([3, 11, 50]), st.sampled_from([None, 1]))
@example([], 3, None)
@example([[{"a": 1}], {"b": [{}]}, 3], 3, None)
@example({}, 3, None)
def test_any_document_as_one_task(spark, tmp_path_factory, ranges, document, size, indent):
    path = tmp_path_factory.mktemp("json") / "d.json"
    path.write_text(json.dumps(document, ensure_ascii=False, indent=indent))
    ranges(size)
    found = records(read_json_split(spark, str(path)))
    items = document if isinstance(document, list) else [document]
    assert found == [i for i in items if isinstance(i, dict)]


def test_document_as_json_reader(spark, tmp_path, ranges):
    rng = random.Random(4)
    items = [{"i": i, "s": rng.choice(["}", "{", '"', "\\", "x" * 40, "]"]) * rng.randrange(9), "k": [{"z": {}}]} for i in range(300)]
    for name, values in (("a", items[:100]), ("b", items[100:]), ("c", [1, "two"])):
        (tmp_path / f"{name}.json").write_text(json.dumps(values) + "\n")
    (tmp_path / "d.json").write_text(' {"i": -1}\n')
    (tmp_path / "e.json").write_text("")
    expected = sorted(r["i"] for r in records(read_json(spark, str(tmp_path))))
    (tmp_path / "b.json").write_text("\ufeff" + json.dumps(items[100:]))  # a byte order mark is skipped
    ranges(97)
    found = read_json_split(spark, str(tmp_path))
    assert [r["i"] for r in records(found)] == [*range(300), -1]
    assert expected == [-1, *range(300)]
    assert found.select(F.spark_partition_id()).distinct().count() > 20


@pytest.mark.parametrize(
    "text",
    ["[1, {]", '[{"a": 1}', '[{"a": 1}}', '[{"a": 1} {"a": 2}]', '[{"a": 1},, {"a": 2}]', '[{"a": 1}] [{"a": 2}]',
     '{"a": 1} {"a": 2}', '{"a": 1', '"text"', "7", "[] x", '[{"a": 1}]]', '[{"a" 1}]', "  "],
)
def test_malformed_documents_fail(spark, tmp_path, ranges, text):
    (tmp_path / "d.json").write_text(text)
    with pytest.raises(Exception, match="malformed|expected|ends within"):
        read_json(spark, str(tmp_path / "d.json")).collect()
    ranges(5)
    with pytest.raises(Exception, match="malformed|expected|ends within"):
        read_json_split(spark, str(tmp_path / "d.json")).collect()


def test_json_pieces():
    automaton = JsonBraces()
    assert automaton.step(b'[{"a": "}', OUT) == (IN, 2)
    assert automaton.step(b'", "b": {', IN) == (OUT, 0)
    assert automaton.step(b"\\", IN) == (IN, 0)
    assert automaton.step(b'x\\" ]', IN) == (IN, 0)
    assert automaton.step(b"", OUT) == (OUT, -1)


def test_loads_from_ranges(spark, warehouse, tmp_path, ranges):
    (tmp_path / "c.csv").write_text('name,email,phone\n"Ada\nAbel",a@b.co,\nBen,b@b.co,\nAda II,A@b.co,\n')
    (tmp_path / "c.json").write_text('[{"name": "Cleo", "email": "c@b.co"}, {"name": 7, "email": "d@b.co"}, 3]')
    ranges(6)
    first = run_entity(warehouse, read_csv_split(spark, str(tmp_path / "c.csv")), "customers")
    assert (first.rows_ingested, first.rows_duplicate) == (2, 1)
    second = run_entity(warehouse, read_json_split(spark, str(tmp_path / "c.json")), "customers")
    assert (second.rows_ingested, second.rows_failed) == (1, 1)
    names = {r.email: r.name for r in warehouse.table("customers").collect()}
    assert names["b@b.co"] == "Ben" and names["c@b.co"] == "Cleo" and names["a@b.co"].startswith("Ada")


def test_events_make_more_documents_not_larger_ones(spark, monkeypatch):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
    monkeypatch.setattr(catalog, "DOCUMENT_EVENTS", events // 5 + 1)
    path = catalog._documents_of(spark, "/root/testdata/sf0.001", 2)
    assert len(spark.read.text(path).inputFiles()) == 5
    assert read_json_split(spark, path).count() == events
