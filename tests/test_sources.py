import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from hypothesis import given
from hypothesis import strategies as st

from lauter.plans.load import run_entity
from lauter.sources import flatten_pages, json_scan, parse_lines, read_csv, read_json, read_ndjson, read_parquet
from lauter.sources.json_records import line_records
from lauter.sources.json_scan import Malformed, members, reduced


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def rows(frame):
    return [tuple(r) for r in frame.drop("_pos").collect()]


def test_csv(spark, tmp_path):
    path = write(tmp_path / "a.csv", '﻿name,n\n"Ä, ""x""\ny", 01 \nshort\nlong,2,3\n')
    frame = read_csv(spark, path)
    assert frame.columns == ["name", "n", "_pos"]
    assert rows(frame) == [('Ä, "x"\ny', " 01 "), ("short", None), ("long", "2")]


def test_csv_variants(spark, tmp_path):
    assert rows(read_csv(spark, write(tmp_path / "h.csv", "a,b\n"))) == []
    assert rows(read_csv(spark, write(tmp_path / "p.csv", "a|b\n1|2\n"), delimiter="|")) == [("1", "2")]
    latin = write(tmp_path / "l.csv", "a\né\n", "latin-1")
    assert rows(read_csv(spark, latin, encoding="ISO-8859-1")) == [("é",)]


@pytest.mark.parametrize("multiline", [True, False])
def test_csv_is_the_same_at_every_split_size(spark, tmp_path, multiline):
    text = 'a,b\n"x ""q""",1\n  \n' + '"z\rw",3\n' + "y,2\n" * 3000
    if multiline:
        text += '"u\nv",4\n'
    path = write(tmp_path / "a.csv", text)
    limit = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(limit)
    try:
        read = {}
        for size in ("4096b", "128m"):
            spark.conf.set(limit, size)
            frame = read_csv(spark, path, multiline=multiline)
            read[size] = [(r.a, r.b) for r in frame.orderBy("_pos").collect()]
            if not multiline and size == "4096b":
                assert frame.rdd.getNumPartitions() > 1
    finally:
        spark.conf.set(limit, before)
    assert read["4096b"] == read["128m"]
    assert read["128m"][0] == ('x "q"', "1")
    if multiline:
        assert read["128m"][1][0].strip() == "" and read["128m"][-1] == ("u\nv", "4")
        assert len(read["128m"]) == 3004


def test_csv_files_of_another_header_fail(spark, tmp_path):
    write(tmp_path / "1.csv", "name,email\nAda,a@b.co\n")
    write(tmp_path / "2.csv", "email,name\nc@d.co,Cy\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path)).collect()


def test_missing_source_is_an_error(spark, tmp_path):
    for read in (read_csv, read_json, read_ndjson, read_parquet):
        with pytest.raises(AnalysisException):
            read(spark, str(tmp_path / "absent")).collect()


def test_json_documents(spark, tmp_path):
    array = write(tmp_path / "a.json", ' [{"k": 1}, 3, null, "x", [1], {"k": 2}] ')
    assert [json.loads(r[1]) for r in read_json(spark, array).collect()] == [{"k": 1}, {"k": 2}]
    single = write(tmp_path / "s.json", '{"k": [1, {"z": 2}]}')
    assert [json.loads(r[1]) for r in read_json(spark, single).collect()] == [{"k": [1, {"z": 2}]}]
    assert read_json(spark, write(tmp_path / "e.json", "[]")).count() == 0
    for bad in ("7", '[{"k": 1}', '[{"k": 1}] []', '{"k": 1} x', " "):
        with pytest.raises(Exception, match="JSON"):
            read_json(spark, write(tmp_path / "bad.json", bad)).collect()


def test_ndjson(spark, tmp_path):
    lines = ['{"k": 1}', "", "MALFORMED", "[1]", "7", '  {"k": 2}  ', '{"k": 3} x', '{"k": 4}, {"k": 5}']
    path = write(tmp_path / "a.ndjson", "\n".join(lines))
    assert [r[1] for r in read_ndjson(spark, path).collect()] == ['{"k": 1}', '{"k": 2}']
    latin = write(tmp_path / "l.ndjson", '{"k": "é"}\nBROKEN\n', "latin-1")
    assert [r[1] for r in read_ndjson(spark, latin, "ISO-8859-1").collect()] == ['{"k": "é"}']
    frame = spark.createDataFrame([(line,) for line in lines], "value string")
    problems = [r.problem for r in parse_lines(frame).collect() if r.problem]
    assert sorted(problems) == ["malformed_json"] * 3 + ["not_an_object"] * 2


def test_ndjson_loads_the_small_members_of_large_lines(spark):
    filler = "x" * (25 << 20)
    lines = [
        '{"k": "' + filler + '", "name": "Ada", "n": [1, {"z": "}"}]}',
        '{"name": "' + filler + '"',
        '["' + filler + '"]',
        '{"a":1},"end-of-record"',
        '{"a":1},"end-of-record"] x',
        '{"b": 2}',
    ]
    frame = spark.createDataFrame([(t, i) for i, t in enumerate(lines)], "value string, _pos int").repartition(3)
    found = {r["_pos"]: r for r in parse_lines(frame).select("_pos", "problem", F.to_json("record").alias("r")).collect()}
    assert [found[i]["problem"] for i in range(6)] == [
        "too_large", "malformed_json", "not_an_object", "malformed_json", "malformed_json", None,
    ]
    assert [json.loads(r["r"]) if (r := found[i])["r"] else None for i in range(6)] == [
        {"name": "Ada", "n": [1, {"z": "}"}]}, None, None, None, None, {"b": 2},
    ]
    records = line_records(frame).select("_pos", F.length("_record").alias("n")).orderBy("_pos").collect()
    assert [tuple(r) for r in records] == [(0, len(lines[0])), (5, 8)]
    assert line_records(frame, skipped=True).count() == 6


def test_large_lines_are_loaded_and_skipped_ones_kept(spark, warehouse, tmp_path):
    good = '{"name": "Ada", "email": "a@b.co", "notes": "' + "n" * (20 << 20) + '"}'
    unfit = '{"name": "Ben", "email": "' + "e" * (20 << 20) + '"}'
    path = write(tmp_path / "c.ndjson", "\n".join([good, unfit, "BROKEN", "[1]", '{"name": 7, "email": "c@b.co"}', ""]))
    result = run_entity(warehouse, read_ndjson(spark, path, skipped=True), "customers")
    assert (result.rows_ingested, result.rows_failed, result.rows_skipped) == (1, 2, 2)
    assert [tuple(r) for r in warehouse.table("customers").select("name", "email").collect()] == [("Ada", "a@b.co")]
    letters = spark.read.text(f"{result.dead_letter_path}/*").select(
        F.get_json_object("value", "$.reason").alias("reason"), F.length("value").alias("n")
    )
    found = sorted(tuple(r) for r in letters.collect())
    assert [r for r, _ in found] == [
        "customer validation: email: missing", "customer validation: name: not a string", "malformed_json", "not_an_object",
    ]
    assert found[0][1] > 20 << 20


def test_pages(spark):
    payloads = {
        '{"results": [{"k": 1}, 2, {"k": 3}], "next": "/p2"}': [("/p2", 1), ("/p2", 3)],
        '{"results": [], "next": null}': [],
        '{"data": [{"k": 1}]}': [],
        '[{"k": 4}, [5]]': [(None, 4)],
        '"scalar"': [],
        "broken": [],
    }
    frame = spark.createDataFrame([(p,) for p in payloads], "payload string")

    def found(**keys):
        flat = flatten_pages(frame, "payload", **keys)
        k = F.try_variant_get("record", "$.k", "int")
        return sorted(((r[0], r[1]) for r in flat.select("next_url", k).collect()), key=str)

    assert found() == sorted((p for ps in payloads.values() for p in ps), key=str)
    assert found(data_key="data") == sorted([(None, 1), (None, 4)], key=str)
    assert found(data_key=None) == [(None, 4)]
    assert {n for n, _ in found(next_key=None)} == {None}


def test_large_pages_are_read_record_by_record(spark):
    filler = "x" * (1 << 19)
    items = ",".join(f'{{"k": {i}, "f": "{filler}"}}' for i in range(25))
    huge = "y" * (25 << 20)
    payloads = [
        f'{{"results": [{items}, 7], "next": "/p2"}}', f" [{items}]", f'{{"data": [{items}]}}', f"[{items}], [1]",
        f'{{"results": [{{"k": 1}}, {{"f": "{huge}", "k": 2}}, {{"k": 3}}], "next": "/p3"}}', f'"{huge}"',
    ]
    frame = spark.createDataFrame(list(enumerate(payloads)), "page int, payload string").repartition(5)
    flat = flatten_pages(frame, "payload")
    k = F.try_variant_get("record", "$.k", "int").alias("k")
    found = [tuple(r) for r in flat.select("page", "next_url", k, F.length("_record")).collect()]
    size = len(filler) + len('{"k":0,"f":""}')
    assert sorted((p, n, i) for p, n, i, _ in found if p < 2) == [(0, "/p2", i) for i in range(25)] + [(1, None, i) for i in range(25)]
    assert all(size <= m <= size + 5 for p, _, _, m in found if p < 2)
    # a malformed page is one record without fields that keeps its text; a record with a
    # member that is too large keeps the others, and its page's other records are whole
    assert sorted(r for r in found if r[0] == 3) == [(3, None, None, len(payloads[3]))]
    last = sorted((r for r in found if r[0] == 4), key=lambda r: r[2])
    assert [r[1:3] for r in last] == [("/p3", 1), ("/p3", 2), ("/p3", 3)] and last[1][3] > len(huge)
    assert not [r for r in found if r[0] in (2, 5)]


JSONS = st.recursive(
    st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(max_size=5),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text(max_size=3), inner, max_size=3),
    max_leaves=10,
)


@given(JSONS, st.booleans(), st.sampled_from([None, 2]))
def test_members_of_any_value(value, ascii_only, indent):
    text = json.dumps(value, ensure_ascii=ascii_only, indent=indent)
    first, found = members(f" {text}\n")
    assert first == text[0]
    got = [(key, json.loads(f" {text}\n"[begin:end])) for key, begin, end in found]
    items = value.items() if isinstance(value, dict) else [(None, v) for v in value] if isinstance(value, list) else []
    assert got == list(items)


@given(st.text(st.sampled_from('{}[],:"\\ a1.-eutrnlf'), max_size=12))
def test_members_refuse_what_json_refuses(text):
    try:
        json.loads(text, parse_constant=lambda c: 1 / 0)
        right = True
    except (ValueError, ZeroDivisionError):
        right = False
    try:
        members(text)
        assert right
    except Malformed:
        assert not right


def test_reduced_objects(monkeypatch):
    monkeypatch.setattr(json_scan, "MEMBER_BYTES", 10)
    monkeypatch.setattr(json_scan, "SURE_BYTES", 200)
    small = '{"a":1,"b":[2,3],"a":4}'
    assert reduced(small) == ('{"a":4,"b":[2,3]}', None)
    assert reduced('{"long": "' + "x" * 50 + '", "b": true}') == ('{"b":true}', "too_large")
    text, problem = reduced("{" + ",".join(f'"k{i}":{10**i}' for i in range(8)) + "}")
    assert problem == "too_large" and json.loads(text) == {f"k{i}": 10**i for i in range(len(json.loads(text)))}
    assert reduced("[1]") == (None, "not_an_object") and reduced("{") == (None, "malformed_json")


def test_parquet_projection_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(10).selectExpr("id", "id * 2 AS score", "'x' AS name").write.parquet(path)
    frame = read_parquet(spark, path, ["name"])
    assert frame.columns == ["name", "_pos"]
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "score" not in plan.split("ReadSchema")[1]
    assert [r.id for r in read_parquet(spark, path).orderBy("_pos").collect()] != []
