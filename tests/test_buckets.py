"""Keyed tables in hash buckets: what a load touches, and loads at the same time."""

import threading
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lauter.plans.load import run_entity
from lauter.sinks import Warehouse, paths
from lauter.sinks import buckets as module
from lauter.sinks.buckets import BucketedTable, Version


@pytest.fixture(autouse=True)
def plain_sizes(monkeypatch):
    monkeypatch.setattr(module, "SPREAD", 1)


@pytest.fixture
def small(spark, tmp_path):
    """A warehouse whose tables have a bucket for every ten rows."""
    return Warehouse(spark, str(tmp_path / "w"), rows_per_bucket=10).create()


def people(spark, names, start=1, phone=None):
    rows = [(start + i, f"N{n}", f"{n}@b.co", phone) for i, n in enumerate(names)]
    return spark.createDataFrame(rows, "id bigint, name string, email string, phone string")


def emails(warehouse):
    rows = warehouse.table("customers").collect()
    assert len({r.email for r in rows}) == len(rows) and len({r.id for r in rows}) == len(rows)
    return {r.email.partition("@")[0]: r for r in rows}


def files(warehouse):
    """The data files of every bucket of the newest version."""
    table = warehouse.keyed("customers")
    return {
        bucket: sorted(p.name for p in Path(table.root, folder).glob("*.parquet"))
        for bucket, folder in table.latest().folders.items()
    }


def test_a_load_writes_only_the_buckets_it_touches(spark, small):
    small.upsert("customers", people(spark, range(100)))
    before = files(small)
    assert len(before) == 16 and all(len(f) == 1 for f in before.values())
    assert small.upsert("customers", people(spark, [7, 8], start=500, phone="+1")) == 2
    after = files(small)
    changed = {b for b in before if before[b] != after[b]}
    assert 1 <= len(changed) <= 2
    found = emails(small)
    assert len(found) == 100 and (found["7"].id, found["7"].phone) == (8, "+1") and found["9"].phone is None


def test_a_load_reads_only_the_buckets_it_touches(spark, small):
    small.upsert("customers", people(spark, range(100)))
    table = small.keyed("customers")
    version = table.latest()
    rows = people(spark, [7], start=500)
    touched = table._touched(rows, version.buckets)
    assert len(table.read(version, touched).inputFiles()) == len(touched) == 1
    assert table.read(version, []) is None


def test_buckets_double_with_the_table(spark, small):
    sizes = []
    for start in range(0, 120, 15):
        small.upsert("customers", people(spark, range(start, start + 15), start=start + 1))
        version = small.keyed("customers").latest()
        assert version.rows == start + 15 == small.table("customers").count()
        sizes.append(version.buckets)
    assert sizes == sorted(sizes) and sizes[0] == 2 and sizes[-1] == 8
    assert set(emails(small)) == {str(i) for i in range(120)}


class Interrupted(BucketedTable):
    """Lets another load commit after this one has written its buckets."""

    def __init__(self, *args, other=()):
        super().__init__(*args)
        self.others = list(other)

    def _merge(self, *args):
        result = super()._merge(*args)
        if self.others:
            self.others.pop(0)()
        return result


def interrupted(warehouse, *others):
    table = warehouse.keyed("customers")
    return Interrupted(table.spark, table.root, table.table, table.rows_per_bucket, other=others)


def test_overlapping_loads_keep_all_rows(spark, small):
    """Both loads read version 1; keys overlap, and each also has keys of its own."""
    small.upsert("customers", people(spark, range(40)))
    first = people(spark, [*range(30, 45), "x"], start=100, phone="first")
    other = people(spark, [*range(35, 50), "y"], start=200, phone="other")
    table = interrupted(small, lambda: small.upsert("customers", other))
    assert table.upsert(small._stored(table.table, first)) == 16
    found = emails(small)
    assert set(found) == {*map(str, range(50)), "x", "y"}
    phones = {name: found[name].phone for name in ("31", "36", "44", "48", "x", "y", "2")}
    # the load that commits last wins where both have a key
    assert phones == {"31": "first", "36": "first", "44": "first", "48": "other", "x": "first", "y": "other", "2": None}
    assert found["44"].id == 209 and found["36"].id == 37


def test_disjoint_buckets_are_not_written_again(spark, small):
    small.upsert("customers", people(spark, range(100)))
    table = small.keyed("customers")
    buckets = table.latest().buckets
    place = {
        r.email.partition("@")[0]: r.b
        for r in small.table("customers").select("email", table.bucket(buckets).alias("b")).collect()
    }
    mine = "0"
    theirs = next(n for n in place if place[n] != place[mine])
    merges = []
    late = interrupted(small, lambda: small.upsert("customers", people(spark, [theirs], start=500, phone="theirs")))
    plain_merge = late._merge
    late._merge = lambda *args: merges.append(1) or plain_merge(*args)
    late.upsert(small._stored(table.table, people(spark, [mine], start=600, phone="mine")))
    found = emails(small)
    assert (found[mine].phone, found[theirs].phone, len(found), len(merges)) == ("mine", "theirs", 100, 1)


def test_first_loads_at_the_same_time(spark, small):
    other = people(spark, range(20, 60), start=100)
    table = interrupted(small, lambda: small.upsert("customers", other))
    assert table.upsert(small._stored(table.table, people(spark, range(30)))) == 30
    assert set(emails(small)) == {str(i) for i in range(60)}


def test_table_grows_under_a_waiting_load(spark, small):
    small.upsert("customers", people(spark, range(10)))
    table = interrupted(small, lambda: small.upsert("customers", people(spark, range(5, 90), start=100)))
    table.upsert(small._stored(table.table, people(spark, range(8, 12), start=300, phone="late")))
    found = emails(small)
    assert set(found) == {str(i) for i in range(90)} and found["11"].phone == "late" and found["11"].id == 106


def test_threads(spark, small):
    """Real threads, through the whole load: no row and no id is lost or doubled."""
    errors, gate = [], threading.Barrier(4)

    def load(i):
        rows = [(f"P{n}", f"t{n}@b.co", "") for n in range(i * 10, i * 10 + 25)]
        frame = spark.createDataFrame(rows, "name string, email string, phone string")
        gate.wait()
        try:
            run_entity(small, frame, "customers", order_by=["email"])
        except Exception as error:
            errors.append(error)

    threads = [threading.Thread(target=load, args=(i,)) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    assert set(emails(small)) == {f"t{n}" for n in range(55)}
    assert small.table("pipeline_runs").select("id").distinct().count() == 4


def test_a_name_is_claimed_once(spark, tmp_path):
    path = str(tmp_path / "names")
    paths.make(spark, path)
    won, gate = [], threading.Barrier(8)

    def claim(i):
        gate.wait()
        if paths.publish(spark, f"{path}/1", f"text {i}"):
            won.append(i)

    threads = [threading.Thread(target=claim, args=(i,)) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and paths.read(spark, f"{path}/1") == f"text {won[0]}"
    assert paths.names(spark, path) == ["1"] and paths.read(spark, f"{path}/2") is None


def test_old_files_go_and_failed_loads_are_found(spark, small):
    for i in range(5):
        small.upsert("customers", people(spark, range(30), start=100 * i, phone=str(i)))
    table = small.keyed("customers")
    commits = [n for n in paths.names(spark, table.root) if not n.startswith("_")]
    assert len(commits) == module.VERSIONS_KEPT

    def boom(*_):
        raise RuntimeError("lost")

    broken = interrupted(small)
    broken._claim = boom
    with pytest.raises(RuntimeError):
        broken.upsert(small._stored(table.table, people(spark, [1], start=900)))
    assert len(small.table("customers").collect()) == 30
    lost = table.vacuum()
    assert sorted(n.partition("/")[0] == "_incoming" for n in lost) == [False, True] and table.vacuum() == []
    assert {r.phone for r in small.table("customers").collect()} == {"4"}


def test_small_tables_are_spread(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(module, "SPREAD", 64)
    table = Warehouse(spark, str(tmp_path)).keyed("customers")
    assert [table._wanted(Version(), n) for n in (1, 30_000, 400_000, 64_000_000, 10**9)] == [1, 2, 8, 64, 1024]
    assert table._wanted(Version(1, 8, 500_000), 500_000) == 8 and table._wanted(Version(1, 8, 500_000), 10**7) == 32


def test_versions_are_text(spark, small):
    version = Version(3, 2, 11, {0: "a/_bucket=0", 1: "b/_bucket=1"})
    assert Version.parse(3, version.text()) == version
    assert small.keyed("customers").latest() == Version()
    assert small.table("customers").count() == 0


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.integers(0, 40), unique=True, min_size=1, max_size=30), min_size=1, max_size=4))
def test_any_loads_by_hand(spark, tmp_path_factory, loads):
    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("w")), rows_per_bucket=6).create()
    expected = {}
    for turn, names in enumerate(loads):
        warehouse.upsert("customers", people(spark, names, start=1000 * turn, phone=str(turn)))
        for i, n in enumerate(names):
            expected[str(n)] = (expected.get(str(n), (1000 * turn + i,))[0], str(turn))
    assert {k: (r.id, r.phone) for k, r in emails(warehouse).items()} == expected


def test_upsert_is_one_shuffle_of_the_touched_rows(spark, small):
    small.upsert("customers", people(spark, range(100)))
    table = small.keyed("customers")
    version = table.latest()
    old = table.read(version, [0, 1]).withColumn("_bucket", table.bucket(version.buckets))
    new = small._stored(table.table, people(spark, [7], start=500)).withColumn("_bucket", table.bucket(version.buckets))
    merged = module.merge_rows(old, new, ["email"], ["name", "phone"], within="_bucket", tasks=2)
    text = merged._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "Join" not in text
    assert merged.select(F.count("*")).first()[0] >= 1
