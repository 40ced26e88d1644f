"""Table store, landing zone and directory jobs."""

import json
import os

import pytest
from pyspark.sql import functions as F

from chronofold.plans.directory import CLEAN_SPECS, Wiki, build_clean, week_path
from chronofold.sources.landing import LandingZone, RecordNotFound, read_object, union_relaxed
from chronofold.sources.tables import TableSpec, TableStore, conform, struct, type_named

SPEC = TableSpec(struct({"id": "long"}, {"v": "integer", "p": "string"}), keys=("id",), partition_by=("p",))
FLAT = TableSpec(struct({"id": "long"}, {"v": "integer"}), keys=("id",))

HASHED = TableSpec(struct({"id": "long"}, {"v": "integer"}), keys=("id",), buckets=16)


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path), "t", f"s{abs(hash(str(tmp_path))) % 10**9}", {"parts": SPEC, "flat": FLAT, "hashed": HASHED})


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_moves_keys_and_drops_emptied_partitions(spark, store):
    store.write("parts", spark.createDataFrame([(1, 1, "a"), (2, 2, "a"), (3, 3, "b")], "id long, v int, p string"))
    change = spark.createDataFrame([(3, 9, "a"), (4, 4, "c")], "id long, v int, p string")
    for _ in range(2):
        store.write("parts", change, "upsert")
        assert rows(store.scan("parts")) == [(1, 1, "a"), (2, 2, "a"), (3, 9, "a"), (4, 4, "c")]


def test_upsert_flat_table_and_overwrite_from_itself(spark, store):
    store.write("flat", spark.createDataFrame([(1, 1), (2, 2)], "id long, v int"))
    store.write("flat", spark.createDataFrame([(2, 5), (3, 6)], "id long, v int"), "upsert")
    assert rows(store.scan("flat")) == [(1, 1), (2, 5), (3, 6)]
    store.write("flat", store.scan("flat", where=F.col("v") > 1), "overwrite")
    assert rows(store.scan("flat", ["id"], id=None)) == [(2,), (3,)]


def test_duplicate_keys_are_refused(spark, store):
    store.write("flat", spark.createDataFrame([(1, 1)], "id long, v int"))
    with pytest.raises(ValueError, match="duplicate keys"):
        store.write("flat", spark.createDataFrame([(2, 5), (2, 6)], "id long, v int"), "upsert")


def test_unknown_tables_modes_and_types(spark, store):
    with pytest.raises(KeyError):
        store.scan("other")
    with pytest.raises(ValueError):
        store.write("flat", spark.createDataFrame([(1, 1)], "id long, v int"), "replace")
    with pytest.raises(ValueError):
        type_named("uuid")
    assert type_named("list<list<long>>").simpleString() == "array<array<bigint>>"


def test_conform(spark):
    df = spark.createDataFrame([("7", None, "x")], "v string, id long, extra string")
    with pytest.raises(ValueError, match="missing"):
        conform(df.drop("v"), FLAT.schema)
    with pytest.raises(Exception, match="null in required column id"):
        conform(df, FLAT.schema).collect()
    good = conform(df.withColumn("id", F.lit(1)), FLAT.schema)
    assert good.columns == ["id", "v"] and good.first().v == 7


def test_landing_zone(spark, tmp_path):
    zone = LandingZone(spark, str(tmp_path), ["t"])
    df = spark.createDataFrame([(1, "x")], "id long, s string")
    assert zone.store("t", df, "parquet", year=2026, month=1)
    assert not zone.store("t", df.limit(0), "parquet", year=2026, month=2)
    assert zone.scan("t", year=2026).count() == 1 and zone.scan("t", year=2025).count() == 0
    assert rows(zone.landed("t", "year", "month")) == [("2026", "1")]
    zone.require("t", year=2026, month=1)
    with pytest.raises(RecordNotFound):
        zone.require("t", year=2026, month=2)
    with pytest.raises(KeyError):
        zone.table_path("other")
    with pytest.raises(ValueError):
        zone.store("t", df, "csv")
    with pytest.raises(ValueError):
        read_object(spark, "x.csv")


def test_relaxed_union_widens(spark):
    one, two = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(2.5, "x")], "a double, b string")
    assert rows(union_relaxed([one, two])) == [(1.0, None), (2.5, "x")]
    mixed = union_relaxed([one, spark.createDataFrame([("z",)], "a string")])
    assert mixed.schema["a"].dataType.simpleString() == "string"


def land(root, table, week, records):
    folder = week_path(root, table, week)
    os.makedirs(folder)
    with open(f"{folder}/{week.replace('-', '')}.json", "w") as f:
        json.dump(records, f, ensure_ascii=False)


def test_weekly_jobs(spark, tmp_path):
    root, week = str(tmp_path / "raw"), "2026-02-01"
    land(root, "players", week, [
        {"OverviewPage": "Añ B", "ID": "abc", "Name": "", "NameAlphabet": "abc", "Country": "ES", "IsRetired": "1", "Noise": 3},
        {"OverviewPage": "Añ B", "ID": "later", "Name": "Real"}, {"OverviewPage": "C", "ID": "C", "IsRetired": None}])
    land(root, "player_redirects", week, [{"AllName": "abc", "OverviewPage": "Añ B"}, {"AllName": "", "OverviewPage": "C"}])
    land(root, "teams", week, [{"PageName": "T1", "Name": "T1", "Short": "T1"}, {"PageName": "G2", "Name": None, "Short": "G2e"}])
    store = TableStore(spark, str(tmp_path / "clean"), "dir", "clean", CLEAN_SPECS)
    wiki = Wiki("w", "https://w/")
    figures = {r.person_id: r for r in build_clean(spark, root, store, "public_figures", week, wiki).collect()}
    assert figures["Añ B"].canonical_name == "abc" and figures["Añ B"].is_retired == "Yes"
    assert figures["Añ B"].source_url == "https://w/A%C3%B1_B" and figures["C"].is_retired == "No"
    teams = {r.team_id: r.canonical_name for r in build_clean(spark, root, store, "teams", week, wiki).collect()}
    assert teams == {"T1": "T1", "G2": "G2e"}
    aliases = rows(build_clean(spark, root, store, "entity_aliases", week, wiki).select("alias", "entity_id", "alias_type"))
    assert aliases == sorted([
        ("Añ B", "Añ B", "canonical"), ("abc", "Añ B", "other"), ("later", "Añ B", "ign"), ("Real", "Añ B", "real_name"),
        ("C", "C", "ign"), ("T1", "T1", "short"), ("G2", "G2", "canonical"), ("G2e", "G2", "short")])
    again = build_clean(spark, root, store, "public_figures", week, wiki)
    assert again.count() == 2


def files_of(spark, store, table):
    """Data files by partition as the catalog knows them."""
    return {r[0] for r in spark.table(store.full_name(table)).select(F.input_file_name()).distinct().collect()}


def test_upsert_of_a_hashed_table_rewrites_only_its_buckets(spark, store):
    store.write("hashed", spark.range(400).select("id", F.lit(1).alias("v")))
    before = files_of(spark, store, "hashed")
    change = spark.createDataFrame([(3, 9), (1000, 7)], "id long, v int")
    touched = {r[0] for r in change.select(HASHED.bucket_of(F.col("id"))).collect()}
    for _ in range(2):
        store.write("hashed", change, "upsert")
        assert store.scan("hashed").columns == ["id", "v"]
        assert rows(store.scan("hashed")) == sorted([(i, 9 if i == 3 else 1) for i in range(400)] + [(1000, 7)])
    bucket = lambda f: int(f.split("key_bucket=")[1].split("/")[0])
    after = files_of(spark, store, "hashed")
    assert {bucket(f) for f in before ^ after} == touched and {bucket(f) for f in before & after} == set(range(16)) - touched
    plan = store.scan("hashed", id=3)._jdf.queryExecution().executedPlan().toString()
    assert f"(key_bucket#" in plan and "PartitionFilters: [isnotnull(key_bucket" in plan
    assert rows(store.scan("hashed", id=3)) == [(3, 9)] and rows(store.scan("hashed", ["v"], id=1000)) == [(7,)]
    store.write("hashed", store.scan("hashed", where=F.col("v") > 1), "overwrite")
    assert rows(store.scan("hashed")) == [(3, 9), (1000, 7)]
    with pytest.raises(ValueError, match="keys"):
        TableSpec(FLAT.schema, buckets=4)


def test_overwrite_keeps_the_table_readable(spark, store, tmp_path):
    """A reader in a loop sees the table at every moment, and version folders do not pile up."""
    import threading

    make = lambda n: spark.createDataFrame([(i, n, p) for i, p in enumerate("abcd"[n % 3 :])], "id long, v int, p string")
    store.write("parts", make(0))
    store.write("parts", make(0), "overwrite")
    faults, seen, stop = [], set(), threading.Event()

    def read():
        while not stop.is_set():
            try:
                spark.catalog.refreshTable(store.full_name("parts"))
                seen.add(frozenset(r.v for r in store.scan("parts").collect()))
            except Exception as e:  # noqa: BLE001
                faults.append(str(e)[:300])

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for n in range(1, 5):
            store.write("parts", make(n), "overwrite")
            assert rows(store.scan("parts")) == rows(make(n).select("id", "v", "p"))
    finally:
        stop.set()
        reader.join()
    assert not [f for f in faults if "TABLE_OR_VIEW_NOT_FOUND" in f], faults
    assert seen and frozenset() not in seen
    folders = os.listdir(f"{tmp_path}/{store.namespace}/parts")
    assert len([f for f in folders if f.startswith("version-")]) <= 3
    assert not [t.name for t in spark.catalog.listTables(store.namespace) if t.name not in ("parts", "flat", "hashed")]


def test_partitions_are_found_without_listing_others(spark, tmp_path):
    zone = LandingZone(spark, str(tmp_path), ["t"])
    df = spark.createDataFrame([(1,)], "id long")
    for year in range(2000, 2012):
        for month in ("01", "02", "11"):
            zone.store("t", df.withColumn("id", F.lit(year * 100 + int(month)).cast("long")), year=year, month=month, kind="a b:c")
    schema = "id bigint, year int, month int, kind string"
    assert zone.layout("t") == ["year", "month", "kind"]
    zone.listed.clear()
    assert rows(zone.scan("t", schema, year=2003, month=1).select("id")) == [(200301,)]
    assert len(zone.listed) <= 6  # one folder of each level for the layout, then the years and the months of one year
    zone.listed.clear()
    assert rows(zone.scan("t", schema, kind="a b:c", year=2004).select("id")) == [(200401,), (200402,), (200411,)]
    assert all("/year=2004" in f or "year=" not in f for f in zone.listed if "year=2000" not in f)
    assert rows(zone.scan("t", schema, month=2).select("year")) == [(y,) for y in range(2000, 2012)]
    assert zone.scan("t", schema, year=1999).count() == 0 and zone.scan("t", year=2003, kind="x").count() == 0
    assert rows(zone.landed("t", "month", year=2005)) == [("01",), ("02",), ("11",)]
    assert zone.landed("t", "month", year=1).count() == 0 and zone.landed("t", "year").count() == 12
    assert zone.scan("t", schema).count() == 36


def test_streams_keep_events_without_time_or_id(spark, tmp_path):
    import datetime as dt

    from chronofold.suite import REGISTRY

    events = [(i if i % 5 else None, i % 3, dt.datetime(2024, 1, 1 + i % 20) if i % 4 else None, "k", "{}", 1.0) for i in range(40)]
    columns = "event_id long, user_id long, ts timestamp_ntz, event_type string, props string, value double"
    spark.createDataFrame(events, columns).repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    assert REGISTRY["stream_ingested"].run(spark, str(tmp_path)).count() == 40
    latest = REGISTRY["stream_upserted"].run(spark, str(tmp_path))
    assert latest.count() == 3
    assert REGISTRY["stream_deduplicated"].run(spark, str(tmp_path)).count() == 3


def test_snapshot_files_grow_in_number_and_keep_order(spark, tmp_path, monkeypatch):
    """No file holds more records than one task should read, and every file is one JSON array."""
    import json

    from chronofold.plans.directory import snapshot_schema, week_path
    from chronofold.sources.landing import read_snapshot
    from chronofold.suite import people

    monkeypatch.setattr(people, "SNAPSHOT_ROWS", 6000)
    made = spark.range(25_000).select(F.col("id").cast("string").alias("AllName"), F.lit("p").alias("OverviewPage"), F.col("id").alias("_ordinal"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1000)
    try:
        people.land_snapshot(None, str(tmp_path), "player_redirects", made, "2026-02-02")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    path = week_path(str(tmp_path), "player_redirects", "2026-02-02")
    sizes = [len(json.load(open(f"{path}/{f}"))) for f in os.listdir(path) if f.startswith("part-")]
    assert len(sizes) == 5 and sum(sizes) == 25_000 and max(sizes) < 9000
    back = read_snapshot(spark, path, snapshot_schema("player_redirects")).orderBy("_ordinal").collect()
    assert [r.AllName for r in back] == [str(i) for i in range(25_000)]
