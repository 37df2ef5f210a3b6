"""Ledgers, buckets, groups, observations, statistics, long tickets and matrices of stored tables."""

import uuid
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from keyframe.model import KeyModel
from keyframe.operators import constraints, matrix, tickets
from keyframe.operators.constraints import ConstraintViolation
from keyframe.operators.keys import UnmatchedValues
from keyframe.plans import ledger, read, statistics, write
from keyframe.plans.ledger import keep_ledger, ledger_ticket
from keyframe.plans.write import compress_table, filter_copy, upsert
from keyframe.sources.snapshots import read_snapshot, release_snapshot
from keyframe.sources.storage import scratch_dir
from keyframe.sources.tables import read_table
from keyframe.sources.warehouse import Warehouse
from tests.frames import VERSIONED, dims, rows, settings, versioned_model

LAYOUTS = [{}, {"partition_by": {"Fact": ["Country"]}}, {"bucket_by": {"Fact": 8}}]
READABLE = "ValidFromVersion string, ValidToVersion string, Country string, Year int, val double"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def new_store(spark, tmp_path, **options):
    store = Warehouse(spark, f"store_{uuid.uuid4().hex[:8]}", str(tmp_path / uuid.uuid4().hex))
    store.upload_dimensions(versioned_model(spark), dims(spark), **options)
    return store


def facts(spark, *given):
    return spark.createDataFrame(list(given), READABLE)


STEPS = [
    [("v1", "v1", "NZL", 1990, 1.0), ("v1", "v1", "PER", 1990, 2.0), ("v1", "v1", "KEN", 1991, None)],
    [("v2", "v2", "NZL", 1990, 1.0), ("v2", "v2", "PER", 1990, 2.5), ("v2", "v2", "KEN", 1991, None)],
    [("v2", "v2", "PER", 1990, 2.0), ("v1", "v1", "NZL", 1990, 7.0), ("v3", "v3", "NZL", 1990, 1.0)],
]


# Ledgers


@pytest.mark.parametrize(
    "layout,compress", [(n, c) for n in range(3) for c in (False, "groups")] + [(1, "touched"), (2, True)]
)
def test_ledgers_follow_upserts(spark, tmp_path, layout, compress):
    store, plain = new_store(spark, tmp_path, **LAYOUTS[layout]), new_store(spark, tmp_path)
    keep_ledger(store, "Fact", additional=["Year"], algorithm="md5")
    for step in STEPS:
        upsert(store, facts(spark, *step), "Fact", in_place=True, compress=compress)
        upsert(plain, facts(spark, *step), "Fact", in_place=True, compress=bool(compress))
        kept = store.ledger("Fact")["kept"]
        fresh = tickets.hash_groups(store["Fact"], "Fact", kept, algorithm="md5")
        assert rows(ledger_ticket(store, "Fact", decode=False)) == rows(fresh)
        # All ways to write give the same table.
        assert rows(store["Fact"].select(*plain["Fact"].columns)) == rows(plain["Fact"])
    assert {r["Country"] for r in ledger_ticket(store, "Fact").collect()} == {"NZL", "PER", "KEN"}


def test_a_ledger_ticket_does_not_read_the_table(spark, tmp_path):
    store = new_store(spark, tmp_path)
    upsert(store, facts(spark, *STEPS[0]), "Fact", in_place=True)
    keep_ledger(store, "Fact")
    scans = set(ledger_ticket(store, "Fact", decode=False).inputFiles())
    assert scans and all("/ledger-" in f for f in scans)
    assert not scans & set(store["Fact"].inputFiles())


def test_other_writes_make_a_ledger_invalid(spark, tmp_path):
    store = new_store(spark, tmp_path)
    with pytest.raises(ValueError, match="no valid ledger"):
        ledger_ticket(store, "Fact")
    keep_ledger(store, "Fact")
    store.replace("Fact", spark.createDataFrame([(1, 1, 1, 1990, 1.0)], VERSIONED))
    assert store.ledger("Fact") is None
    keep_ledger(store, "Fact")
    store.append("Fact", spark.createDataFrame([(1, 1, 2, 1990, 1.0)], VERSIONED))
    assert store.ledger("Fact") is None
    keep_ledger(store, "Fact")
    # A write that fails leaves the table as it was, and the ledger right.
    with pytest.raises(UnmatchedValues):
        upsert(store, facts(spark, ("v1", "v1", "XXX", 1990, 1.0)), "Fact", in_place=True)
    assert rows(ledger_ticket(store, "Fact", decode=False)) == rows(tickets.hash_groups(store["Fact"], "Fact", ["Country", "Year"]))


def test_ledgers_of_empty_tables_and_of_one_group(spark, tmp_path):
    store = new_store(spark, tmp_path)
    keep_ledger(store, "Fact", usual=None)
    assert rows(ledger_ticket(store, "Fact")) == []
    upsert(store, facts(spark, *STEPS[0]), "Fact", in_place=True)
    assert rows(ledger_ticket(store, "Fact")) == rows(tickets.hash_groups(store["Fact"], "Fact", []))
    for n in range(4):
        upsert(store, facts(spark, ("v1", "v1", "NZL", 2000 + n, 1.0)), "Fact", in_place=True)
    folders = [p for p in Path(store.root, "Fact").iterdir() if p.name.startswith("ledger-")]
    assert len(folders) == 2


@pytest.mark.parametrize("layout", range(3))
def test_empty_upserts_change_nothing(spark, tmp_path, layout):
    store = new_store(spark, tmp_path, **LAYOUTS[layout])
    keep_ledger(store, "Fact")
    for compress, given in ((False, ()), ("groups", ()), (False, STEPS[0][:1]), (False, ())):
        written = upsert(store, facts(spark, *given), "Fact", in_place=True, compress=compress)
        assert written.ticket.count() == len(given)
    assert store["Fact"].count() == ledger_ticket(store, "Fact").count() == 1


def test_ledgers_follow_copies_and_compression(spark, tmp_path):
    model = versioned_model(spark)
    model = KeyModel({**model.structs, "Copy": model.structs["Fact"]}, {**model.primary_keys, "Copy": model.primary_keys["Fact"]}, model.foreign_keys)
    store = Warehouse(spark, f"store_{uuid.uuid4().hex[:8]}", str(tmp_path / "s"))
    store.upload_dimensions(model, dims(spark))
    for step in STEPS:
        upsert(store, facts(spark, *step), "Fact", in_place=True)
    keep_ledger(store, "Copy")
    for member, empty in (("NZL", True), ("PER", False), ("KEN", False)):
        filter_copy(store, "Fact", "Copy", members=[member], empty_dest=empty, in_place=True)
        assert rows(ledger_ticket(store, "Copy", decode=False)) == rows(tickets.hash_groups(store["Copy"], "Copy", ["Country", "Year"]))
    compress_table(store, "Copy")
    assert rows(ledger_ticket(store, "Copy", decode=False)) == rows(tickets.hash_groups(store["Copy"], "Copy", ["Country", "Year"]))


# Buckets


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    store = new_store(spark, tmp_path, bucket_by={"Fact": 8})
    many = [("v1", "v1", c, y, float(y)) for c in ("NZL", "PER", "KEN") for y in range(1900, 1960)]
    upsert(store, facts(spark, *many), "Fact", in_place=True)
    folder = Path(store.location("Fact").removeprefix("file:"))
    before = {p.name for p in folder.glob("*.parquet")}
    upsert(store, facts(spark, ("v1", "v1", "NZL", 1901, -1.0), ("v1", "v1", "NZL", 2001, 5.0)), "Fact", in_place=True)
    assert Path(store.location("Fact").removeprefix("file:")) == folder
    after = {p.name for p in folder.glob("*.parquet")}
    touched = store.bucket_ids("Fact", store["Fact"].filter("Country = 1 AND Year IN (1901, 2001)"))
    of = lambda names: {int(n.rsplit("_", 1)[1].split(".")[0]) for n in names}
    assert of(before - after) | of(after - before) == set(touched) and len(touched) <= 2 < len(before)
    assert before & after == {n for n in before if of([n]).isdisjoint(touched)}
    expected = sorted((1, 1, 1 + ("NZL", "PER", "KEN").index(c), y, v) for _, _, c, y, v in many if (c, y) != ("NZL", 1901))
    assert sorted(map(tuple, store["Fact"].collect())) == sorted([*expected, (1, 1, 1, 1901, -1.0), (1, 1, 1, 2001, 5.0)])
    # Every row is in the bucket that Spark looks for it in.
    assert store["Fact"].filter("Country = 1 AND Year = 2001").count() == 1
    assert not [p for p in Path(store.root, "Fact").iterdir() if p.name.startswith("data-") and p != folder and any(p.glob("*.parquet"))]


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_bucketed_merges_do_not_move_the_table(spark, tmp_path, broadcast):
    from keyframe.operators.upsert import plan_merge

    store = new_store(spark, tmp_path, bucket_by={"Fact": 4})
    store.replace("Fact", spark.createDataFrame([(1, 1, 1, y, 1.0) for y in range(100)], VERSIONED))
    given = spark.createDataFrame([(1, 1, 1, y, 2.0) for y in range(50)], VERSIONED)
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": broadcast}):
        merge = plan_merge(store.in_buckets("Fact", [0, 1]), given, store.primary_key("Fact"), check_source=False)
        text = plan(merge.kept)
    below = text.split("LeftAnti")[1]
    target = below.split("BuildRight")[-1] if "BuildRight" in below else below
    # The first child is the table: between the join and its scan nothing is exchanged.
    assert "Exchange" not in target.split("FileScan")[0].replace("BroadcastExchange", "").replace("ENSURE", "") or "SortMergeJoin" in text
    if broadcast == "-1":
        assert text.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in text


def test_only_files_of_the_buckets_are_read(spark, tmp_path):
    store = new_store(spark, tmp_path, bucket_by={"Fact": 4})
    store.replace("Fact", spark.createDataFrame([(1, 1, 1, y, 1.0) for y in range(100)], VERSIONED))
    frame = store.in_buckets("Fact", [2])
    execution = frame._jdf.queryExecution()
    frame.collect()
    names = {r[0] for r in frame.select("_metadata.file_name").distinct().collect()}
    assert {n.rsplit("_", 1)[1][:5] for n in names} == {"00002"}
    assert frame.count() == sum(b == 2 for b in [r[0] for r in store["Fact"].select(F.pmod(F.hash(*store.primary_key("Fact")), F.lit(4))).collect()])
    assert "file_name" in execution.executedPlan().toString()


def test_a_broken_off_exchange_is_completed(spark, tmp_path, monkeypatch):
    store = new_store(spark, tmp_path, bucket_by={"Fact": 4})
    upsert(store, facts(spark, *STEPS[0]), "Fact", in_place=True)
    from keyframe.sources import warehouse

    with monkeypatch.context() as broken:
        broken.setattr(warehouse, "move", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            upsert(store, facts(spark, *STEPS[1]), "Fact", in_place=True)
    store.finish_swap("Fact")
    assert store["Fact"].count() == 6
    upsert(store, facts(spark, *STEPS[2]), "Fact", in_place=True)
    assert store["Fact"].count() == 7


def test_buckets_need_a_key_and_no_partitions(spark, tmp_path):
    with pytest.raises(ValueError, match="Buckets need"):
        new_store(spark, tmp_path, bucket_by={"Fact": 4}, partition_by={"Fact": ["Country"]})


# Groups


def test_group_compression_leaves_other_groups_alone(spark, tmp_path):
    """Two mergeable rows of an untouched group stay apart: nobody looks at them."""
    store = new_store(spark, tmp_path)
    store.replace("Fact", spark.createDataFrame([(1, 1, 1, 1990, 1.0), (2, 2, 1, 1990, 1.0), (1, 1, 2, 1990, 5.0), (1, 1, 3, 1990, None)], VERSIONED))
    written = upsert(store, facts(spark, ("v2", "v2", "PER", 1990, 5.0), ("v2", "v2", "KEN", 1990, None)), "Fact", in_place=True, compress="groups")
    assert rows(written.table) == [(1, 1, 1, 1990, 1.0), (1, 2, 2, 1990, 5.0), (1, 2, 3, 1990, None), (2, 2, 1, 1990, 1.0)]
    preview = upsert(store, facts(spark, ("v3", "v3", "PER", 1990, 5.0)), "Fact", compress="groups").table
    assert (1, 3, 2, 1990, 5.0) in rows(preview) and preview.count() == 4
    with pytest.raises(ValueError, match="compress must be"):
        upsert(store, facts(spark), "Fact", compress="some")


# Observed constraints


def count_jobs(spark, action):
    tracker, group = spark.sparkContext.statusTracker(), uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        action()
    finally:
        spark.sparkContext.setJobGroup("", "")
    return len(tracker.getJobIdsForGroup(group))


def test_a_sound_upsert_has_no_job_for_foreign_keys(spark, tmp_path, monkeypatch):
    store = new_store(spark, tmp_path)
    ran = []
    real = write.require_foreign_keys
    monkeypatch.setattr(write, "require_foreign_keys", lambda *a, **k: (ran.append(1), real(*a, **k)))
    sound = count_jobs(spark, lambda: upsert(store, facts(spark, *STEPS[0]), "Fact", in_place=True))
    assert not ran
    monkeypatch.setattr(write, "observe_foreign_keys", lambda df, *a, **k: (df, type("S", (), {"get": {"x": 1}})()))
    checked = count_jobs(spark, lambda: upsert(store, facts(spark, *STEPS[0]), "Fact", in_place=True))
    assert ran and checked > sound


def test_bad_keys_are_still_refused(spark, tmp_path):
    store = new_store(spark, tmp_path)
    with pytest.raises(UnmatchedValues, match="'XXX' is not in 'Country'"):
        upsert(store, facts(spark, ("v1", "v1", "XXX", 1990, 1.0)), "Fact", in_place=True)
    with pytest.raises(ConstraintViolation, match="orphan: Country: '9'"):
        upsert(store, spark.createDataFrame([(1, 1, 9, 1990, 1.0)], VERSIONED), "Fact", in_place=True)
    with pytest.raises(ConstraintViolation, match="null: Country"):
        upsert(store, spark.createDataFrame([(1, 1, None, 1990, 1.0)], VERSIONED), "Fact", in_place=True)
    assert store["Fact"].count() == 0


def test_observed_counts(spark):
    given = [(1, 1, 1, 1990, 1.0), (1, 99, 9, 1990, 1.0), (2, 2, None, 1990, 1.0), (2, 2, 9, 1990, 1.0)]
    frame = spark.createDataFrame(given, VERSIONED)
    for not_null, bad in ((True, 3), (False, 2)):
        watched, seen = constraints.observe_foreign_keys(frame, "Fact", versioned_model(spark), dims(spark), not_null=not_null)
        assert rows(watched) == rows(frame)
        assert seen.get == {"ValidFromVersion": 0, "ValidToVersion": 1, "Country": bad}
    model = KeyModel({"Fact": frame.schema}, {}, ())
    assert constraints.observe_foreign_keys(frame, "Fact", model, {})[1] is None


def test_dimensions_are_checked_in_one_job(spark, tmp_path):
    repeated = {**dims(spark), "Country": spark.createDataFrame([(1, "NZL"), (2, "NZL")], "CountryID int, Country string")}
    store = Warehouse(spark, f"store_{uuid.uuid4().hex[:8]}", str(tmp_path / "s"))
    with pytest.raises(ConstraintViolation, match="Country.Country' that stand for several keys"):
        store.upload_dimensions(versioned_model(spark), repeated)
    for bad in ([(1, "NZL"), (1, "PER")], [(None, "NZL")]):
        broken = {**dims(spark), "Country": spark.createDataFrame(bad, "CountryID int, Country string")}
        with pytest.raises(ConstraintViolation, match="NULL or duplicate primary keys"):
            store.upload_dimensions(versioned_model(spark), broken, replace=True)
    fine = {**dims(spark), "Country": spark.createDataFrame([(1, "NZL"), (2, None), (3, None)], "CountryID int, Country string")}
    store.upload_dimensions(versioned_model(spark), fine, replace=True)


# Statistics


@pytest.mark.parametrize("layout", LAYOUTS)
def test_single_values_come_from_footers(spark, tmp_path, layout):
    store = new_store(spark, tmp_path, **layout)
    assert statistics.stored_single_values(store, "Fact") == []
    store.replace("Fact", spark.createDataFrame([(1, 3, 1, 1990, 1.0), (1, 2, 1, 1990, 1.0), (1, 2, 1, None, 1.0)], VERSIONED))
    wanted = [c for c in store["Fact"].columns if c in ("ValidFromVersion", "Country", "val")]
    assert statistics.stored_single_values(store, "Fact") == wanted
    known = statistics.single_values_of_footers(store, "Fact")
    assert known["ValidFromVersion"] and not known["ValidToVersion"] and not known.get("Year") and "val" not in known
    text = plan(statistics.footer_aggregate(store, "Fact", ["ValidFromVersion", "Year"]))
    assert "PushedAggregation: [COUNT(*), COUNT(ValidFromVersion), MIN(ValidFromVersion), MAX(ValidFromVersion)" in text


def test_nulls_alone_are_a_single_value(spark, tmp_path):
    store = new_store(spark, tmp_path)
    store.replace("Fact", spark.createDataFrame([(1, 3, 1, None, 1.0), (1, 2, 1, None, 2.0)], VERSIONED))
    assert statistics.stored_single_values(store, "Fact") == ["ValidFromVersion", "Country", "Year"]


# Long tickets


def files_read(frame):
    """Data files that the largest scan of a frame reads when it runs."""
    frame.collect()

    def scans(node):
        name = node.nodeName()
        found = []
        if name.startswith("AdaptiveSparkPlan"):
            return scans(node.executedPlan())
        if "QueryStage" in name:
            return scans(node.plan())
        metrics = node.metrics()
        if name.startswith("Scan parquet") and metrics.contains("numFiles"):
            found.append(metrics.apply("numFiles").value())
        children = node.children()
        for k in range(children.size()):
            found += scans(children.apply(k))
        return found

    return max(scans(frame._jdf.queryExecution().executedPlan()))


def test_tickets_prune_partitions_whatever_their_length(spark, tmp_path):
    store = new_store(spark, tmp_path, partition_by={"Fact": ["Country"]})
    many = [("v1", "v1", c, y, 1.0) for c in ("NZL", "PER", "KEN") for y in range(600)]
    taken = upsert(store, facts(spark, *many), "Fact", in_place=True, additional=["Year"]).ticket
    two = taken.filter("Country IN ('NZL', 'KEN')")
    for wanted in (999, 1001):
        part = two.filter((F.col("Country") == "NZL") | (F.col("Year") < wanted - 600))
        fetched = read.collect_ticket(part, store)
        assert fetched.count() == wanted
        text = plan(fetched)
        assert "dynamicpruning" in text and "In(Year" not in text and "In(Country" not in text
        assert files_read(fetched) == 2
    assert rows(read.collect_ticket(two, store, verify=True)) == rows(read.filter_table(store, "Fact", "Country <> 'PER'"))


def test_collected_tickets_leave_no_files(spark, tmp_path):
    store = new_store(spark, tmp_path)
    taken = upsert(store, facts(spark, *STEPS[0]), "Fact", in_place=True).ticket
    folder = Path(scratch_dir(spark).removeprefix("file:"), "staged")
    before = sorted(folder.iterdir())
    with read.collected_ticket(taken, store) as fetched:
        assert fetched.count() == 3
    assert sorted(folder.iterdir()) == before


def test_refill_computes_its_source_once(spark, tmp_path):
    store = new_store(spark, tmp_path, partition_by={"Fact": ["Country"]})
    store.refill("Fact", spark.createDataFrame([(1, 3, 2, 1990, 1.0)], VERSIONED))
    seen = spark.sparkContext.accumulator(0)

    def each(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    given = spark.createDataFrame([(1, 3, c, 1990, 1.0) for c in (1, 3)], VERSIONED)
    store.refill("Fact", given.mapInArrow(each, given.schema))
    assert seen.value == 2 and [r["Country"] for r in store["Fact"].orderBy("Country").collect()] == [1, 3]


# Matrices


@pytest.fixture
def maps(spark):
    index = {
        "row": spark.createDataFrame([(1, "r1"), (2, "r2"), (3, "r3")], "IndexID int, Index string"),
        "col": spark.createDataFrame([(1, "c1"), (2, "c2")], "IndexID int, Index string"),
    }
    kinds = spark.createDataFrame([("zerom1", "row", "col"), ("zerom2", "row", "col")], "matname string, rowtype string, coltype string")
    return {"index_map": index, "rctypes": kinds}


@pytest.fixture
def matrices(spark, tmp_path):
    cells = spark.createDataFrame([], "matname string, i int, j int, value double")
    store = Warehouse(spark, f"store_{uuid.uuid4().hex[:8]}", str(tmp_path / "m"))
    store.create(KeyModel({"cells": cells.schema}, {"cells": ("matname", "i", "j")}, ()))
    return store


FULL = [(r, c, 0.0) for r in ("r1", "r2", "r3") for c in ("c1", "c2")]


def zero_matrices(spark):
    return spark.createDataFrame([("zerom1", FULL), ("zerom2", FULL)], "matname string, matval array<struct<rowname string, colname string, value double>>")


def test_zero_matrices_through_a_store(spark, matrices, maps):
    dropped = upsert(matrices, zero_matrices(spark), "cells", in_place=True, **maps)
    assert dropped.ticket.count() == 0 and matrices["cells"].count() == 0
    kept = upsert(matrices, zero_matrices(spark), "cells", in_place=True, retain_zeros=True, usual=None, **maps)
    assert matrices["cells"].count() == 12 and kept.ticket.count() == 1
    back = read.filter_table(matrices, "cells", matrices=True, **maps)
    assert back.columns == ["zerom1", "zerom2"]
    assert [[tuple(c) for c in m] for m in back.first()] == [FULL, FULL]


def test_missing_cells_are_completed(spark, matrices, maps):
    one = spark.createDataFrame([("zerom1", [("r2", "c1", 5.0)]), ("zerom2", [("r1", "c1", None)])], zero_matrices(spark).schema)
    upsert(matrices, one, "cells", in_place=True, **maps)
    full = read.filter_table(matrices, "cells", matrices=True, complete=True, **maps).first()
    assert [tuple(c) for c in full["zerom1"]] == [(r, c, 5.0 if (r, c) == ("r2", "c1") else 0.0) for r, c, _ in FULL]
    assert [tuple(c) for c in full["zerom2"]] == [(r, c, None if (r, c) == ("r1", "c1") else 0.0) for r, c, _ in FULL]
    pair = (maps["index_map"]["row"], maps["index_map"]["col"])
    cells = matrix.complete_cells(matrices["cells"], pair, maps["rctypes"])
    assert cells.count() == 12 and "CartesianProduct" not in plan(cells) and "NestedLoop" not in plan(cells)


def test_unknown_names_raise_whatever_is_read(spark, maps):
    wrong = spark.createDataFrame([("zerom1", "r1", "c9", 5.0)], "matname string, rowname string, colname string, value double")
    encoded = matrix.encode_matrices(wrong, maps["index_map"], maps["rctypes"])
    for action in (lambda: encoded.count(), lambda: encoded.agg(F.sum("value")).collect()):
        with pytest.raises(PySparkException, match="No column index for 'c9'"):
            action()
    stray = spark.createDataFrame([("zerom1", 8, 1, 5.0)], "matname string, i int, j int, value double")
    with pytest.raises(PySparkException, match="No row name for '8'"):
        matrix.name_cells(stray, maps["index_map"], maps["rctypes"]).count()


# CSV


def test_csv_snapshots_are_read_by_several_tasks(spark, tmp_path):
    texts = [f"line {n}\nback\\slash\\n and \\N\r\n, \"quoted\" {'x' * 200}" for n in range(2000)] + ["", None, "\\", "\\b", "\\N"]
    frame = spark.createDataFrame(list(enumerate(texts)), "n int, t string").coalesce(1)
    path = release_snapshot(frame, str(tmp_path), "t", format="csv", release=True)
    assert len(list(Path(path).glob("*.csv"))) == 1
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "65536"}):
        back = read_snapshot(spark, str(tmp_path), "t", format="csv", schema=frame.schema)
        assert back.rdd.getNumPartitions() > 1
        assert rows(back) == rows(frame)


def test_large_tables_of_lines(spark, tmp_path):
    spark.range(20000).selectExpr("id", "concat('name ', id) AS name").coalesce(1).write.csv(f"{tmp_path}/t.csv", header=True)
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "65536"}):
        whole, split = read_table(spark, f"{tmp_path}/t.csv"), read_table(spark, f"{tmp_path}/t.csv", rows_are_lines=True)
        assert whole.rdd.getNumPartitions() == 1 < split.rdd.getNumPartitions()
        assert rows(whole) == rows(split)


def test_ledger_module_has_no_table_scan_in_change(spark, tmp_path):
    """What a change adds to a ledger comes from the rows at hand alone."""
    store = new_store(spark, tmp_path)
    upsert(store, facts(spark, *STEPS[0]), "Fact", in_place=True)
    keep_ledger(store, "Fact")
    change = ledger.Change(store, "Fact")
    added = spark.createDataFrame([(1, 1, 1, 1999, 1.0)], VERSIONED)
    change.prepare(added)
    sums = spark.read.parquet(change.folder)
    assert rows(sums.select("Year", "__rows")) == [(1990, 1), (1990, 1), (1991, 1), (1999, 1)]
    assert not set(sums.inputFiles()) & set(store["Fact"].inputFiles())
