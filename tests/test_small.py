from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from keyframe import names, refdata
from keyframe.operators.filters import drop_task_group, filter_members_periods
from keyframe.sources import storage
from keyframe.sources.snapshots import (
    NOT_RELEASED,
    read_release,
    read_snapshot,
    release_snapshot,
    snapshot_versions,
)
from tests.frames import rows


@pytest.fixture
def places(spark):
    data = [(c, y, n) for n, (c, y) in enumerate((c, y) for c in ("NZL", "PER") for y in (1971, 2000))]
    return spark.createDataFrame(data, "Country string, Year int, n int")


def test_members_and_periods(spark, places):
    def kept(members, periods):
        return sorted(r["n"] for r in filter_members_periods(places, members, periods).collect())

    assert kept(["NZL"], range(1960, 2000)) == [0]
    assert kept("all", "all") == [0, 1, 2, 3]
    assert kept("all", 1971) == [0, 2]
    assert kept("PER", "all") == [2, 3]
    assert kept(["all"], [1971, 2000]) == [0, 1, 2, 3]
    assert kept([], "all") == []
    assert kept(spark.createDataFrame([("PER",), ("PER",)], "c string"), [2000]) == [3]


def test_filters_reach_the_reader(spark, places, tmp_path):
    places.write.parquet(f"{tmp_path}/p")
    kept = filter_members_periods(spark.read.parquet(f"{tmp_path}/p"), ["NZL", "PER"], [1971]).select("n")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "In(Country, [NZL,PER])" in plan


def test_task_group(places):
    assert drop_task_group(places) .columns == places.columns
    assert drop_task_group(places.withColumn("tar_group", F.lit(1))).columns == places.columns


def test_snapshots(spark, places, tmp_path):
    root = str(tmp_path)
    assert release_snapshot(places, root, "p") == NOT_RELEASED
    assert snapshot_versions(spark, root, "p") == []
    with pytest.raises(ValueError, match="p does not exist"):
        read_snapshot(spark, root, "p")
    first = release_snapshot(places, root, "p", release=True)
    (label,) = snapshot_versions(spark, root, "p")
    assert first == f"{root}/p/version={label}"
    assert len(label) == len("20220218T023112Z-1d9e1")
    release_snapshot(places.filter("n > 1"), root, "p", release=True)
    assert rows(read_snapshot(spark, root, "p", label)) == rows(places)
    # The newest is the default, also when released within the same second.
    assert rows(read_snapshot(spark, root, "p")) == rows(places.filter("n > 1"))
    assert read_snapshot(spark, root, "p").columns == places.columns
    with pytest.raises(ValueError, match="has no version x"):
        read_snapshot(spark, root, "p", "x")
    with pytest.raises(ValueError, match="Unknown snapshot format"):
        release_snapshot(places, root, "p", format="rds", release=True)


def test_csv_snapshots_and_releases(spark, places, tmp_path):
    root = str(tmp_path)
    release_snapshot(places, root, "p", format="csv", release=True)
    (label,) = snapshot_versions(spark, root, "p")
    releases = spark.createDataFrame([("v1.2", "p", label)], "database_version string, name string, version string")
    for wanted in ("v1.2", 1.2, "1.2"):
        frame = read_release(spark, root, "p", wanted, releases, format="csv", schema=places.schema)
        assert rows(frame) == rows(places)
    with pytest.raises(ValueError, match="0 entries for snapshot p"):
        read_release(spark, root, "p", "v9", releases)


def test_csv_keeps_every_character(spark, tmp_path):
    texts = ['a "b" c', "back\\slash\\", "two\nlines", "crlf\r\nhere", "  padded ", "", None, ",;'", '"', '\\"', "é"]
    frame = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    release_snapshot(frame, str(tmp_path), "t", format="csv", release=True)
    read = read_snapshot(spark, str(tmp_path), "t", format="csv", schema=frame.schema)
    assert rows(read) == rows(frame)


def test_countries(spark):
    assert len(refdata.ALL_COUNTRIES) == len(set(refdata.ALL_COUNTRIES)) == 166
    assert len(refdata.CANONICAL_COUNTRIES) == 157
    dim = refdata.country_dimension(spark)
    kept = refdata.canonical_members(dim, "Country")
    assert rows(kept) == rows(dim.filter("NOT is_double_counted")) and kept.count() == 157


def test_default_group_columns():
    assert names.TABLE_NAME_COL in names.USUAL_GROUP_COLS and len(names.USUAL_GROUP_COLS) == 9


def test_scratch_folder_comes_from_the_session(spark):
    assert storage.scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    staged = storage.stage(spark.range(5), "five")
    assert staged.count() == 5
    assert storage.scratch_dir(spark) in staged.inputFiles()[0]


def test_scratch_folder_without_the_setting_is_in_the_warehouse():
    session = SimpleNamespace(conf={"spark.sql.warehouse.dir": "file:/shared/warehouse/"})
    assert storage.scratch_dir(session) == "file:/shared/warehouse/keyframe-scratch"


def test_staged_files_go_at_the_end_of_the_block(spark):
    with storage.staged(spark.range(5), "five") as frame:
        path = frame.inputFiles()[0].rsplit("/", 1)[0]
        assert frame.count() == 5 and storage.exists(spark, path)
    assert not storage.exists(spark, path)
