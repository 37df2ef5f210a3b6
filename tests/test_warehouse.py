import uuid
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from keyframe.model import ForeignKey, KeyModel
from keyframe.operators.constraints import ConstraintViolation
from keyframe.operators.keys import UnmatchedValues, decode_keys
from keyframe.operators.upsert import merge_rows
from keyframe.plans.read import collect_ticket, filter_table
from keyframe.plans.write import compress_table, filter_copy, upsert
from keyframe.sources.warehouse import Warehouse
from tests.frames import VERSIONED, band, dims, rows, versioned_model


@pytest.fixture
def store(spark, tmp_path):
    return Warehouse(spark, f"test_{uuid.uuid4().hex[:8]}", str(tmp_path / "store"))


@pytest.fixture
def quartet(spark, store):
    model, parents = band(spark)
    store.upload_dimensions(model, parents)
    store.replace("PlayerPart", spark.createDataFrame([(n, n) for n in (1, 2, 3, 4)], "Player int, Part int"))
    return store


def people(spark, *pairs):
    return spark.createDataFrame(list(pairs), "Player string, Part string")


# Merging


TARGET = [(1, "a", 1.0), (2, "b", 2.0), (3, None, 3.0)]


def test_merge_updates_and_inserts(spark):
    target = spark.createDataFrame(TARGET, "k int, s string, x double")
    source = spark.createDataFrame([(2, "B", 20.0), (4, None, 40.0)], "k long, s string, x double")
    merged = merge_rows(target, source, ["k"])
    assert merged.schema["k"].dataType == target.schema["k"].dataType
    assert rows(merged) == [(1, "a", 1.0), (2, "B", 20.0), (3, None, 3.0), (4, None, 40.0)]


def test_merge_keeps_columns_the_source_lacks(spark):
    target = spark.createDataFrame(TARGET, "k int, s string, x double")
    source = spark.createDataFrame([(20.0, 2), (40.0, 4)], "x double, k int")
    assert rows(merge_rows(target, source, ["k"])) == [
        (1, "a", 1.0),
        (2, "b", 20.0),
        (3, None, 3.0),
        (4, None, 40.0),
    ]


def test_merge_refuses_bad_sources(spark):
    target = spark.createDataFrame(TARGET, "k int, s string, x double")
    with pytest.raises(ValueError, match="do not exist in the target"):
        merge_rows(target, target.withColumn("new", F.lit(1)), ["k"])
    with pytest.raises(ValueError, match="missing from the rows"):
        merge_rows(target, target.drop("k"), ["k"])
    with pytest.raises(ConstraintViolation, match="k=1, rows=2"):
        merge_rows(target, target.unionByName(target.filter("k = 1")), ["k"])
    with pytest.raises(ConstraintViolation):
        merge_rows(target, target.withColumn("k", F.lit(None).cast("int")), ["k"])


def test_merge_does_not_shuffle_the_target_for_a_small_source(spark, tmp_path):
    spark.range(100_000).withColumn("x", F.rand(1)).write.parquet(f"{tmp_path}/big")
    spark.range(10).withColumn("x", F.rand(2)).write.parquet(f"{tmp_path}/small")
    big, small = spark.read.parquet(f"{tmp_path}/big"), spark.read.parquet(f"{tmp_path}/small")
    plan = merge_rows(big, small, ["id"], check_source=False)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan


def test_merge_of_touched_partitions(spark):
    target = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (3, 1, "d")], "p int, k int, s string")
    source = spark.createDataFrame([(1, 2, "B"), (3, 9, "new")], "p int, k int, s string")
    expected = [(1, 1, "a"), (1, 2, "B"), (3, 1, "d"), (3, 9, "new")]
    assert rows(merge_rows(target, source, ["p", "k"], partitions=["p"])) == expected
    both = merge_rows(target, source, ["p", "k"], partitions=["p", "k"])
    assert rows(both) == [(1, 2, "B"), (3, 9, "new")]
    with pytest.raises(ValueError, match="not part of the primary key"):
        merge_rows(target, source, ["k"], partitions=["p"])


# The catalog


def test_model_comes_back_from_the_catalog(spark, quartet):
    model, parents = band(spark)
    assert quartet.model() == model
    assert set(quartet) == {"Player", "Part", "PlayerPart"} and len(quartet) == 3
    assert set(quartet.dimensions()) == {"Player", "Part"}
    assert rows(quartet.dimensions()["Player"]) == rows(parents["Player"])
    one = quartet.model(["PlayerPart"])
    assert one.primary_key("PlayerPart") == ("Player",) and len(one.foreign_keys) == 2
    with pytest.raises(KeyError):
        quartet["Nothing"]


def test_creating_twice_needs_replace(spark, quartet):
    model, parents = band(spark)
    with pytest.raises(AnalysisException):
        quartet.create(model)
    quartet.upload_dimensions(model, parents, replace=True)
    assert quartet["PlayerPart"].count() == 0 and quartet["Player"].count() == 4


def test_dimensions_need_a_primary_key(spark, store):
    frame = spark.createDataFrame([(1, "x")], "a int, b string")
    with pytest.raises(ValueError, match="needs a primary key"):
        store.upload_dimensions(KeyModel({"D": frame.schema}), {"D": frame})


def test_dimension_columns(spark, store):
    model, parents = band(spark)
    with pytest.raises(ValueError, match="do not exist in table 'Part'"):
        store.upload_dimensions(model, {"Part": parents["Part"].withColumn("more", F.lit(1))})
    store.upload_dimensions(model, {"Part": parents["Part"].select("PartID")}, replace=True)
    assert rows(store["Part"]) == [(n, None) for n in (1, 2, 3, 4)]


def test_update_dimension(spark, quartet):
    quartet.update_dimension("Part", spark.createDataFrame([(4, "Piano"), (5, "Flute")], "PartID int, Part string"))
    assert rows(quartet["Part"]) == [(1, "Violin"), (2, "Viola"), (3, "Cello"), (4, "Piano"), (5, "Flute")]


def test_replace_may_read_the_table(spark, quartet):
    for _ in range(3):
        quartet.replace("PlayerPart", quartet["PlayerPart"].withColumn("Part", F.col("Part") % 4 + 1))
    assert rows(quartet["PlayerPart"]) == [(1, 4), (2, 1), (3, 2), (4, 3)]


def test_old_folders(spark, quartet, tmp_path):
    folder = tmp_path / "store" / "PlayerPart"
    for _ in range(3):
        quartet.replace("PlayerPart", quartet["PlayerPart"])
    before = rows(quartet["PlayerPart"])
    assert len(list(folder.glob("data-*"))) == 4
    assert len(quartet.remove_old_folders("PlayerPart")) == 2
    assert len(list(folder.glob("data-*"))) == 2
    assert rows(quartet["PlayerPart"]) == before


def test_a_failed_replace_changes_nothing(spark, quartet):
    before = rows(quartet["PlayerPart"])
    broken = quartet["PlayerPart"].withColumn("Part", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(PySparkException):
        quartet.replace("PlayerPart", broken)
    assert rows(quartet["PlayerPart"]) == before


# Upserts


def test_upsert_needs_parents(spark, quartet):
    fifth = spark.createDataFrame([(5, 5)], "Player int, Part int")
    upsert(quartet, spark.createDataFrame([(5, "Eve")], "PlayerID int, Player string"), "Player", in_place=True)
    with pytest.raises(ConstraintViolation, match="insert or update on table 'PlayerPart'.*\n.*orphan: Part: '5'"):
        upsert(quartet, fifth, "PlayerPart", in_place=True)
    assert quartet["PlayerPart"].count() == 4
    parts = spark.createDataFrame([(5, "Flute"), (6, "Oboe")], "PartID int, Part string")
    upsert(quartet, parts, "Part", in_place=True)
    upsert(quartet, fifth, "PlayerPart", in_place=True)
    assert rows(quartet["PlayerPart"]) == [(n, n) for n in (1, 2, 3, 4, 5)]
    # Readable values find their keys, and an existing key is updated.
    taken = upsert(quartet, people(spark, ("Eve", "Oboe")), "PlayerPart", in_place=True).ticket
    assert (5, 6) in rows(quartet["PlayerPart"])
    fetched = collect_ticket(taken, quartet, model=quartet.model(), dims=quartet.dimensions(), verify=True)
    assert rows(fetched) == [("Eve", "Oboe")]


def test_upsert_lists_unknown_values(spark, quartet):
    with pytest.raises(UnmatchedValues) as error:
        upsert(quartet, people(spark, ("Zed", "Cello"), ("Yan", "Tuba")), "PlayerPart", in_place=True)
    for text in ("Player: 'Zed'", "Player: 'Yan'", "Part: 'Tuba'"):
        assert text in str(error.value)


def test_upsert_refuses_null_keys(spark, quartet):
    nobody = spark.createDataFrame([(1, None)], "Player int, Part int")
    with pytest.raises(ConstraintViolation, match="null: Part"):
        upsert(quartet, nobody, "PlayerPart", in_place=True)


def test_dimensions_need_their_parents_too(spark, store):
    region = spark.createDataFrame([(1, "north")], "RegionID int, Region string")
    place = spark.createDataFrame([(1, "NZL", 1), (2, "PER", 7)], "PlaceID int, Place string, Region int")
    model = KeyModel(
        {"Place": place.schema, "Region": region.schema},
        {"Place": ("PlaceID",), "Region": ("RegionID",)},
        (ForeignKey("Place", "Region", "Region", "RegionID", "Region"),),
    )
    with pytest.raises(ConstraintViolation, match="orphan: Region: '7'"):
        store.upload_dimensions(model, {"Place": place, "Region": region})
    store.upload_dimensions(model, {"Place": place.filter("PlaceID = 1"), "Region": region}, replace=True)
    with pytest.raises(ConstraintViolation, match="orphan: Region: '7'"):
        store.update_dimension("Place", place)
    assert store["Place"].count() == 1


def test_null_keys_where_allowed(spark, store):
    model, parents = band(spark)
    store.upload_dimensions(model, parents, not_null_keys=False)
    upsert(store, spark.createDataFrame([(1, None)], "Player int, Part int"), "PlayerPart", in_place=True)
    assert rows(store["PlayerPart"]) == [(1, None)]
    with pytest.raises(ConstraintViolation, match="column=Part, nulls=1"):
        store.require_keys_not_null(["PlayerPart"])
    store.empty("PlayerPart")
    store.require_keys_not_null(["PlayerPart"])
    with pytest.raises(ConstraintViolation, match="null: Part"):
        upsert(store, spark.createDataFrame([(2, None)], "Player int, Part int"), "PlayerPart", in_place=True)


def test_upsert_without_in_place_writes_nothing(spark, quartet):
    before = rows(quartet["PlayerPart"])
    written = upsert(quartet, people(spark, ("Ana", "Bass")), "PlayerPart", compress=False)
    assert (1, 4) in rows(written.table) and written.ticket.count() == 1
    assert rows(quartet["PlayerPart"]) == before


def test_table_name_from_the_frame(spark, quartet):
    frame = people(spark, ("Ana", "Bass")).withColumn("DBTableName", F.lit("PlayerPart"))
    by_column = upsert(quartet, frame, in_place=True)
    by_name = upsert(quartet, people(spark, ("Ana", "Bass")), "PlayerPart", in_place=True)
    assert rows(by_column.ticket) == rows(by_name.ticket)
    with pytest.raises(ValueError, match="exactly 1 table name"):
        upsert(quartet, frame.unionByName(frame.withColumn("DBTableName", F.lit("Part"))))
    with pytest.raises(ValueError, match="Give a table name"):
        upsert(quartet, people(spark, ("Ana", "Bass")))


def test_rerouted_key(spark, store):
    stage = spark.createDataFrame([(1, "Primary"), (2, "Final"), (3, "Useful")], "StageID int, Stage string")
    fact = spark.createDataFrame([(1, 42.0), (2, 43.0), (3, 44.0)], "LastStage int, Value double")
    model = KeyModel(
        {"Stage": stage.schema, "Fact": fact.schema},
        {"Stage": ("StageID",), "Fact": ("LastStage",)},
        (ForeignKey("Fact", "LastStage", "Stage", "StageID", "Stage"),),
    )
    store.upload_dimensions(model, {"Stage": stage})
    upsert(store, fact, "Fact", in_place=True)
    readable = decode_keys(store["Fact"], "Fact", model, store.dimensions())
    assert rows(readable) == [("Final", 43.0), ("Primary", 42.0), ("Useful", 44.0)]
    upsert(store, readable, "Fact", in_place=True)
    assert rows(store["Fact"]) == rows(fact)


COMPRESSIBLE = [
    (1, 1, 1, 1990, 1.0),
    (2, 2, 1, 1990, 1.0),
    (2, 2, 2, 1990, 2.0),
    (3, 3, 2, 1990, 2.0),
    (4, 10, 3, 1991, 8.0),
]
COMPRESSED = [(1, 2, 1, 1990, 1.0), (2, 3, 2, 1990, 2.0), (4, 10, 3, 1991, 8.0)]


@pytest.mark.parametrize("partition_by", [None, {"Fact": ["Country", "Year"]}])
def test_compress(spark, store, partition_by):
    model = versioned_model(spark)
    store.upload_dimensions(model, dims(spark), partition_by=partition_by)
    fact = spark.createDataFrame(COMPRESSIBLE, VERSIONED)
    names = [f.name for f in fact.schema.fields]
    upsert(store, fact, "Fact", in_place=True)
    assert rows(store["Fact"].select(*names)) == COMPRESSIBLE
    compress_table(store, "Fact")
    assert rows(store["Fact"].select(*names)) == COMPRESSED
    store.empty("Fact")
    assert store["Fact"].count() == 0
    upsert(store, fact, "Fact", in_place=True, compress=True)
    assert rows(store["Fact"].select(*names)) == COMPRESSED
    store.empty("Fact")
    noisy = fact.withColumn("val", F.col("val") + F.col("ValidFromVersion") * 1e-7)
    upsert(store, noisy, "Fact", in_place=True, compress=True)
    assert store["Fact"].count() == 5
    store.empty("Fact")
    upsert(store, noisy, "Fact", in_place=True, compress=True, round_doubles=True, digits=3)
    assert rows(store["Fact"].select(*names)) == COMPRESSED


def test_compress_only_touched_partitions(spark, store):
    store.upload_dimensions(versioned_model(spark), dims(spark), partition_by={"Fact": ["Country"]})
    names = spark.createDataFrame([], VERSIONED).columns
    upsert(store, spark.createDataFrame(COMPRESSIBLE, VERSIONED), "Fact", in_place=True)
    third = spark.createDataFrame([(3, 3, 1, 1990, 1.0)], VERSIONED)
    upsert(store, third, "Fact", in_place=True, compress="touched")
    untouched = [r for r in COMPRESSIBLE if r[2] != 1]
    assert rows(store["Fact"].select(*names)) == sorted([(1, 3, 1, 1990, 1.0), *untouched], key=repr)
    with pytest.raises(ValueError, match="compress must be"):
        upsert(store, third, "Fact", compress="some")


def test_a_table_partitioned_by_version_cannot_be_compressed(spark, store):
    store.upload_dimensions(versioned_model(spark), dims(spark), partition_by={"Fact": ["ValidFromVersion"]})
    with pytest.raises(ValueError, match="partitioned by version"):
        compress_table(store, "Fact")
    with pytest.raises(ValueError, match="partitioned by version"):
        upsert(store, spark.createDataFrame(COMPRESSIBLE, VERSIONED), "Fact", compress=True)


def test_an_upsert_rewrites_only_touched_partitions(spark, store, tmp_path):
    store.upload_dimensions(versioned_model(spark), dims(spark), partition_by={"Fact": ["Country"]})
    upsert(store, spark.createDataFrame(COMPRESSIBLE, VERSIONED), "Fact", in_place=True)

    def files():
        found = {}
        for path in Path(tmp_path).rglob("Country=*/*.parquet"):
            found.setdefault(path.parent.name, set()).add(path.name)
        return found

    before = files()
    assert set(before) == {"Country=1", "Country=2", "Country=3"}
    change = spark.createDataFrame([(2, 2, 2, 1990, 99.0), (2, 2, 2, 1999, 5.0)], VERSIONED)
    upsert(store, change, "Fact", in_place=True)
    after = files()
    assert {c for c in before if before[c] == after[c]} == {"Country=1", "Country=3"}
    names = change.columns
    expected = [r for r in COMPRESSIBLE if r != (2, 2, 2, 1990, 2.0)] + [(2, 2, 2, 1990, 99.0), (2, 2, 2, 1999, 5.0)]
    assert rows(store["Fact"].select(*names)) == sorted(expected, key=repr)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_versions_of_a_stored_table(spark, store):
    store.upload_dimensions(versioned_model(spark), dims(spark))
    upsert(store, spark.createDataFrame(COMPRESSED, VERSIONED), "Fact", in_place=True)
    options = {"model": store.model(), "dims": store.dimensions()}
    assert rows(filter_table(store, "Fact", "Country = 'KEN'", versions="v9", **options)) == [
        ("v4", "v10", "KEN", 1991, 8.0)
    ]


# Copies


def copy_store(spark, store, partition_by=None):
    years = spark.createDataFrame([(y, y) for y in (1970, 1971, 1972)], "YearID int, Year int")
    places = spark.createDataFrame([(1, "NZL"), (2, "PER"), (3, "KEN")], "CountryID int, Country string")
    fact = spark.createDataFrame(
        [(c, y, 10 * c + y) for c in (1, 2, 3) for y in (1970, 1971, 1972)], "Country int, Year int, X int"
    )
    keys = []
    for name in ("source", "dest"):
        keys.append(ForeignKey(name, "Country", "Country", "CountryID", "Country"))
        keys.append(ForeignKey(name, "Year", "Year", "YearID", "Year"))
    model = KeyModel(
        {"source": fact.schema, "dest": fact.schema, "Country": places.schema, "Year": years.schema},
        {"source": ("Country", "Year"), "dest": ("Country", "Year"), "Country": ("CountryID",), "Year": ("YearID",)},
        tuple(keys),
    )
    store.upload_dimensions(model, {"Country": places, "Year": years}, partition_by=partition_by)
    upsert(store, fact, "source", in_place=True)
    return store


@pytest.mark.parametrize("partition_by", [None, {"dest": ["Year"]}])
def test_filter_copy(spark, store, partition_by):
    copy_store(spark, store, partition_by)
    written = filter_copy(store, "source", "dest", members=["NZL", "PER"], periods=[1970, 1972], in_place=True)
    assert written.ticket.columns == ["DBTableName", "Country", "Year", "NestedDataHash"]
    assert {tuple(r)[:3] for r in written.ticket.collect()} == {
        ("dest", c, y) for c in ("NZL", "PER") for y in (1970, 1972)
    }
    columns = ["Country", "Year", "X"]
    first = [(c, y, 10 * c + y) for c in (1, 2) for y in (1970, 1972)]
    assert rows(store["dest"].select(*columns)) == first
    filter_copy(store, "source", "dest", members=["KEN"], empty_dest=False, in_place=True)
    third = [(3, y, 30 + y) for y in (1970, 1971, 1972)]
    assert rows(store["dest"].select(*columns)) == first + third
    with pytest.raises(ConstraintViolation, match="Keys already in 'dest'"):
        filter_copy(store, "source", "dest", members=["KEN"], empty_dest=False, in_place=True)
    filter_copy(store, "source", "dest", periods=[1971], in_place=True)
    assert rows(store["dest"].select(*columns)) == [(c, 1971, 10 * c + 1971) for c in (1, 2, 3)]


def test_filter_copy_without_filters_or_in_place(spark, store):
    copy_store(spark, store)
    written = filter_copy(store, "source", "dest")
    assert written.table.count() == 9 and store["dest"].count() == 0
    listed = spark.createDataFrame([("KEN",), ("KEN",)], "c string")
    assert filter_copy(store, "source", "dest", members=listed).table.count() == 3
    with pytest.raises(UnmatchedValues, match="CAN"):
        filter_copy(store, "source", "dest", members=["NZL", "CAN"])
    with pytest.raises(ValueError, match="two tables"):
        filter_copy(store, "source", "source")
