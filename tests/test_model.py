import datetime

import pytest
from pyspark.sql.types import DoubleType, IntegerType, StringType

from keyframe.functions.casting import apply_types, cast_losses
from keyframe.model import KeyModel
from keyframe.sources.tables import load_dimensions, load_schema_table
from tests.frames import BAND_SCHEMA, rows, schema_row


def test_types_and_keys():
    model = KeyModel.from_schema_table(BAND_SCHEMA)
    assert [f.dataType for f in model.struct("Player").fields] == [IntegerType(), StringType()]
    assert model.primary_key("PlayerPart") == ("Player",)
    assert model.parents() == ("Player", "Part")
    key = model.foreign_key("PlayerPart", "Part")
    assert (key.parent, key.parent_key, key.parent_value) == ("Part", "PartID", "Part")


def test_unknown_type():
    with pytest.raises(ValueError, match="Unknown data type: 'bogus'"):
        KeyModel.from_schema_table([schema_row("T", "TID", True, "bogus")])


def test_composite_key_and_missing_key():
    model = KeyModel.from_schema_table(
        [
            schema_row("T", "a", True, "int"),
            schema_row("T", "b", "TRUE", "date"),
            schema_row("U", "c", "FALSE", "text"),
        ]
    )
    assert model.primary_key("T") == ("a", "b")
    with pytest.raises(ValueError, match="needs a primary key"):
        model.primary_key("U")


@pytest.mark.parametrize("absent", ["NA", None, ""])
def test_no_foreign_key(absent):
    model = KeyModel.from_schema_table([schema_row("T", "a", True, "int", absent, absent)])
    assert model.foreign_keys == ()


def test_rerouted_key_keeps_the_parents_value_column():
    model = KeyModel.from_schema_table(
        [
            schema_row("Fact", "LastStage", True, "int", "Stage", "StageID"),
            schema_row("Stage", "StageID", True, "int"),
            schema_row("Stage", "Stage", False, "text"),
        ]
    )
    assert model.foreign_key("Fact", "LastStage").parent_value == "Stage"


def test_unknown_parent():
    with pytest.raises(ValueError, match="Nowhere"):
        KeyModel.from_schema_table([schema_row("T", "a", True, "int", "Nowhere", "NowhereID")])


def test_schema_rows_round_trip():
    model = KeyModel.from_schema_table(BAND_SCHEMA)
    assert model.schema_rows() == BAND_SCHEMA
    assert KeyModel.from_schema_table(model.schema_rows()) == model


def test_empty_table(spark):
    empty = KeyModel.from_schema_table([schema_row("T", "x", True, "double precision")]).empty(spark, "T")
    assert empty.schema["x"].dataType == DoubleType() and empty.count() == 0


def test_coercion(spark):
    raw = spark.createDataFrame(
        [
            ("3.7", " 12 ", "T", "2020-01-05 extra", "a"),
            ("1e3", "1.5d", "yes", "2020-13-05", "b"),
            ("ten", "0.1", "FALSE", "5-1-2", None),
            (None, None, None, None, "d"),
            ("99999999999", "x", "0", "2020-02-30", "e"),
        ],
        "n string, x string, b string, d string, t string",
    )
    model = KeyModel.from_schema_table(
        [
            schema_row("T", "n", True, "int"),
            schema_row("T", "x", False, "double precision"),
            schema_row("T", "b", False, "boolean"),
            schema_row("T", "d", False, "date"),
            schema_row("T", "t", False, "text"),
        ]
    )
    typed = apply_types(raw, model.struct("T"))
    assert typed.schema == model.struct("T")
    assert [tuple(r) for r in typed.collect()] == [
        (3, 12.0, True, datetime.date(2020, 1, 5), "a"),
        (1000, None, None, None, "b"),
        (None, 0.1, False, datetime.date(5, 1, 2), None),
        (None, None, None, None, "d"),
        (None, None, None, None, "e"),
    ]
    assert tuple(cast_losses(raw, model.struct("T")).first()) == (2, 2, 2, 2, 0)


def test_numbers_and_flags_to_text(spark):
    raw = spark.createDataFrame([(3.0, True), (2.5, False), (None, None)], "x double, b boolean")
    model = KeyModel.from_schema_table([schema_row("T", "x", True, "text"), schema_row("T", "b", False, "text")])
    assert [tuple(r) for r in apply_types(raw, model.struct("T")).collect()] == [
        ("3", "TRUE"),
        ("2.5", "FALSE"),
        (None, None),
    ]


def test_undeclared_column(spark):
    model = KeyModel.from_schema_table([schema_row("T", "x", True, "int")])
    with pytest.raises(ValueError, match="without a declared type"):
        apply_types(spark.createDataFrame([("1", "2")], "x string, y string"), model.struct("T"))


def test_tables_from_a_folder(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame(BAND_SCHEMA).coalesce(1).write.csv(f"{folder}/Schema.csv", header=True)
    spark.createDataFrame([("1", "Ana"), ("2", "Bo")], "PlayerID string, Player string").write.csv(
        f"{folder}/Player.csv", header=True
    )
    spark.createDataFrame([(1.0, "Violin")], "PartID double, Part string").write.parquet(f"{folder}/Part")
    spark.createDataFrame([("hello",)], "text string").write.csv(f"{folder}/README.csv")
    model = KeyModel.from_schema_table(load_schema_table(spark, f"{folder}/Schema.csv"))
    assert model.primary_keys == KeyModel.from_schema_table(BAND_SCHEMA).primary_keys
    assert {fk for fk in model.foreign_keys} == {fk for fk in KeyModel.from_schema_table(BAND_SCHEMA).foreign_keys}
    loaded = load_dimensions(spark, folder, model)
    assert set(loaded) == {"Player", "Part"}
    assert rows(loaded["Player"]) == [(1, "Ana"), (2, "Bo")]
    assert loaded["Part"].schema == model.struct("Part")


def test_not_a_schema_table(spark, tmp_path):
    path = f"{tmp_path}/x.parquet"
    spark.range(1).write.parquet(path)
    with pytest.raises(ValueError, match="Not a schema table"):
        load_schema_table(spark, path)
