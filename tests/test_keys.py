import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from keyframe.operators import constraints, keys
from tests.frames import LARGE_DATA, band, countries_dim, rows, settings


def test_encode_then_decode(spark):
    model, dims = band(spark)
    named = spark.createDataFrame([("Bo", "Cello", 1), ("Dee", "Viola", 2)], "Player string, Part string, n int")
    coded = keys.encode_keys(named, "PlayerPart", model, dims)
    assert coded.columns == ["Player", "Part", "n"]
    assert rows(coded) == [(2, 3, 1), (4, 2, 2)]
    assert rows(keys.decode_keys(coded, "PlayerPart", model, dims)) == rows(named)


@pytest.mark.parametrize("bad", ["Zed", None])
def test_inline_check_names_the_value(spark, bad):
    model, dims = band(spark)
    named = spark.createDataFrame([("Bo", "Cello"), (bad, "Viola")], "Player string, Part string")
    with pytest.raises(PySparkException, match=f"No key in 'Player.PlayerID'.*'{bad or 'NULL'}'"):
        keys.encode_keys(named, "PlayerPart", model, dims).collect()


def test_listed_check_names_all_values_of_all_columns(spark):
    model, dims = band(spark)
    named = spark.createDataFrame([("Zed", "Tuba"), ("Yan", "Cello"), ("Yan", None)], "Player string, Part string")
    with pytest.raises(keys.UnmatchedValues) as error:
        keys.encode_keys(named, "PlayerPart", model, dims, check="listed")
    for part in ("Player: 'Zed'", "Player: 'Yan'", "Part: 'Tuba'", "Part: 'None'"):
        assert part in str(error.value)
    assert rows(keys.unmatched_values(named, "PlayerPart", model, dims)) == [
        ("Part", "Part", "Tuba", 1),
        ("Part", "Part", None, 1),
        ("Player", "Player", "Yan", 2),
        ("Player", "Player", "Zed", 1),
    ]


def test_integers_absent_columns_and_tables_without_keys_are_left_alone(spark):
    model, dims = band(spark)
    coded = spark.createDataFrame([(7, "x")], "Player int, other string")
    assert keys.encode_keys(coded, "PlayerPart", model, dims) is coded
    assert keys.encode_keys(coded, "Player", model, dims) is coded
    assert keys.decode_keys(coded, "Player", model, dims) is coded


def test_force_encodes_integer_values(spark):
    model, dims = band(spark)
    years = spark.createDataFrame([(1, 1970), (2, 1980)], "PartID int, Part int")
    coded = spark.createDataFrame([(1980,)], "Part int")
    assert rows(keys.encode_keys(coded, "PlayerPart", model, {**dims, "Part": years}, force=["Part"])) == [(2,)]


def test_decode_gives_null_without_a_parent(spark):
    model, dims = band(spark)
    coded = spark.createDataFrame([(9, 1), (None, 2)], "Player int, Part int")
    assert rows(keys.decode_keys(coded, "PlayerPart", model, dims)) == [(None, "Viola"), (None, "Violin")]


def test_single_column_codec(spark):
    dim = countries_dim(spark)
    pair = {"key": "CountryID", "value": "Country"}
    named = spark.createDataFrame([("NZL",), ("NZL",), ("KEN",)], "c string")
    coded = keys.encode_column(named, "c", dim, **pair)
    assert rows(coded) == [(1,), (1,), (3,)]
    assert rows(keys.decode_column(coded, "c", dim, **pair)) == rows(named)
    unknown = spark.createDataFrame([("CAN",)], "c string")
    with pytest.raises(PySparkException, match="Unknown foreign key value in column 'c': CAN"):
        keys.encode_column(unknown, "c", dim, **pair).collect()
    with pytest.raises(PySparkException, match="Unknown foreign key in column 'c': 42"):
        keys.decode_column(spark.createDataFrame([(42,)], "c int"), "c", dim, **pair).collect()
    assert rows(keys.encode_column(unknown, "c", dim, strict=False, **pair)) == [(None,)]


def test_lookup_keys(spark):
    dim = countries_dim(spark)
    assert keys.lookup_keys(["KEN", "NZL", "KEN"], dim, key="CountryID", value="Country") == {"KEN": 3, "NZL": 1}
    assert keys.lookup_keys([], dim, key="CountryID", value="Country") == {}
    with pytest.raises(keys.UnmatchedValues, match="GBR, CAN"):
        keys.lookup_keys(["GBR", "KEN", "CAN"], dim, key="CountryID", value="Country")
    twice = dim.unionByName(dim.select((F.col("CountryID") + 10).alias("CountryID"), "Country"))
    with pytest.raises(ValueError, match="more than once"):
        keys.lookup_keys(["KEN"], twice, key="CountryID", value="Country")


def test_hot_key_is_split_when_the_dimension_is_too_large_to_broadcast(spark):
    """A third of all rows hold one key: adaptive execution splits its partition."""
    model, dims = band(spark)
    with settings(spark, LARGE_DATA):
        large = spark.range(1, 3001).select(
            F.col("id").cast("int").alias("PartID"), F.concat(F.lit("p"), "id").alias("Part")
        )
        fact = spark.range(0, 60000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 3000 + 1).cast("int").alias("Part"), "id"
        )
        decoded = keys.decode_keys(fact, "PlayerPart", model, {**dims, "Part": large})
        result = {r["Part"]: r["n"] for r in decoded.groupBy("Part").agg(F.count("*").alias("n")).collect()}
        assert sum(result.values()) == 60000
        assert result["p7"] == fact.filter("Part = 7").count() >= 20000
        decoded.collect()
        plan = decoded._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan


def test_constraint_reports(spark):
    model, dims = band(spark)
    coded = spark.createDataFrame([(1, 1), (1, 5), (None, 2), (9, None), (9, 5)], "Player int, Part int")
    assert rows(constraints.foreign_key_nulls(coded, "PlayerPart", model)) == [("Part", 1), ("Player", 1)]
    assert rows(constraints.duplicate_keys(coded, ["Player"])) == [(1, 2), (9, 2)]
    assert rows(constraints.orphan_keys(coded, "PlayerPart", model, dims)) == [
        ("Part", "Part", "5", 2),
        ("Player", "Player", "9", 2),
    ]
    assert rows(constraints.foreign_key_nulls(coded, "Player", model)) == []
    assert rows(constraints.orphan_keys(coded, "Player", model, dims)) == []
    with pytest.raises(constraints.ConstraintViolation, match="violates a foreign key"):
        constraints.require_foreign_keys(coded, "PlayerPart", model, dims)
    nulls_allowed = coded.filter("Player IS NULL")
    constraints.require_foreign_keys(nulls_allowed, "PlayerPart", model, dims, not_null=False)
    with pytest.raises(constraints.ConstraintViolation, match="null: Player"):
        constraints.require_foreign_keys(nulls_allowed, "PlayerPart", model, dims)
    with pytest.raises(constraints.ConstraintViolation, match="NULL or duplicate"):
        constraints.require_primary_key(nulls_allowed, "PlayerPart", ["Player"])
