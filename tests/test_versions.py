import pytest

from keyframe.model import ForeignKey, KeyModel
from keyframe.operators import versions
from keyframe.operators.keys import UnmatchedValues, decode_keys
from keyframe.plans.read import filter_table
from tests.frames import VERSIONED, dims, rows, versioned_model

FACT = [
    (1, 1, 1, 1990, 10.0),
    (1, 3, 2, 1990, 20.0),
    (2, 2, 1, 1990, 30.0),
    (2, 5, 3, 1991, 40.0),
    (6, 10, 3, 1992, 50.0),
]


@pytest.fixture
def fact(spark):
    return spark.createDataFrame(FACT, VERSIONED)


def pick(spark, fact, labels, **options):
    frame = versions.filter_versions(fact, labels, "Fact", versioned_model(spark), dims(spark), **options)
    assert frame.columns == fact.columns
    return sorted(r["val"] for r in frame.collect())


def test_no_request_means_all_and_an_empty_one_means_none(spark, fact):
    assert pick(spark, fact, None) == [10, 20, 30, 40, 50]
    assert pick(spark, fact, []) == []


@pytest.mark.parametrize(
    "label, expected",
    [("v1", [10, 20]), ("v2", [20, 30, 40]), ("v3", [20, 40]), ("v5", [40]), ("v6", [50]), ("v10", [50])],
)
def test_one_version(spark, fact, label, expected):
    assert pick(spark, fact, label) == expected
    assert pick(spark, fact, [label, label]) == expected


def test_rows_come_once_per_requested_version(spark, fact):
    assert pick(spark, fact, ["v3", "v2"]) == [20, 20, 30, 40, 40]
    assert pick(spark, fact, ["v3", "v2"], dedupe=True) == [20, 30, 40]


@pytest.mark.parametrize("dedupe", [False, True])
def test_any_number_of_ids_beyond_int(spark, dedupe):
    base = 1 << 40
    ids = spark.range(base, base + 200).selectExpr("id AS VersionID", "concat('v', id) AS Version")
    facts = spark.createDataFrame([(base, base + 150, 1), (base + 190, base + 199, 2)], "f long, t long, x int")
    model = KeyModel(
        {"Fact": facts.schema, "Version": ids.schema}, {"Version": ("VersionID",)},
        (ForeignKey("Fact", "f", "Version", "VersionID", "Version"),),
    )
    labels = [f"v{base + k}" for k in range(100)]
    kept = versions.filter_versions(facts, labels, "Fact", model, {"Version": ids}, from_col="f", to_col="t", dedupe=dedupe)
    assert [r.x for r in kept.collect()] == [1] * (1 if dedupe else 100)
    assert "NestedLoop" not in kept._jdf.queryExecution().executedPlan().toString()


def test_unknown_version(spark, fact):
    with pytest.raises(UnmatchedValues, match="Unknown version_string.*bogus"):
        pick(spark, fact, ["v1", "bogus"])


def test_version_id(spark):
    model, parents = versioned_model(spark), dims(spark)
    assert versions.version_id("v7", "Fact", model, parents) == 7
    with pytest.raises(ValueError, match="exactly one label"):
        versions.version_id(["v1", "v2"], "Fact", model, parents)


def read(spark, fact, *conditions, **options):
    frame = filter_table(
        {"Fact": fact}, "Fact", *conditions, model=versioned_model(spark), dims=dims(spark), **options
    )
    assert frame.columns == fact.columns
    return rows(frame)


def test_filters_apply_to_readable_values(spark, fact):
    everything = read(spark, fact)
    assert ("v1", "v3", "PER", 1990, 20.0) in everything and len(everything) == 5
    assert read(spark, fact, "Country = 'KEN'", versions="v6") == [("v6", "v10", "KEN", 1992, 50.0)]
    assert read(spark, fact, fact["val"] <= 20, "Year >= 1990") == [
        ("v1", "v1", "NZL", 1990, 10.0),
        ("v1", "v3", "PER", 1990, 20.0),
    ]
    assert len(read(spark, fact, "Country IN ('NZL', 'KEN')", versions=["v5", "v2"])) == 3
    assert read(spark, fact, "val = 100", versions="v1") == []
    assert read(spark, fact, "val = 10", versions=[]) == []


COMPRESSIBLE = [
    (1, 1, 1, 1990, 1.0),
    (2, 2, 1, 1990, 1.0),
    (2, 2, 2, 1990, 2.0),
    (3, 3, 2, 1990, 2.0),
    (3, 3, 3, 1991, 7.0),
    (4, 10, 3, 1991, 8.0),
]


def test_compress(spark):
    fact = spark.createDataFrame(COMPRESSIBLE, VERSIONED)
    once = versions.compress_versions(fact)
    assert once.columns == fact.columns
    assert rows(once) == sorted(
        [(1, 2, 1, 1990, 1.0), (2, 3, 2, 1990, 2.0), (3, 3, 3, 1991, 7.0), (4, 10, 3, 1991, 8.0)], key=repr
    )
    assert rows(versions.compress_versions(once)) == rows(once)


def test_compress_bridges_gaps_unless_told_not_to(spark):
    fact = spark.createDataFrame([(1, 1, 1, 1990, 1.0), (3, 4, 1, 1990, 1.0), (5, 5, 1, 1990, 1.0)], VERSIONED)
    assert rows(versions.compress_versions(fact)) == [(1, 5, 1, 1990, 1.0)]
    assert rows(versions.compress_versions(fact, bridge_gaps=False)) == [
        (1, 1, 1, 1990, 1.0),
        (3, 5, 1, 1990, 1.0),
    ]


def test_compress_groups_nulls_and_copies(spark):
    copies = [(1, 2, None, 1990, None)] * 50 + [(2, 3, None, 1990, None)] * 50
    fact = spark.createDataFrame(copies, VERSIONED)
    for bridge in (True, False):
        assert rows(versions.compress_versions(fact, bridge_gaps=bridge)) == [(1, 3, None, 1990, None)]


def test_contained_intervals_stay_one_island(spark):
    fact = spark.createDataFrame([(1, 9, 1, 1990, 1.0), (2, 3, 1, 1990, 1.0), (5, 6, 1, 1990, 1.0)], VERSIONED)
    assert rows(versions.compress_versions(fact, bridge_gaps=False)) == [(1, 9, 1, 1990, 1.0)]


def test_decoded_versions(spark, fact):
    decoded = decode_keys(fact, "Fact", versioned_model(spark), dims(spark))
    assert rows(decoded.select("ValidFromVersion").distinct()) == [("v1",), ("v2",), ("v6",)]
