import pytest
from pyspark.sql import functions as F

from keyframe.model import KeyModel
from keyframe.names import HASH_COL, TABLE_NAME_COL
from keyframe.operators import tickets
from keyframe.operators.constraints import ConstraintViolation
from keyframe.operators.keys import decode_keys
from keyframe.plans.read import collect_ticket, verify_ticket
from tests.frames import VERSIONED, band, dims, rows, versioned_model

PAIRS = "key1 int, key2 int, val string"


@pytest.fixture
def pairs(spark):
    return spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 3, "c")], PAIRS)


def hashes(frame, **options):
    return sorted(r[HASH_COL] for r in tickets.ticket(frame, "T", **options).collect())


def test_single_valued_columns_group_by_default(pairs):
    taken = tickets.ticket(pairs, "T")
    assert taken.columns == [TABLE_NAME_COL, "key1", HASH_COL]
    assert [tuple(r)[:2] for r in taken.collect()] == [("T", 1)]


def test_usual_and_additional_columns(spark):
    frame = spark.createDataFrame([("NZL", 1967, 42.0), ("PER", 1967, 43.0)], "Country string, Year int, Value double")
    usual = tickets.ticket(frame, "T")
    assert usual.columns == [TABLE_NAME_COL, "Country", "Year", HASH_COL] and usual.count() == 2
    named = tickets.ticket(frame, "T", usual=None, additional=["Country", "Year"], keep_single=False)
    assert rows(named) == rows(usual)
    # More group columns than there are.
    assert rows(tickets.ticket(frame, "T", additional=["Country", "Nothing"])) == rows(usual)


def test_every_row_its_own_group(pairs):
    assert tickets.ticket(pairs, "T", additional=["key2"]).count() == 3


def test_something_to_group_by(pairs):
    with pytest.raises(ValueError, match="group columns"):
        tickets.ticket(pairs, "T", usual=None, keep_single=False)
    with pytest.raises(ValueError, match="exactly one table name"):
        tickets.ticket(pairs, ["T", "U"])


def test_an_own_table_name_column_is_replaced(pairs):
    named = pairs.withColumn(TABLE_NAME_COL, F.lit("other"))
    assert rows(tickets.ticket(named, "T")) == rows(tickets.ticket(pairs, "T"))


def test_all_columns_kept_hashes_the_row_count(spark):
    one = spark.createDataFrame([(1,), (1,)], "a int")
    two = spark.createDataFrame([(1,), (1,), (1,)], "a int")
    assert hashes(one) != hashes(two)


def test_no_rows_give_no_ticket(spark):
    assert tickets.ticket(spark.createDataFrame([], PAIRS), "T").count() == 0


def test_order_partitions_and_storage_do_not_matter(spark, pairs, tmp_path):
    expected = hashes(pairs)
    assert hashes(pairs.orderBy(F.desc("key2"))) == expected
    assert hashes(pairs.repartition(7, "val")) == expected
    assert hashes(pairs.select("val", "key1", "key2")) == expected
    pairs.write.parquet(f"{tmp_path}/t")
    assert hashes(spark.read.parquet(f"{tmp_path}/t"), probe_rows=2) == expected


@pytest.mark.parametrize(
    "first, second",
    [
        ([("a", "b")], [("b", "a")]),
        ([("a", None)], [(None, "a")]),
        ([("a", "")], [("a", None)]),
        ([("a;=b", "c")], [("a", "b;=c")]),
        ([("a\\", ";b")], [("a", "\\;b")]),
        ([("~", "x")], [(None, "x")]),
        ([("a", "b"), ("a", "b")], [("a", "b")]),
        ([("a", "b"), ("c", "d")], [("a", "d"), ("c", "b")]),
    ],
)
@pytest.mark.parametrize("algorithm", ["md5", "xxhash64"])
def test_different_content_differs(spark, first, second, algorithm):
    # A third column keeps the others from becoming group columns.
    def frame(cells):
        varying = [(0, "x", "y"), (1, "u", "v")]
        return spark.createDataFrame(varying + [(2, *c) for c in cells], "n int, p string, q string")

    options = {"usual": ["none"], "keep_single": False, "algorithm": algorithm}
    assert hashes(frame(first), **options) != hashes(frame(second), **options)


def test_column_names_are_content(pairs):
    renamed = pairs.withColumnRenamed("val", "value")
    assert hashes(pairs) != hashes(renamed)


def test_algorithms(pairs):
    lengths = {"xxhash64": 32, "md5": 32, "sha1": 40, "sha256": 64, "sha512": 128}
    for name, length in lengths.items():
        (one,) = hashes(pairs, algorithm=name)
        assert len(one) == length and [one] == hashes(pairs.repartition(3), algorithm=name)
    with pytest.raises(ValueError, match="Unknown hash algorithm"):
        hashes(pairs, algorithm="crc")


def test_widths_of_numbers_do_not_matter(spark):
    narrow = spark.createDataFrame([(1, 1.5), (2, 2.5)], "n int, x float")
    wide = spark.createDataFrame([(1, 1.5), (2, 2.5)], "n long, x double")
    assert hashes(narrow) == hashes(wide)


@pytest.mark.parametrize("algorithm", ["md5", "xxhash64"])
def test_kinds_of_cells(spark, algorithm):
    frame = spark.sql(
        "SELECT id, cast(id AS double) / 3 AS x, date'2020-01-01' + cast(id AS int) AS d, "
        "timestamp'2020-01-01 10:00:00' AS t, array(id, NULL) AS a, struct(id AS k) AS s, "
        "cast('bin' AS binary) AS b, id > 2 AS f FROM range(5)"
    )
    assert hashes(frame, algorithm=algorithm) == hashes(frame.repartition(3), algorithm=algorithm)
    changed = frame.withColumn("a", F.array(F.col("id"), F.lit(0).cast("long")))
    assert hashes(frame, algorithm=algorithm) != hashes(changed, algorithm=algorithm)
    zero = spark.createDataFrame([(0.0, 1), (1.0, 2)], "x double, n int")
    minus = spark.createDataFrame([(-0.0, 1), (1.0, 2)], "x double, n int")
    assert hashes(zero, algorithm=algorithm) == hashes(minus, algorithm=algorithm)


def test_single_value_columns(spark):
    frame = spark.createDataFrame(
        [(1, None, "x", 1.0), (1, None, None, float("nan")), (1, None, "x", 1.0)],
        "one int, none string, half string, x double",
    )
    assert tickets.single_value_columns(frame) == ["one", "none"]
    assert tickets.single_value_columns(frame, probe_rows=1) == ["one", "none"]
    assert tickets.single_value_columns(frame, probe_rows=100) == ["one", "none"]
    assert tickets.single_value_columns(frame.limit(0)) == []
    assert tickets.single_value_columns(frame.limit(0), probe_rows=5) == []


def test_collect(spark, pairs):
    more = spark.createDataFrame([(2, 1, "d"), (2, 2, "e")], PAIRS)
    stored = {"T": pairs.unionByName(more)}
    model = KeyModel({"T": pairs.schema}, {"T": ("key1", "key2")})

    def fetch(ticket, **options):
        return collect_ticket(ticket, stored, model=model, dims={}, **options)

    assert rows(fetch(tickets.ticket(pairs, "T"))) == rows(pairs)
    assert rows(fetch(tickets.ticket(more, "T"), verify=True)) == rows(more)
    by_row = tickets.ticket(pairs, "T", additional=["key2"])
    assert rows(fetch(by_row.filter("key2 > 1"))) == rows(pairs.filter("key2 > 1"))
    named = fetch(by_row, keep_table_name=True)
    assert named.columns == [TABLE_NAME_COL, "key1", "key2", "val"]
    assert fetch(by_row.filter("key2 > 5")) is None
    # A ticket without group columns stands for the whole table.
    whole = tickets.ticket(stored["T"], "T", usual=["none"], keep_single=False)
    assert whole.columns == [TABLE_NAME_COL, HASH_COL]
    assert rows(fetch(whole)) == rows(stored["T"])
    with pytest.raises(ValueError, match="More than 1 table"):
        fetch(by_row.unionByName(by_row.withColumn(TABLE_NAME_COL, F.lit("U"))))


def test_null_group_values_are_found_again(spark):
    frame = spark.createDataFrame([(None, 1), (None, 2), (5, 3)], "Year int, n int")
    model = KeyModel({"T": frame.schema})
    taken = tickets.ticket(frame, "T").filter("Year IS NULL")
    assert rows(collect_ticket(taken, {"T": frame}, model=model, dims={})) == [(None, 1), (None, 2)]


def test_verify(spark, pairs):
    model = KeyModel({"T": pairs.schema}, {"T": ("key1", "key2")})
    taken = tickets.ticket(pairs, "T", additional=["key2"])
    changed = pairs.withColumn("val", F.when(F.col("key2") == 2, "z").otherwise(F.col("val")))
    assert [r["key2"] for r in verify_ticket(taken, changed, "T").collect()] == [2]
    with pytest.raises(ConstraintViolation, match="differs from what the ticket describes"):
        collect_ticket(taken, {"T": changed}, model=model, dims={}, verify=True)


def test_collect_readable_rows_and_versions(spark):
    stored = {
        "Fact": spark.createDataFrame([(1, 1, 1, 1990, 1.0), (1, 2, 2, 1991, 2.0), (3, 3, 2, 1991, 3.0)], VERSIONED)
    }
    model, parents = versioned_model(spark), dims(spark)
    readable = decode_keys(stored["Fact"], "Fact", model, parents)
    taken = tickets.ticket(readable, "Fact")
    options = {"model": model, "dims": parents}
    assert rows(collect_ticket(taken, stored, verify=True, **options)) == rows(readable)
    assert rows(collect_ticket(taken, stored, decode=False, **options)) == rows(stored["Fact"])
    assert rows(collect_ticket(taken, stored, versions="v2", **options)) == [("v1", "v2", "PER", 1991, 2.0)]
    part = taken.filter("Country = 'PER'")
    assert collect_ticket(part, stored, **options).count() == 2
    with pytest.raises(ValueError, match="cannot be verified"):
        collect_ticket(taken, stored, versions="v2", verify=True, **options)


def test_task_group(spark):
    model, parents = band(spark)
    stored = {"PlayerPart": spark.createDataFrame([(1, 2), (2, 3)], "Player int, Part int")}
    readable = spark.createDataFrame(
        [("Ana", "Viola", 7), ("Bo", "Cello", 7)], "Player string, Part string, tar_group int"
    )
    taken = tickets.ticket(readable, "PlayerPart")
    fetched = collect_ticket(taken, stored, model=model, dims=parents)
    assert rows(fetched) == [("Ana", "Viola", 7), ("Bo", "Cello", 7)]
    without = collect_ticket(taken, stored, model=model, dims=parents, set_task_group=False)
    assert without.columns == ["Player", "Part"]
    mixed = taken.unionByName(taken.withColumn("tar_group", F.lit(8)))
    with pytest.raises(ValueError, match="More than 1 value of 'tar_group'"):
        collect_ticket(mixed, stored, model=model, dims=parents)
