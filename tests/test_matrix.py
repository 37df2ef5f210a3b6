import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from keyframe.model import ForeignKey, KeyModel
from keyframe.operators import matrix
from keyframe.operators.keys import decode_keys
from keyframe.plans.read import collect_ticket, filter_table
from keyframe.plans.write import upsert
from keyframe.sources.warehouse import Warehouse
from tests.frames import rows

GOOD, TRADE = "Goods", "Trades"
LONG = [
    ("KE", 1971, "U", "g1", "t1", GOOD, TRADE, 11.0),
    ("KE", 1971, "U", "g2", "t2", GOOD, TRADE, 12.0),
    ("KE", 1971, "Y", "g1", "t1", GOOD, TRADE, 13.0),
    ("KE", 1971, "Y", "g2", "t3", GOOD, TRADE, 15.0),
    ("KE", 1971, "V", "t1", "g1", TRADE, GOOD, 16.0),
    ("KE", 1971, "V", "t2", "g2", TRADE, GOOD, 17.0),
    ("PE", 1980, "U", "g1", "t2", GOOD, TRADE, 50.0),
    ("PE", 1980, "Y", "g2", "t2", GOOD, TRADE, 52.0),
]
ENCODED = [
    ("KE", 1971, "U", 1, 1, 11.0),
    ("KE", 1971, "U", 2, 2, 12.0),
    ("KE", 1971, "V", 1, 1, 16.0),
    ("KE", 1971, "V", 2, 2, 17.0),
    ("KE", 1971, "Y", 1, 1, 13.0),
    ("KE", 1971, "Y", 2, 3, 15.0),
    ("PE", 1980, "U", 1, 2, 50.0),
    ("PE", 1980, "Y", 2, 2, 52.0),
]


@pytest.fixture
def long(spark):
    return spark.createDataFrame(
        LONG,
        "Country string, Year int, matname string, rowname string, colname string, "
        "rowtype string, coltype string, value double",
    )


@pytest.fixture
def tidy(long):
    cell = F.struct("rowname", "colname", "value")
    return long.groupBy("Country", "Year", "matname").agg(F.sort_array(F.collect_list(cell)).alias("matval"))


@pytest.fixture
def index_map(spark):
    return {
        TRADE: spark.createDataFrame([(1, "t1"), (2, "t2"), (3, "t3")], "index int, name string"),
        GOOD: spark.createDataFrame([(1, "g1"), (2, "g2")], "index int, name string"),
    }


@pytest.fixture
def rctypes(spark):
    return spark.createDataFrame(
        [("U", GOOD, TRADE), ("V", TRADE, GOOD), ("Y", GOOD, TRADE)], "matname string, rowtype string, coltype string"
    )


def test_encode_every_layout(long, tidy, index_map, rctypes):
    encoded = matrix.encode_matrices(long, index_map)
    assert encoded.columns == ["Country", "Year", "matname", "i", "j", "value"]
    assert rows(encoded) == ENCODED
    assert rows(matrix.encode_matrices(tidy, index_map, rctypes)) == ENCODED
    wide = tidy.groupBy("Country", "Year").pivot("matname", ["U", "V", "Y"]).agg(F.first("matval"))
    assert rows(matrix.encode_matrices(wide, index_map, rctypes)) == ENCODED


def test_long_index_map(long, index_map):
    whole, typed = matrix.index_frame(index_map, "row")
    assert typed and rows(matrix.encode_matrices(long, whole)) == ENCODED


def test_other_frames_are_left_alone(spark, index_map, rctypes):
    frame = spark.range(3)
    assert matrix.encode_matrices(frame, index_map) is frame
    assert matrix.decode_matrices(frame, index_map, rctypes) is frame


def test_round_trip(tidy, index_map, rctypes):
    encoded = matrix.encode_matrices(tidy, index_map, rctypes)
    decoded = matrix.decode_matrices(encoded, index_map, rctypes, wide=False)
    assert decoded.columns == tidy.columns and rows(decoded) == rows(tidy)
    wide = matrix.decode_matrices(encoded, index_map, rctypes, unique_cells=True)
    assert wide.columns == ["Country", "Year", "U", "V", "Y"]
    by_country = {r["Country"]: r for r in wide.collect()}
    assert by_country["PE"]["V"] is None
    assert [tuple(c) for c in by_country["KE"]["V"]] == [("t1", "g1", 16.0), ("t2", "g2", 17.0)]


def test_names_without_grouping(long, index_map, rctypes):
    encoded = matrix.encode_matrices(long, index_map)
    named = matrix.name_cells(encoded, index_map, rctypes)
    assert rows(named) == rows(long.drop("rowtype", "coltype"))


def test_null_matrix_and_null_cell(spark, tidy, index_map, rctypes):
    without = tidy.withColumn("matval", F.when(F.col("matname") != "U", F.col("matval")))
    assert rows(matrix.encode_matrices(without, index_map, rctypes)) == [r for r in ENCODED if r[2] != "U"]
    cell = spark.createDataFrame(
        [("U", "g1", "t1", None), ("U", "g2", "t1", 0.0)],
        "matname string, rowname string, colname string, value double",
    )
    assert rows(matrix.encode_matrices(cell, index_map, rctypes)) == [("U", 1, 1, None)]


def test_missing_names_are_errors(spark, long, index_map, rctypes):
    stranger = long.withColumn("rowname", F.lit("g9"))
    with pytest.raises(PySparkException, match="No row index for 'g9'"):
        matrix.encode_matrices(stranger, index_map).collect()
    encoded = spark.createDataFrame([("U", 9, 1, 1.0)], "matname string, i int, j int, value double")
    with pytest.raises(PySparkException, match="No row name for '9'"):
        matrix.decode_matrices(encoded, index_map, rctypes).collect()
    unknown = spark.createDataFrame([("W", 1, 1, 1.0)], "matname string, i int, j int, value double")
    pair = (index_map[GOOD], index_map[TRADE])
    with pytest.raises(PySparkException, match="No row and column types for matrix 'W'"):
        matrix.decode_matrices(unknown, pair, rctypes).collect()
    with pytest.raises(ValueError, match="pass rctypes"):
        matrix.encode_matrices(long.drop("rowtype"), index_map)


def test_index_map_shape(spark, long):
    with pytest.raises(ValueError, match="one integer and one text column"):
        matrix.encode_matrices(long, {GOOD: spark.range(2), TRADE: spark.range(2)})


def test_one_frame_for_all_types(spark, long, rctypes):
    index = spark.createDataFrame(
        [(1, "g1"), (2, "g2"), (11, "t1"), (12, "t2"), (13, "t3")], "IndexID int, Index string"
    )
    encoded = matrix.encode_matrices(long.drop("rowtype", "coltype"), index)
    assert ("KE", 1971, "V", 11, 1, 16.0) in rows(encoded)
    named = matrix.name_cells(encoded, index)
    assert rows(named) == rows(long.drop("rowtype", "coltype"))


def test_repeated_cells_add_up(spark, index_map, rctypes):
    encoded = spark.createDataFrame([("U", 1, 1, 2.0)] * 1000, "matname string, i int, j int, value double")
    decoded = matrix.decode_matrices(encoded, index_map, rctypes, wide=False).first()["matval"]
    assert [tuple(c) for c in decoded] == [("g1", "t1", 2000.0)]


def test_large_matrices_come_in_tiles(spark, rctypes):
    names = spark.range(1, 31).select(
        F.col("id").cast("int").alias("idx"), F.format_string("n%02d", "id").alias("name")
    )
    cells = spark.range(0, 900).select(
        F.lit("U").alias("matname"),
        (F.floor(F.col("id") / 30) + 1).cast("int").alias("i"),
        (F.col("id") % 30 + 1).cast("int").alias("j"),
        F.col("id").cast("double").alias("value"),
    )
    tiles = matrix.decode_matrices(cells, names, rctypes, wide=False, tile=10)
    found = tiles.collect()
    assert len(found) == 9 and all(len(t["matval"]) == 100 for t in found)
    whole = {(c["rowname"], c["colname"]): c["value"] for t in found for c in t["matval"]}
    assert len(whole) == 900 and whole["n30", "n30"] == 899
    tiled = matrix.decode_matrices(cells, names, rctypes, wide=False, tile=100)
    assert set(tiled.columns) == {"matname", "tile_i", "tile_j", "matval"} and tiled.count() == 1
    one = matrix.decode_matrices(cells, names, rctypes, wide=False)
    assert one.columns == ["matname", "matval"] and len(one.first()["matval"]) == 900


def test_zero_matrices(spark, tmp_path):
    names = ["r1", "r2", "r3"], ["c1", "c2"]
    pair = tuple(
        spark.createDataFrame(list(enumerate(n, 1)), "IndexID int, Index string") for n in names
    )
    zeros = [(r, c, 0.0) for r in names[0] for c in names[1]]
    frame = spark.createDataFrame(
        [("zero1", zeros), ("zero2", zeros)],
        "matname string, matval array<struct<rowname string, colname string, value double>>",
    )
    stored = spark.createDataFrame([], "matname string, i int, j int, value double")
    store = Warehouse(spark, "zero_matrices", str(tmp_path))
    store.create(KeyModel({"Zero": stored.schema}, {"Zero": ("matname", "i", "j")}))
    nothing = upsert(store, frame, "Zero", index_map=pair, in_place=True)
    assert nothing.ticket.count() == 0 and store["Zero"].count() == 0
    kept = upsert(store, frame, "Zero", index_map=pair, retain_zeros=True, in_place=True)
    assert kept.ticket.count() == 1 and store["Zero"].count() == 12
    kinds = spark.createDataFrame(
        [("zero1", "row", "col"), ("zero2", "row", "col")], "matname string, rowtype string, coltype string"
    )
    read = filter_table(
        store, "Zero", model=store.model(), dims={}, matrices=True, index_map=pair, rctypes=kinds
    )
    assert read.columns == ["zero1", "zero2"] and read.count() == 1
    assert [tuple(c) for c in read.first()["zero1"]] == zeros


def test_stored_index_and_types_are_the_defaults(spark, tmp_path):
    """Indices by row/column type on the way in, one index dimension on the way out."""
    index = spark.createDataFrame([(1, "p1"), (2, "p2"), (7, "i1")], "IndexID int, Index string")
    kinds = spark.createDataFrame([(1, "Industry"), (2, "Product")], "RCTypeID int, RCType string")
    matnames = spark.createDataFrame([(1, "U")], "matnameID int, matname string")
    by_type = {
        "Product": spark.createDataFrame([(1, "p1"), (2, "p2")], "ProductID int, Product string"),
        "Industry": spark.createDataFrame([(7, "i1")], "IndustryID int, Industry string"),
    }
    stored = spark.createDataFrame([], "Year int, matname int, i int, j int, value double")
    types = spark.createDataFrame([(1, 2, 1)], "matname int, rowtype int, coltype int")
    dims = {"Index": index, "RCType": kinds, "matname": matnames, **by_type}
    model = KeyModel(
        {"Flow": stored.schema, "matnameRCType": types.schema, **{n: d.schema for n, d in dims.items()}},
        {"Flow": ("Year", "matname", "i", "j"), "matnameRCType": ("matname",)}
        | {n: (d.columns[0],) for n, d in dims.items()},
        (
            ForeignKey("Flow", "matname", "matname", "matnameID", "matname"),
            ForeignKey("matnameRCType", "matname", "matname", "matnameID", "matname"),
            ForeignKey("matnameRCType", "rowtype", "RCType", "RCTypeID", "RCType"),
            ForeignKey("matnameRCType", "coltype", "RCType", "RCTypeID", "RCType"),
        ),
    )
    store = Warehouse(spark, "stored_index", str(tmp_path))
    store.upload_dimensions(model, {**dims, "matnameRCType": types})
    cells = [("p1", "i1", 3.0), ("p2", "i1", 4.0)]
    flows = spark.createDataFrame(
        [(1990, cells)], "Year int, U array<struct<rowname string, colname string, value double>>"
    )
    rctypes = decode_keys(store["matnameRCType"], "matnameRCType", model, dims)
    taken = upsert(store, flows, "Flow", rctypes=rctypes, model=model, dims=dims, in_place=True).ticket
    assert rows(store["Flow"]) == [(1990, 1, 1, 7, 3.0), (1990, 1, 2, 7, 4.0)]
    read = filter_table(store, "Flow", model=model, dims=dims, matrices=True)
    assert read.columns == ["Year", "U"] and [tuple(c) for c in read.first()["U"]] == cells
    fetched = collect_ticket(taken, store, model=model, dims=dims, verify=True)
    assert fetched.collect() == read.collect()
    with pytest.raises(ValueError, match="need an index map"):
        filter_table(store, "Flow", model=model, dims={"matname": matnames}, matrices=True)


def test_long_index_is_gathered_in_tiles(spark, monkeypatch):
    import star_queries

    folder = "/root/testdata/sf0.001"
    whole = rows(star_queries.matrix_decode_long_index(spark, folder))
    monkeypatch.setattr(star_queries, "PART_TILE", 16)
    tiled = star_queries.matrix_decode_long_index(spark, folder)
    assert rows(tiled) == whole and any(row[1].count(",") > 16 for row in whole)
    plan = tiled._jdf.queryExecution().analyzed().toString()
    cells = [line for line in plan.splitlines() if "Aggregate" in line and "collect_list(struct(rowname" in line]
    assert all("tile_i" in line.split("collect_list")[0] for line in cells), cells
    assert "tile_i" in plan
