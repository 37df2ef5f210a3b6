"""Every operator of keyframe as a query over the star-schema test tables.

``QUERIES`` maps a name to a function ``(spark, folder) -> DataFrame`` and
``ORACLES`` the same name to SQL that gives the same rows.  Queries with an entry
in both are compared cell by cell.

The tables become a key model like this: ``nation`` and ``region`` are
dimensions; a small ``release`` dimension holds the version labels v1..v10; and
every order is valid from the release of its year on, for up to three releases.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyframe import refdata
from keyframe.functions.casting import apply_types, cast_losses
from keyframe.functions.numeric import round_double_cols
from keyframe.model import ForeignKey, KeyModel
from keyframe.names import COUNTRY_COL
from keyframe.operators import constraints, filters, keys, matrix, tickets, upsert, versions
from keyframe.plans import read, write
from keyframe.sources.snapshots import read_release, read_snapshot, release_snapshot, snapshot_versions
from keyframe.sources.storage import scratch_dir, stage
from keyframe.sources.tables import load_dimensions, load_schema_table
from keyframe.sources.warehouse import Warehouse

QUERIES = {}
ORACLES = {}


def query(sql: str | None = None):
    """Register a query under its function name, with its SQL if there is any."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


# Input frames


_SCHEMAS = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    path = f"{folder}/{name}.parquet"
    if path not in _SCHEMAS:
        # Remembered, since reading it from the file footer takes a job.
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def cents(column: str):
    return F.round(F.col(column) * 100).cast("bigint")


def orders_v(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the interval of releases in which they are valid."""
    first = F.year("o_orderdate") - 1994
    last = (first + F.col("o_orderkey") % 3).cast("int")
    return table(spark, folder, "orders").withColumns({"vfrom": first, "vto": last})


ORDERS_V = """orders_v AS (
  SELECT *, year(o_orderdate) - 1994 AS vfrom,
         CAST(year(o_orderdate) - 1994 + o_orderkey % 3 AS INT) AS vto
  FROM orders)"""


def releases(spark: SparkSession) -> DataFrame:
    ids = spark.range(1, 11).select(F.col("id").cast("int").alias("ReleaseID"))
    return ids.withColumn("Release", F.concat(F.lit("v"), F.col("ReleaseID").cast("string")))


def sales(spark: SparkSession, folder: str) -> DataFrame:
    """Orders by nation and year, keys encoded."""
    orders = orders_v(spark, folder)
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("OrderID"),
        F.col("c_nationkey").alias("Country"),
        F.year("o_orderdate").alias("Year"),
        F.col("o_orderpriority").alias("Method"),
        F.col("vfrom").alias("ValidFromVersion"),
        F.col("vto").alias("ValidToVersion"),
        cents("o_totalprice").alias("Cents"),
    )


SALES = f"""{ORDERS_V},
sales AS (
  SELECT o_orderkey AS "OrderID", c_nationkey AS "Country", CAST(year(o_orderdate) AS INT) AS "Year",
         o_orderpriority AS "Method", CAST(vfrom AS INT) AS "ValidFromVersion",
         vto AS "ValidToVersion", CAST(round(o_totalprice * 100) AS BIGINT) AS "Cents"
  FROM orders_v JOIN customer ON o_custkey = c_custkey)"""


def star_model(spark: SparkSession, folder: str) -> KeyModel:
    names = ("nation", "region", "customer", "supplier")
    structs = {n: table(spark, folder, n).schema for n in names}
    structs["release"] = releases(spark).schema
    structs["orders_v"] = orders_v(spark, folder).schema
    structs["sales"] = sales(spark, folder).schema
    foreign = (
        ForeignKey("customer", "c_nationkey", "nation", "n_nationkey", "n_name"),
        ForeignKey("supplier", "s_nationkey", "nation", "n_nationkey", "n_name"),
        ForeignKey("nation", "n_regionkey", "region", "r_regionkey", "r_name"),
        ForeignKey("orders_v", "vfrom", "release", "ReleaseID", "Release"),
        ForeignKey("orders_v", "vto", "release", "ReleaseID", "Release"),
        ForeignKey("sales", "Country", "nation", "n_nationkey", "n_name"),
        ForeignKey("sales", "ValidFromVersion", "release", "ReleaseID", "Release"),
        ForeignKey("sales", "ValidToVersion", "release", "ReleaseID", "Release"),
    )
    primary = {
        "nation": ("n_nationkey",),
        "region": ("r_regionkey",),
        "release": ("ReleaseID",),
        "customer": ("c_custkey",),
        "supplier": ("s_suppkey",),
        "orders_v": ("o_orderkey",),
        "sales": ("OrderID",),
    }
    return KeyModel(structs, primary, foreign)


def star_dims(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "nation": table(spark, folder, "nation"),
        "region": table(spark, folder, "region"),
        "release": releases(spark),
    }


def new_store(spark: SparkSession) -> Warehouse:
    name = f"keyframe_{uuid.uuid4().hex[:12]}"
    return Warehouse(spark, name, f"{scratch_dir(spark)}/{name}")


def sub_model(model: KeyModel, *names: str) -> KeyModel:
    return KeyModel(
        {n: model.structs[n] for n in names},
        {n: model.primary_keys[n] for n in names if n in model.primary_keys},
        tuple(fk for fk in model.foreign_keys if fk.table in names),
    )


def sales_store(spark: SparkSession, folder: str, **options) -> Warehouse:
    """A store with the sales table, its dimensions, and an empty copy of it."""
    model = sub_model(star_model(spark, folder), "region", "nation", "release", "sales")
    copied = tuple(
        ForeignKey("sales_copy", fk.column, fk.parent, fk.parent_key, fk.parent_value)
        for fk in model.foreign_keys_of("sales")
    )
    model = KeyModel(
        {**model.structs, "sales_copy": model.structs["sales"]},
        {**model.primary_keys, "sales_copy": ("OrderID",)},
        model.foreign_keys + copied,
    )
    store = new_store(spark)
    store.upload_dimensions(model, star_dims(spark, folder), **options)
    store.replace("sales", sales(spark, folder))
    return store


# Typing


RAW_SCHEMA = [
    ("OrderID", True, "int"),
    ("Total", False, "double precision"),
    ("Placed", False, "date"),
    ("Final", False, "boolean"),
    ("Priority", False, "text"),
]


def raw_orders(spark: SparkSession, folder: str) -> tuple[DataFrame, KeyModel]:
    """Orders as text with cells that do not parse, and the schema they should have."""
    raw = table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("OrderID"),
        F.when(F.col("o_orderstatus") == "P", "pending")
        .otherwise(F.round("o_totalprice").cast("bigint").cast("string"))
        .alias("Total"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "soon")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("Placed"),
        F.when(F.col("o_orderstatus") == "F", "TRUE")
        .when(F.col("o_orderstatus") == "O", "FALSE")
        .otherwise(F.col("o_orderstatus"))
        .alias("Final"),
        F.col("o_orderpriority").alias("Priority"),
    )
    rows = [
        {"Table": "Order", "Colname": c, "IsPK": pk, "ColDataType": t, "FKTable": "NA", "FKColname": "NA"}
        for c, pk, t in RAW_SCHEMA
    ]
    return raw, KeyModel.from_schema_table(rows)


@query("""
SELECT CAST(o_orderkey AS INT) AS "OrderID",
       CASE WHEN o_orderstatus <> 'P' THEN round(o_totalprice) END AS "Total",
       CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST(o_orderdate AS DATE) END AS "Placed",
       CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS "Final",
       o_orderpriority AS "Priority"
FROM orders
""")
def typed_dimension(spark, folder):
    raw, model = raw_orders(spark, folder)
    return apply_types(raw, model.struct("Order"))


@query("""
SELECT CAST(0 AS BIGINT) AS "OrderID",
       count(*) FILTER (o_orderstatus = 'P') AS "Total",
       count(*) FILTER (o_orderpriority = '1-URGENT') AS "Placed",
       count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS "Final",
       CAST(0 AS BIGINT) AS "Priority"
FROM orders
""")
def typing_losses(spark, folder):
    raw, model = raw_orders(spark, folder)
    return cast_losses(raw, model.struct("Order"))


@query("""
SELECT 'supplier' AS name, s_suppkey AS id, s_name AS label, s_nationkey AS parent FROM supplier
UNION ALL SELECT 'nation', n_nationkey, n_name, n_regionkey FROM nation
""")
def load_dimensions_typed(spark, folder):
    """The schema table and two dimensions, written as CSV and loaded with their declared types."""
    root = f"{scratch_dir(spark)}/tables-{uuid.uuid4().hex[:8]}"
    types = {"bigint": "int", "int": "int", "string": "text", "double": "double precision"}
    listed = []
    for name, parent in (("nation", ("n_regionkey", "region", "r_regionkey")), ("supplier", ("s_nationkey", "nation", "n_nationkey"))):
        frame = table(spark, folder, name)
        frame.write.options(header=True).csv(f"{root}/{name}.csv")
        for n, (column, kind) in enumerate(frame.dtypes):
            to = parent[1:] if column == parent[0] else ("NA", "NA")
            listed.append((name, column, str(n == 0).upper(), types[kind], *to))
    for column, kind in table(spark, folder, "region").dtypes:
        listed.append(("region", column, str(column == "r_regionkey").upper(), types[kind], "NA", "NA"))
    header = "Table string, Colname string, IsPK string, ColDataType string, FKTable string, FKColname string"
    spark.createDataFrame(listed, header).write.options(header=True).csv(f"{root}/Schema.csv")
    model = KeyModel.from_schema_table(load_schema_table(spark, f"{root}/Schema.csv"))
    dims = load_dimensions(spark, root, model)
    columns = {"supplier": ("s_suppkey", "s_name", "s_nationkey"), "nation": ("n_nationkey", "n_name", "n_regionkey")}
    parts = [
        dims[name].select(F.lit(name).alias("name"), F.col(i).cast("bigint").alias("id"), F.col(n).alias("label"), F.col(p).alias("parent"))
        for name, (i, n, p) in columns.items()
    ]
    return parts[0].unionByName(parts[1])


# Constraints


@query("""
SELECT 'c_nationkey' AS "column", count(*) FILTER (c_nationkey = 3) AS nulls FROM customer
""")
def not_null_report(spark, folder):
    rows = table(spark, folder, "customer").withColumn(
        "c_nationkey", F.nullif(F.col("c_nationkey"), F.lit(3))
    )
    return constraints.foreign_key_nulls(rows, "customer", star_model(spark, folder))


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS rows
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def pk_duplicates(spark, folder):
    return constraints.duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
WITH kept AS (SELECT * FROM nation WHERE n_regionkey <> 2),
keys AS (
  SELECT 'c_nationkey' AS "column", c_nationkey AS k FROM customer
  UNION ALL SELECT 's_nationkey', s_nationkey FROM supplier)
SELECT "column", 'nation' AS parent, CAST(k AS VARCHAR) AS value, count(*) AS rows
FROM keys WHERE NOT EXISTS (SELECT 1 FROM kept WHERE n_nationkey = k)
GROUP BY 1, 2, 3
""")
def fk_orphans(spark, folder):
    model = star_model(spark, folder)
    dims = {"nation": table(spark, folder, "nation").filter("n_regionkey <> 2")}
    customers = constraints.orphan_keys(table(spark, folder, "customer"), "customer", model, dims)
    suppliers = constraints.orphan_keys(table(spark, folder, "supplier"), "supplier", model, dims)
    return customers.unionByName(suppliers)


@query("""
WITH keys AS (
  SELECT 'l_orderkey' AS "column", 'orders' AS parent, l_orderkey AS k, l_orderkey % 3 = 0 AS gone FROM lineitem
  UNION ALL SELECT 'l_partkey', 'part', l_partkey, l_partkey % 5 = 0 FROM lineitem
  UNION ALL SELECT 'l_suppkey', 'supplier', l_suppkey, l_suppkey % 7 = 0 FROM lineitem),
known AS (
  SELECT 'orders' AS parent, o_orderkey AS k FROM orders UNION ALL SELECT 'part', p_partkey FROM part
  UNION ALL SELECT 'supplier', s_suppkey FROM supplier)
SELECT "column", parent, CAST(k AS VARCHAR) AS value, count(*) AS rows FROM keys
WHERE gone OR NOT EXISTS (SELECT 1 FROM known WHERE known.parent = keys.parent AND known.k = keys.k) GROUP BY 1, 2, 3
""")
def fk_orphans_many(spark, folder):
    """Three foreign keys of one table, checked in one pass."""
    items = table(spark, folder, "lineitem")
    parents = {
        "orders": ("l_orderkey", "o_orderkey", "o_orderkey % 3 <> 0"),
        "part": ("l_partkey", "p_partkey", "p_partkey % 5 <> 0"),
        "supplier": ("l_suppkey", "s_suppkey", "s_suppkey % 7 <> 0"),
    }
    dims = {parent: table(spark, folder, parent).filter(kept) for parent, (_, _, kept) in parents.items()}
    model = KeyModel(
        {"lineitem": items.schema, **{p: d.schema for p, d in dims.items()}},
        {p: (key,) for p, (_, key, _) in parents.items()},
        tuple(ForeignKey("lineitem", c, p, key, key) for p, (c, key, _) in parents.items()),
    )
    return constraints.orphan_keys(items, "lineitem", model, dims)


# Key codec


@query(f"""
WITH {SALES}
SELECT "OrderID", n_name AS "Country", "Year", "Method", f."Release" AS "ValidFromVersion",
       t."Release" AS "ValidToVersion", "Cents"
FROM sales LEFT JOIN nation ON "Country" = n_nationkey
LEFT JOIN (SELECT range AS id, 'v' || range AS "Release" FROM range(1, 11)) f ON "ValidFromVersion" = f.id
LEFT JOIN (SELECT range AS id, 'v' || range AS "Release" FROM range(1, 11)) t ON "ValidToVersion" = t.id
""")
def decode_keys(spark, folder):
    return keys.decode_keys(
        sales(spark, folder), "sales", star_model(spark, folder), star_dims(spark, folder)
    )


@query("""
SELECT c_custkey, n_nationkey AS c_nationkey, c_mktsegment
FROM customer JOIN nation ON n_name = 'NATION_' || (c_custkey % 25)
""")
def encode_keys(spark, folder):
    named = table(spark, folder, "customer").select(
        "c_custkey",
        F.concat(F.lit("NATION_"), (F.col("c_custkey") % 25).cast("string")).alias("c_nationkey"),
        "c_mktsegment",
    )
    return keys.encode_keys(named, "customer", star_model(spark, folder), star_dims(spark, folder))


@query("""
SELECT 'c_nationkey' AS "column", 'nation' AS parent, name AS value, count(*) AS rows
FROM (SELECT 'NATION_' || (c_custkey % 30) AS name FROM customer)
WHERE name NOT IN (SELECT n_name FROM nation) GROUP BY name
""")
def encode_unmatched(spark, folder):
    named = table(spark, folder, "customer").withColumn(
        "c_nationkey", F.concat(F.lit("NATION_"), (F.col("c_custkey") % 30).cast("string"))
    )
    return keys.unmatched_values(named, "customer", star_model(spark, folder), star_dims(spark, folder))


@query("""
SELECT s_suppkey, n_nationkey AS name FROM supplier JOIN nation ON n_name = 'NATION_' || s_nationkey
""")
def encode_value_column(spark, folder):
    named = table(spark, folder, "supplier").select(
        "s_suppkey", F.concat(F.lit("NATION_"), F.col("s_nationkey").cast("string")).alias("name")
    )
    dim = table(spark, folder, "nation")
    return keys.encode_column(named, "name", dim, key="n_nationkey", value="n_name")


@query("SELECT s_suppkey, n_name AS s_nationkey FROM supplier JOIN nation ON n_nationkey = s_nationkey")
def decode_key_column(spark, folder):
    coded = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    dim = table(spark, folder, "nation")
    return keys.decode_column(coded, "s_nationkey", dim, key="n_nationkey", value="n_name")


@query(f"""
WITH {ORDERS_V} SELECT o_orderkey, CAST(vto AS INT) AS label FROM orders_v
""")
def version_ids(spark, folder):
    labelled = orders_v(spark, folder).select(
        "o_orderkey", F.concat(F.lit("v"), F.col("vto").cast("string")).alias("label")
    )
    model, dims = star_model(spark, folder), star_dims(spark, folder)
    return versions.encode_versions(labelled, "label", "orders_v", model, dims, from_col="vfrom")


# Versions


def _of_versions(spark, folder, labels, **options):
    return versions.filter_versions(
        orders_v(spark, folder),
        labels,
        "orders_v",
        star_model(spark, folder),
        star_dims(spark, folder),
        from_col="vfrom",
        to_col="vto",
        **options,
    ).select("o_orderkey", "o_custkey", "vfrom", "vto")


_VERSION_COLS = "o_orderkey, o_custkey, CAST(vfrom AS INT) AS vfrom, vto"


@query(f"WITH {ORDERS_V} SELECT {_VERSION_COLS} FROM orders_v WHERE vfrom <= 3 AND vto >= 3")
def version_one(spark, folder):
    return _of_versions(spark, folder, "v3")


@query(f"""
WITH {ORDERS_V}
SELECT {_VERSION_COLS} FROM orders_v WHERE vfrom <= 3 AND vto >= 3
UNION ALL SELECT {_VERSION_COLS} FROM orders_v WHERE vfrom <= 4 AND vto >= 4
UNION ALL SELECT {_VERSION_COLS} FROM orders_v WHERE vfrom <= 7 AND vto >= 7
""")
def version_many(spark, folder):
    return _of_versions(spark, folder, ["v4", "v3", "v7", "v4"])


def _hundred(spark, folder, **options):
    """Orders valid for up to 20 of 120 releases each, in any of the first hundred."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        (F.col("o_orderkey") % 95 + 1).cast("int").alias("vfrom"),
        (F.col("o_orderkey") % 95 + 1 + F.col("o_custkey") % 20).cast("int").alias("vto"),
    )
    ids = spark.range(1, 121).select(F.col("id").cast("int").alias("ReleaseID"))
    ids = ids.withColumn("Release", F.concat(F.lit("v"), F.col("ReleaseID").cast("string")))
    model = KeyModel(
        {"orders": orders.schema, "release": ids.schema},
        {"orders": ("o_orderkey",), "release": ("ReleaseID",)},
        tuple(ForeignKey("orders", c, "release", "ReleaseID", "Release") for c in ("vfrom", "vto")),
    )
    labels = [f"v{k}" for k in range(1, 101)]
    return versions.filter_versions(
        orders, labels, "orders", model, {"release": ids}, from_col="vfrom", to_col="vto", **options
    )


_HUNDRED = """orders_of AS (
  SELECT o_orderkey, CAST(o_orderkey % 95 + 1 AS INT) AS vfrom,
         CAST(o_orderkey % 95 + 1 + o_custkey % 20 AS INT) AS vto FROM orders)"""


@query(f"""
WITH {_HUNDRED}
SELECT orders_of.* FROM orders_of JOIN range(1, 101) AS v(id) ON vfrom <= v.id AND vto >= v.id
""")
def version_hundred(spark, folder):
    return _hundred(spark, folder)


@query(f"WITH {_HUNDRED} SELECT * FROM orders_of WHERE vfrom <= 100 AND vto >= 1")
def version_hundred_once(spark, folder):
    return _hundred(spark, folder, dedupe=True)


@query(f"""
WITH {ORDERS_V}
SELECT {_VERSION_COLS} FROM orders_v
WHERE (vfrom <= 3 AND vto >= 3) OR (vfrom <= 4 AND vto >= 4) OR (vfrom <= 7 AND vto >= 7)
""")
def version_many_once(spark, folder):
    return _of_versions(spark, folder, ["v3", "v4", "v7"], dedupe=True)


@query(f"WITH {ORDERS_V} SELECT {_VERSION_COLS} FROM orders_v WHERE false")
def version_none(spark, folder):
    return _of_versions(spark, folder, [])


def _status_history(spark, folder):
    return orders_v(spark, folder).select("o_custkey", "o_orderstatus", "o_orderpriority", "vfrom", "vto")


@query(f"""
WITH {ORDERS_V}
SELECT o_custkey, o_orderstatus, o_orderpriority, CAST(min(vfrom) AS INT) AS vfrom, max(vto) AS vto
FROM orders_v GROUP BY o_custkey, o_orderstatus, o_orderpriority
""")
def compress_versions(spark, folder):
    return versions.compress_versions(_status_history(spark, folder), from_col="vfrom", to_col="vto")


@query(f"""
WITH {ORDERS_V},
marked AS (
  SELECT o_custkey, o_orderstatus, o_orderpriority, vfrom, vto,
    CASE WHEN vfrom <= 1 + max(vto) OVER (
      PARTITION BY o_custkey, o_orderstatus, o_orderpriority ORDER BY vfrom, vto, o_orderkey
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opens, o_orderkey
  FROM orders_v),
islands AS (
  SELECT *, sum(opens) OVER (
    PARTITION BY o_custkey, o_orderstatus, o_orderpriority ORDER BY vfrom, vto, o_orderkey
    ROWS UNBOUNDED PRECEDING) AS island
  FROM marked)
SELECT o_custkey, o_orderstatus, o_orderpriority, CAST(min(vfrom) AS INT) AS vfrom, max(vto) AS vto
FROM islands GROUP BY o_custkey, o_orderstatus, o_orderpriority, island
""")
def compress_keep_gaps(spark, folder):
    return versions.compress_versions(
        _status_history(spark, folder), from_col="vfrom", to_col="vto", bridge_gaps=False
    )


# Rounding


def _signif_sql(x: str, digits: int) -> str:
    e = f"({digits} - 1 - floor(log10(abs({x}))))"
    return (
        f"CASE WHEN {x} IS NULL OR {x} = 0 THEN {x} "
        f"WHEN {e} >= 0 THEN round_even({x} * pow(10.0, {e}), 0) / pow(10.0, {e}) "
        f"ELSE round_even({x} / pow(10.0, -{e}), 0) * pow(10.0, -{e}) END"
    )


@query(f"""
WITH priced AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
         l_extendedprice * (1 - l_discount) AS net, l_extendedprice / 7 * 1e6 AS large, l_tax / 9 AS small
  FROM lineitem)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {_signif_sql("net", 4)} AS net,
       {_signif_sql("large", 4)} AS large, {_signif_sql("small", 4)} AS small
FROM priced
""")
def round_signif(spark, folder):
    priced = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"),
        (F.col("l_extendedprice") / 7 * F.lit(1e6)).alias("large"),
        (F.col("l_tax") / 9).alias("small"),
    )
    return round_double_cols(priced, 4)


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice AS price, l_quantity AS quantity FROM lineitem
""")
def round_signif_default(spark, folder):
    """Noise in the sixteenth digit goes at the default of fifteen."""
    noisy = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        (F.col("l_extendedprice") * (1 + 2e-16)).alias("price"), (F.col("l_quantity") * (1 - 2e-16)).alias("quantity"),
    )
    return round_double_cols(noisy)


# Upserts


def _order_balances(spark, folder):
    """Order totals per customer number, doubled so that about half the numbers are new."""
    return (
        table(spark, folder, "orders")
        .groupBy((F.col("o_custkey") * 2).alias("c_custkey"))
        .agg(F.sum(cents("o_totalprice")).alias("balance"))
    )


def _customer_balances(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", cents("c_acctbal").alias("balance")
    )


BALANCES = """fresh AS (
  SELECT o_custkey * 2 AS c_custkey, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS balance
  FROM orders GROUP BY 1),
base AS (
  SELECT c_custkey, c_name, c_mktsegment, CAST(round(c_acctbal * 100) AS BIGINT) AS balance FROM customer)"""


@query(f"""
WITH {BALANCES}
SELECT coalesce(f.c_custkey, b.c_custkey) AS c_custkey,
       CASE WHEN f.c_custkey IS NULL THEN b.c_name ELSE 'Customer ' || f.c_custkey END AS c_name,
       CASE WHEN f.c_custkey IS NULL THEN b.c_mktsegment ELSE 'ORDERED' END AS c_mktsegment,
       CASE WHEN f.c_custkey IS NULL THEN b.balance ELSE f.balance END AS balance
FROM base b FULL JOIN fresh f ON b.c_custkey = f.c_custkey
""")
def upsert_rows(spark, folder):
    rows = _order_balances(spark, folder).select(
        "c_custkey",
        F.concat(F.lit("Customer "), F.col("c_custkey").cast("string")).alias("c_name"),
        F.lit("ORDERED").alias("c_mktsegment"),
        "balance",
    )
    return upsert.merge_rows(_customer_balances(spark, folder), rows, ["c_custkey"])


@query(f"""
WITH {BALANCES}
SELECT coalesce(f.c_custkey, b.c_custkey) AS c_custkey, b.c_name, b.c_mktsegment,
       coalesce(f.balance, b.balance) AS balance
FROM base b FULL JOIN fresh f ON b.c_custkey = f.c_custkey
""")
def upsert_some_columns(spark, folder):
    return upsert.merge_rows(
        _customer_balances(spark, folder), _order_balances(spark, folder), ["c_custkey"]
    )


def _account_store(spark, folder, **options):
    """Accounts per customer and release, uploaded from the customers for release v1."""
    nation = table(spark, folder, "nation")
    accounts = table(spark, folder, "customer").select(
        F.lit("v1").alias("ValidFromVersion"),
        F.lit("v1").alias("ValidToVersion"),
        F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("Country"),
        F.col("c_custkey").alias("Account"),
        F.col("c_acctbal").alias("Balance"),
    )
    model = KeyModel(
        {
            "nation": nation.schema,
            "release": releases(spark).schema,
            "account": accounts.select(
                F.lit(1).alias("ValidFromVersion"),
                F.lit(1).alias("ValidToVersion"),
                F.lit(1).alias("Country"),
                "Account",
                "Balance",
            ).schema,
        },
        {
            "nation": ("n_nationkey",),
            "release": ("ReleaseID",),
            "account": ("ValidFromVersion", "ValidToVersion", "Country", "Account"),
        },
        (
            ForeignKey("account", "ValidFromVersion", "release", "ReleaseID", "Release"),
            ForeignKey("account", "ValidToVersion", "release", "ReleaseID", "Release"),
            ForeignKey("account", "Country", "nation", "n_nationkey", "n_name"),
        ),
    )
    store = new_store(spark)
    store.upload_dimensions(model, {"nation": nation, "release": releases(spark)}, **options)
    return store, accounts


def _second_release(accounts):
    """The same accounts in release v2, each with a tiny error in its balance."""
    return accounts.withColumns(
        {
            "ValidFromVersion": F.lit("v2"),
            "ValidToVersion": F.lit("v2"),
            "Balance": F.col("Balance") + F.lit(1e-9),
        }
    )


@query("""
SELECT 1 AS "ValidFromVersion", 1 AS "ValidToVersion", c_nationkey AS "Country",
       c_custkey AS "Account", c_acctbal AS "Balance" FROM customer
UNION ALL
SELECT 2, 2, c_nationkey, c_custkey, c_acctbal FROM customer
""")
def upsert_full(spark, folder):
    store, accounts = _account_store(spark, folder, partition_by={"account": ["Country"]})
    write.upsert(store, accounts, "account", in_place=True)
    return write.upsert(
        store, _second_release(accounts), "account", in_place=True, round_doubles=True, digits=8
    ).table


@query("""
SELECT 1 AS "ValidFromVersion", 2 AS "ValidToVersion", c_nationkey AS "Country",
       c_custkey AS "Account", c_acctbal AS "Balance" FROM customer
""")
def upsert_compressed(spark, folder):
    store, accounts = _account_store(spark, folder)
    options = {"in_place": True, "round_doubles": True, "digits": 8}
    write.upsert(store, accounts, "account", **options)
    return write.upsert(store, _second_release(accounts), "account", compress=True, **options).table


@query("""
SELECT 1 AS "ValidFromVersion", 1 AS "ValidToVersion", c_nationkey AS "Country",
       c_custkey AS "Account", c_acctbal AS "Balance" FROM customer
""")
def upsert_preview(spark, folder):
    store, accounts = _account_store(spark, folder)
    return write.upsert(store, accounts, "account").table


@query("""
SELECT 'nation' AS parent, n_nationkey AS id, n_name AS name FROM nation
UNION ALL SELECT 'region', r_regionkey, r_name FROM region
""")
def parent_tables(spark, folder):
    model = sub_model(star_model(spark, folder), "region", "nation", "customer", "supplier")
    store = new_store(spark)
    data = {n: table(spark, folder, n) for n in ("region", "nation", "customer", "supplier")}
    store.upload_dimensions(model, data)
    # Keys and columns come back from the catalog here.
    learned = store.model()
    nation, region = (store.dimensions(learned)[n] for n in ("nation", "region"))
    pairs = (nation.select("n_nationkey", "n_name"), region.select("r_regionkey", "r_name"))
    named = [
        p.toDF("id", "name").select(F.lit(parent).alias("parent"), "id", "name")
        for parent, p in zip(("nation", "region"), pairs)
    ]
    return named[0].unionByName(named[1])


@query("""
SELECT coalesce(s_suppkey, c_custkey) AS c_custkey, coalesce(s_name, c_name) AS c_name,
       coalesce(s_nationkey, c_nationkey) AS c_nationkey, coalesce(s_acctbal, c_acctbal) AS c_acctbal,
       c_mktsegment
FROM customer FULL JOIN supplier ON c_custkey = s_suppkey
""")
def update_dimension(spark, folder):
    model = sub_model(star_model(spark, folder), "region", "nation", "customer")
    store = new_store(spark)
    store.upload_dimensions(model, {n: table(spark, folder, n) for n in ("region", "nation", "customer")})
    suppliers = table(spark, folder, "supplier").toDF("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    store.update_dimension("customer", suppliers)
    return store["customer"]


_COPIED = """SELECT * FROM sales
  WHERE "Country" IN (SELECT n_nationkey FROM nation WHERE n_name IN ('NATION_1', 'NATION_3', 'NATION_5'))"""


def _sales_copy(spark, folder, **options):
    store = sales_store(spark, folder)
    members = ["NATION_1", "NATION_3", "NATION_5"]
    return write.filter_copy(store, "sales", "sales_copy", members=members, in_place=True, **options)


@query(f"WITH {SALES} {_COPIED}")
def filter_copy(spark, folder):
    return _sales_copy(spark, folder).table


# Tickets

# Cells as the fingerprint writes them, in name order.
_SALES_CELLS = """md5(concat_ws(';', '=' || "Cents", '=' || "OrderID", '=' || "ValidFromVersion",
                         '=' || "ValidToVersion"))"""


def _hash_sql(names: str, digest: str) -> str:
    limb = "sum(CAST('0x' || substr({0}, {1}, 15) AS BIGINT)::HUGEINT)"
    sums = ", ".join(f"CAST({limb.format(digest, n)} AS VARCHAR)" for n in (1, 16))
    return f"md5(concat_ws(':', '{names}', CAST(count(*) AS VARCHAR), {sums}))"


_SALES_NESTED = "Cents,OrderID,ValidFromVersion,ValidToVersion"


@query(f"""
WITH {SALES}, hashed AS (SELECT *, {_SALES_CELLS} AS digest FROM sales)
SELECT 'sales' AS "DBTableName", "Country", "Year", "Method",
       {_hash_sql(_SALES_NESTED, "digest")} AS "NestedDataHash"
FROM hashed GROUP BY "Country", "Year", "Method"
""")
def ticket_groups(spark, folder):
    return tickets.ticket(sales(spark, folder), "sales", algorithm="md5")


@query(f"""
WITH {SALES}, hashed AS (SELECT *, {_SALES_CELLS} AS digest FROM sales)
SELECT 'sales' AS "DBTableName", "Country", "Year", "Method",
       {_hash_sql(_SALES_NESTED, "digest")} AS "NestedDataHash"
FROM hashed GROUP BY "Country", "Year", "Method"
""")
def ticket_table(spark, folder):
    stored = sales_store(spark, folder)["sales"]
    return tickets.ticket(stored, "sales", probe_rows=1_000, algorithm="md5")


_ORDER_CELLS = """md5(concat_ws(';', '=' || CAST(round(o_totalprice * 100) AS BIGINT), '=' || o_custkey,
    '=' || CAST(o_orderdate AS VARCHAR),
    '=' || replace(replace(o_orderpriority, '\\', '\\\\'), ';', '\\;')))"""


@query(f"""
WITH hashed AS (SELECT o_orderstatus, {_ORDER_CELLS} AS digest FROM orders)
SELECT 'orders' AS "DBTableName", 'TPC' AS "Dataset", CAST(NULL AS VARCHAR) AS "Note", o_orderstatus,
       {_hash_sql("cents,o_custkey,o_orderdate,o_orderpriority", "digest")} AS "NestedDataHash"
FROM hashed GROUP BY o_orderstatus
""")
def ticket_single_values(spark, folder):
    """Constant columns, one of them all NULL, become group columns by themselves."""
    rows = table(spark, folder, "orders").select(
        F.lit("TPC").alias("Dataset"),
        F.lit(None).cast("string").alias("Note"),
        "o_custkey",
        "o_orderstatus",
        "o_orderdate",
        "o_orderpriority",
        cents("o_totalprice").alias("cents"),
    )
    return tickets.ticket(rows, "orders", usual=None, additional=["o_orderstatus"], algorithm="md5")


@query(f"""
WITH {SALES}
SELECT 'sales' AS "DBTableName", "Country", "Year", "Method",
       1 + CAST(bool_or("OrderID" % 7 = 0) AS INT) AS distinct_hashes
FROM sales GROUP BY ALL
""")
def ticket_fast(spark, folder):
    """The default algorithm: equal however the rows are spread, and other where some of them changed."""
    rows = sales(spark, folder)
    spread = rows.repartition("Cents").select(*reversed(rows.columns))
    changed = rows.withColumn("Cents", F.col("Cents") + (F.col("OrderID") % 7 == 0).cast("int"))
    taken = [tickets.ticket(r, "sales") for r in (rows, spread, changed)]
    keys_of = ("DBTableName", "Country", "Year", "Method")
    every = taken[0].unionByName(taken[1]).unionByName(taken[2])
    return every.groupBy(*keys_of).agg(F.count_distinct("NestedDataHash").cast("int").alias("distinct_hashes"))


def _single_sql(column: str, expression: str) -> str:
    values = f"count(DISTINCT {expression}) + CAST(count(*) > count({expression}) AS INT)"
    return f"SELECT '{column}' AS \"column\", {values} = 1 AS is_single FROM orders"


_ORDER_COLS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
_MADE_COLS = {
    "Dataset": "'TPC'",
    "Note": "CAST(NULL AS VARCHAR)",
    "Half": "CASE WHEN o_orderstatus = 'F' THEN 'x' END",
}


@query(" UNION ALL ".join(_single_sql(c, e) for c, e in [*((c, c) for c in _ORDER_COLS), *_MADE_COLS.items()]))
def single_value_columns(spark, folder):
    rows = table(spark, folder, "orders").withColumns(
        {
            "Dataset": F.lit("TPC"),
            "Note": F.lit(None).cast("string"),
            "Half": F.when(F.col("o_orderstatus") == "F", "x"),
        }
    )
    return tickets.single_value_report(rows)


_READABLE_CELLS = """md5(concat_ws(';', '=' || "Cents", '=' || "OrderID", '=v' || "ValidFromVersion",
                         '=v' || "ValidToVersion"))"""


def _upserted_sales(spark, folder, change=None, **options):
    """A store, the readable sales, and what an upsert of them gave back."""
    store = sales_store(spark, folder)
    readable = keys.decode_keys(sales(spark, folder), "sales", star_model(spark, folder), star_dims(spark, folder))
    readable = readable if change is None else change(readable)
    return store, readable, write.upsert(store, readable, "sales_copy", in_place=True, **options)


@query(f"""
WITH {SALES}, hashed AS (SELECT *, {_READABLE_CELLS} AS digest FROM sales)
SELECT 'sales_copy' AS "DBTableName", n_name AS "Country", "Year", "Method",
       {_hash_sql(_SALES_NESTED, "digest")} AS "NestedDataHash"
FROM hashed JOIN nation ON n_nationkey = "Country" GROUP BY n_name, "Year", "Method"
""")
def readable_ticket(spark, folder):
    """The ticket of readable rows, as the upsert of them gives it."""
    return _upserted_sales(spark, folder, algorithm="md5")[2].ticket


@query(f"""
WITH {SALES}, hashed AS (SELECT *, {_SALES_CELLS} AS digest FROM ({_COPIED}))
SELECT 'sales_copy' AS "DBTableName", n_name AS "Country", "Year", "Method",
       {_hash_sql(_SALES_NESTED, "digest")} AS "NestedDataHash"
FROM hashed JOIN nation ON n_nationkey = "Country" GROUP BY n_name, "Year", "Method"
""")
def filter_copy_ticket(spark, folder):
    return _sales_copy(spark, folder, algorithm="md5").ticket


def _sales_ticket(spark, folder):
    model, dims = star_model(spark, folder), star_dims(spark, folder)
    readable = keys.decode_keys(sales(spark, folder), "sales", model, dims)
    return tickets.ticket(readable, "sales"), model, dims


_DECODED_SALES = """SELECT "OrderID", n_name AS "Country", "Year", "Method",
       'v' || "ValidFromVersion" AS "ValidFromVersion", 'v' || "ValidToVersion" AS "ValidToVersion", "Cents"
FROM sales LEFT JOIN nation ON "Country" = n_nationkey"""


@query(f"""
WITH {SALES}, decoded AS ({_DECODED_SALES})
SELECT 'sales' AS "DBTableName", * FROM decoded
WHERE ("Country" = 'NATION_7' OR "Method" = '2-HIGH') AND "Year" >= 1997
""")
def collect_ticket(spark, folder):
    ticket, model, dims = _sales_ticket(spark, folder)
    wanted = ticket.filter("(Country = 'NATION_7' OR Method = '2-HIGH') AND Year >= 1997")
    tables = {"sales": sales(spark, folder)}
    return read.collect_ticket(wanted, tables, model=model, dims=dims, keep_table_name=True)


@query(f"""
WITH {SALES}, decoded AS ({_DECODED_SALES}), low AS (SELECT * FROM decoded WHERE "Method" = '5-LOW'),
v AS (SELECT * FROM sales WHERE "ValidFromVersion" <= 4 AND "ValidToVersion" >= 4)
SELECT low.* FROM low JOIN v ON low."OrderID" = v."OrderID"
""")
def collect_ticket_version(spark, folder):
    ticket, model, dims = _sales_ticket(spark, folder)
    wanted = ticket.filter("Method = '5-LOW'")
    tables = {"sales": sales(spark, folder)}
    return read.collect_ticket(wanted, tables, model=model, dims=dims, versions="v4")


@query(f"""
WITH {SALES}
SELECT DISTINCT "Country" AS nation, "Year", "Method" FROM sales WHERE "Method" = '5-LOW'
""")
def verify_ticket(spark, folder):
    """Groups whose rows changed after the ticket was taken."""
    rows = sales(spark, folder)
    taken = tickets.ticket(rows, "sales")
    changed = rows.withColumn("Cents", F.col("Cents") + (F.col("Method") == "5-LOW").cast("int"))
    differing = read.verify_ticket(taken, changed, "sales")
    return differing.select(F.col("Country").alias("nation"), "Year", "Method")


@query(f"WITH {SALES}, decoded AS ({_DECODED_SALES}) SELECT * FROM decoded")
def upsert_then_collect(spark, folder):
    """Written, then fetched by the ticket that the write gave; the store describes its own tables."""
    store, _, written = _upserted_sales(spark, folder)
    return read.collect_ticket(written.ticket, store, verify=True)


@query("""
SELECT 1 AS vfrom, 1 AS vto, n_name AS "Country", c_custkey AS "Account", c_acctbal AS "Balance"
FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def upsert_rounded_then_verify(spark, folder):
    """Balances with noise beyond eight digits; the ticket describes the rounded ones."""
    store, accounts = _account_store(spark, folder)
    noisy = accounts.withColumn("Balance", F.col("Balance") * (1 + 1e-12))
    written = write.upsert(store, noisy, "account", in_place=True, round_doubles=True, digits=8)
    rows = read.collect_ticket(written.ticket, store, verify=True)
    return rows.select(
        F.col("ValidFromVersion").substr(2, 9).cast("int").alias("vfrom"),
        F.col("ValidToVersion").substr(2, 9).cast("int").alias("vto"), "Country", "Account", "Balance",
    )


@query("""
SELECT 2 AS vfrom, 2 AS vto, n_name AS "Country", c_custkey AS "Account", c_acctbal AS "Balance"
FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def upsert_compressed_then_collect(spark, folder):
    """The second release is merged into the first one's rows, and its ticket still finds it."""
    store, accounts = _account_store(spark, folder)
    options = {"in_place": True, "round_doubles": True, "digits": 8}
    write.upsert(store, accounts, "account", **options)
    written = write.upsert(store, _second_release(accounts), "account", compress=True, **options)
    rows = read.collect_ticket(written.ticket, store, verify=True)
    return rows.select(
        F.col("ValidFromVersion").substr(2, 9).cast("int").alias("vfrom"),
        F.col("ValidToVersion").substr(2, 9).cast("int").alias("vto"), "Country", "Account", "Balance",
    )


@query(f"""
WITH {SALES}, hashed AS (SELECT *, {_SALES_CELLS} AS digest FROM ({_COPIED}))
SELECT 'sales_copy' AS "DBTableName", n_name AS "Country", "Year", "Method",
       {_hash_sql(_SALES_NESTED, "digest")} AS "NestedDataHash"
FROM hashed JOIN nation ON n_nationkey = "Country" GROUP BY n_name, "Year", "Method"
""")
def copy_ticket_is_fixed(spark, folder):
    """The ticket of a copy, after more rows came into the same table."""
    store = sales_store(spark, folder)
    options = {"in_place": True, "algorithm": "md5"}
    taken = write.filter_copy(store, "sales", "sales_copy", members=["NATION_1", "NATION_3", "NATION_5"], **options)
    write.filter_copy(store, "sales", "sales_copy", members=["NATION_2"], empty_dest=False, **options)
    return taken.ticket


@query(f"""
WITH {SALES} SELECT * FROM sales WHERE "Country" IN (SELECT n_nationkey FROM nation WHERE n_name IN ('NATION_1', 'NATION_2'))
""")
def filter_copy_append(spark, folder):
    """A second copy added to what the first one wrote."""
    store = sales_store(spark, folder, partition_by={})
    for n, member in enumerate(("NATION_1", "NATION_2")):
        write.filter_copy(store, "sales", "sales_copy", members=[member], empty_dest=n == 0, in_place=True)
    return store["sales_copy"]


@query(f"""
WITH cells AS (
  SELECT l_orderkey, l_linenumber, l_returnflag, '=' || l_linenumber AS a, '=' || l_returnflag AS b FROM lineitem),
parts AS (SELECT *, length(a) || ':' || a || length(b) || ':' || b AS body FROM cells),
orders_of AS (
  SELECT l_orderkey, '=' || string_agg(length('=' || body) || ':' || '=' || body, ''
    ORDER BY l_linenumber, l_returnflag) AS items FROM parts GROUP BY l_orderkey),
hashed AS (SELECT l_orderkey % 10 AS digit, md5(concat_ws(';', items, '=' || l_orderkey)) AS digest FROM orders_of)
SELECT 'orders' AS "DBTableName", digit, {_hash_sql("items,l_orderkey", "digest")} AS "NestedDataHash"
FROM hashed GROUP BY digit
""")
def ticket_nested(spark, folder):
    """Arrays of structs are hashed by value."""
    item = F.struct("l_linenumber", "l_returnflag")
    rows = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias("items"))
    rows = rows.withColumn("digit", F.col("l_orderkey") % 10)
    return tickets.ticket(rows, "orders", usual=None, additional=["digit"], algorithm="md5", keep_single=False)


# Reads


@query(f"""
WITH {SALES}, decoded AS ({_DECODED_SALES})
SELECT * FROM decoded WHERE "Country" IN ('NATION_0', 'NATION_11') AND "Cents" >= 100000 AND "Year" <= 1999
""")
def filter_decoded(spark, folder):
    return read.filter_table(
        {"sales": sales(spark, folder)},
        "sales",
        F.col("Country").isin("NATION_0", "NATION_11"),
        "Cents >= 100000 AND Year <= 1999",
        model=star_model(spark, folder),
        dims=star_dims(spark, folder),
    )


def _merged_sales(spark, folder):
    rows = sales(spark, folder).drop("OrderID", "Year").withColumn("Cents", F.floor(F.col("Cents") / 5000000))
    return versions.compress_versions(rows)


@query(f"""
WITH {SALES}, merged AS (
  SELECT "Country", "Method", CAST(floor("Cents" / 5000000) AS BIGINT) AS "Cents",
         min("ValidFromVersion") AS f, max("ValidToVersion") AS t
  FROM sales GROUP BY 1, 2, 3)
SELECT n_name AS "Country", "Method", 'v' || f AS "ValidFromVersion", 'v' || t AS "ValidToVersion", "Cents"
FROM merged JOIN nation ON "Country" = n_nationkey
WHERE f <= 3 AND t >= 3 AND n_name IN ('NATION_0', 'NATION_11')
""")
def release_sales(spark, folder):
    """Flagship: merge across releases, take one release, decode, filter on readable values."""
    return read.filter_table(
        {"sales": _merged_sales(spark, folder)},
        "sales",
        F.col("Country").isin("NATION_0", "NATION_11"),
        versions="v3",
        model=star_model(spark, folder),
        dims=star_dims(spark, folder),
    )


@query(f"""
WITH {SALES}
SELECT * FROM sales WHERE "Country" IN (1, 2, 3) AND "Year" IN (1996, 1998, 2000)
""")
def filter_members_periods(spark, folder):
    rows = filters.drop_task_group(sales(spark, folder).withColumn("tar_group", F.col("Country") + 1))
    return filters.filter_members_periods(rows, [1, 2, 3], [1996, 1998, 2000])


@query(f"""
WITH {SALES}
SELECT * FROM sales WHERE "Country" IN (SELECT s_nationkey FROM supplier WHERE s_nationkey % 3 <> 0)
""")
def filter_members_listed(spark, folder):
    """Members listed in a table, all periods."""
    listed = table(spark, folder, "supplier").select("s_nationkey").filter("s_nationkey % 3 <> 0")
    return filters.filter_members_periods(sales(spark, folder), listed, "all")


# Matrices


def _cells(spark, folder):
    """Quantity by ship year, return flag (matrix), brand (row) and line status (column)."""
    items = table(spark, folder, "lineitem").select(
        "l_partkey", "l_quantity", "l_returnflag", "l_linestatus", F.year("l_shipdate").alias("Year")
    )
    parts = table(spark, folder, "part").select("p_partkey", "p_brand")
    return (
        items.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(
            "Year",
            F.col("l_returnflag").alias("matname"),
            F.col("p_brand").alias("rowname"),
            F.col("l_linestatus").alias("colname"),
        )
        .agg(F.sum("l_quantity").alias("value"))
    )


CELLS = """cells AS (
  SELECT CAST(year(l_shipdate) AS INT) AS "Year", l_returnflag AS matname, p_brand AS rowname,
         l_linestatus AS colname, sum(l_quantity) AS value
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3, 4)"""


def _index_map(spark, folder):
    """Brands by their number, line statuses by their letter, as stored dimensions."""
    brands = table(spark, folder, "part").select(F.col("p_brand").alias("Brand")).distinct()
    states = table(spark, folder, "lineitem").select(F.col("l_linestatus").alias("Status")).distinct()
    return {
        "Brand": stage(brands.withColumn("BrandID", F.regexp_extract("Brand", r"(\d+)", 1).cast("int")), "brand"),
        "Status": stage(states.withColumn("StatusID", F.ascii("Status") - 64), "status"),
    }


def _rctypes(spark, folder):
    flags = table(spark, folder, "lineitem").select(F.col("l_returnflag").alias("matname")).distinct()
    return stage(flags.withColumns({"rowtype": F.lit("Brand"), "coltype": F.lit("Status")}), "rctypes")


def _matrices(spark, folder):
    """One row per year and flag with the matrix as a value."""
    cell = F.struct("rowname", "colname", "value")
    return _cells(spark, folder).groupBy("Year", "matname").agg(F.collect_list(cell).alias("matval"))


_ENCODED = f"""WITH {CELLS}
SELECT "Year", matname, CAST(regexp_extract(rowname, '(\\d+)', 1) AS INT) AS i,
       CAST(ascii(colname) - 64 AS INT) AS j, value
FROM cells WHERE value <> 0"""


def _encoded(spark, folder):
    maps = _index_map(spark, folder), _rctypes(spark, folder)
    return matrix.encode_matrices(_cells(spark, folder), *maps), maps


@query(_ENCODED)
def matrix_encode(spark, folder):
    return matrix.encode_matrices(
        _matrices(spark, folder), _index_map(spark, folder), _rctypes(spark, folder)
    )


@query(_ENCODED)
def matrix_encode_wide(spark, folder):
    wide = _matrices(spark, folder).groupBy("Year").pivot("matname", ["A", "N", "R"]).agg(F.first("matval"))
    return matrix.encode_matrices(wide, _index_map(spark, folder), _rctypes(spark, folder))


@query(_ENCODED)
def matrix_encode_cells(spark, folder):
    return _encoded(spark, folder)[0]


@query(f"""WITH {CELLS} SELECT * FROM cells WHERE value <> 0""")
def matrix_names(spark, folder):
    encoded, maps = _encoded(spark, folder)
    return matrix.name_cells(encoded, *maps)


def _as_text(column: str):
    """A matrix as text, to compare it across engines."""
    cells = F.transform(
        column, lambda c: F.concat_ws("/", c["rowname"], c["colname"], c["value"].cast("bigint").cast("string"))
    )
    return F.when(F.col(column).isNotNull(), F.array_join(cells, ",")).alias(column)


_TEXT = """string_agg(rowname || '/' || colname || '/' || CAST(value AS BIGINT), ','
                      ORDER BY rowname, colname)"""


@query(f"""WITH {CELLS} SELECT "Year", matname, {_TEXT} AS matval FROM cells GROUP BY "Year", matname""")
def matrix_decode_tidy(spark, folder):
    encoded, maps = _encoded(spark, folder)
    decoded = matrix.decode_matrices(encoded, *maps, wide=False)
    return decoded.select("Year", "matname", _as_text("matval"))


@query(f"""
WITH {CELLS}
SELECT "Year", {", ".join(f"{_TEXT} FILTER (matname = '{m}') AS {m}" for m in "ANR")}
FROM cells GROUP BY "Year"
""")
def matrix_decode_wide(spark, folder):
    encoded, maps = _encoded(spark, folder)
    decoded = matrix.decode_matrices(encoded, *maps)
    return decoded.select("Year", *[_as_text(m) for m in "ANR"])


@query(f"""
WITH {CELLS}
SELECT "Year", matname, (CAST(regexp_extract(rowname, '(\\d+)', 1) AS BIGINT) - 1) // 10 AS tile_i,
       (CAST(ascii(colname) AS BIGINT) - 65) // 10 AS tile_j, {_TEXT} AS matval
FROM cells GROUP BY ALL
""")
def matrix_decode_tiles(spark, folder):
    """Matrices beyond the tile size come in tiles of bounded size."""
    encoded, maps = _encoded(spark, folder)
    decoded = matrix.decode_matrices(encoded, *maps, wide=False, tile=10)
    return decoded.select("Year", "matname", "tile_i", "tile_j", _as_text("matval"))


PART_TILE = 1_024  # rows of a tile, more than there are columns


@query(f"""
WITH cells AS (
  SELECT CAST(year(l_shipdate) AS INT) AS "Year", l_returnflag AS matname,
         lpad(CAST(l_partkey AS VARCHAR), 9, '0') AS rowname, l_linestatus AS colname, sum(l_quantity) AS value
  FROM lineitem GROUP BY 1, 2, 3, 4)
SELECT "Year", {", ".join(f"{_TEXT} FILTER (matname = '{m}') AS {m}" for m in "ANR")}
FROM cells GROUP BY "Year"
""")
def matrix_decode_long_index(spark, folder):
    """Rows by part: an index of thousands of names gives the same columns as a short one.

    Cells are gathered in tiles, and a matrix is joined from the texts of its tiles, so no task holds more cells than
    tiles have.  Names are indices filled up with zeros, hence in their order.
    """
    cells = (
        table(spark, folder, "lineitem")
        .groupBy(
            F.year("l_shipdate").alias("Year"), F.col("l_returnflag").alias("matname"),
            F.col("l_partkey").cast("int").alias("i"), (F.ascii("l_linestatus") - 64).alias("j"),
        )
        .agg(F.sum("l_quantity").alias("value"))
    )
    parts = table(spark, folder, "lineitem").select(F.col("l_partkey").cast("int").alias("PartID")).distinct()
    parts = parts.withColumn("Part", F.lpad(F.col("PartID").cast("string"), 9, "0"))
    index = {"Brand": parts, "Status": _index_map(spark, folder)["Status"]}
    decoded = matrix.decode_matrices(
        cells, index, _rctypes(spark, folder), names=list("ANR"), unique_cells=True, tile=PART_TILE
    )
    texts = decoded.select("Year", "tile_i", *[_as_text(m) for m in "ANR"])
    pieces = F.array_sort(F.collect_list(F.struct("tile_i", *"ANR")))
    joined = texts.groupBy("Year").agg(pieces.alias("tiles"))
    whole = joined.select("Year", *[F.array_compact(F.col("tiles").getField(m)).alias(m) for m in "ANR"])
    # Absent matrices stay NULL.
    return whole.select("Year", *[F.when(F.size(m) > 0, F.array_join(m, ",")).alias(m) for m in "ANR"])


# Snapshots and reference data


@query("SELECT * FROM orders")
def snapshot_roundtrip(spark, folder):
    root = f"{scratch_dir(spark)}/releases-{uuid.uuid4().hex[:8]}"
    release_snapshot(table(spark, folder, "orders"), root, "orders", release=True)
    return read_snapshot(spark, root, "orders")


@query("SELECT * FROM customer")
def snapshot_of_release(spark, folder):
    """The version of a snapshot that belongs to a release, though there is a newer one."""
    root = f"{scratch_dir(spark)}/releases-{uuid.uuid4().hex[:8]}"
    customers = table(spark, folder, "customer")
    release_snapshot(customers, root, "customer", release=True)
    release_snapshot(customers.withColumn("c_acctbal", F.lit(0.0)), root, "customer", release=True)
    first, second = snapshot_versions(spark, root, "customer")
    listed = [("v1.2", "customer", first), ("v1.3", "customer", second)]
    versions_of = spark.createDataFrame(listed, "database_version string, name string, version string")
    return read_release(spark, root, "customer", 1.2, versions_of)


@query("SELECT * FROM documents")
def snapshot_csv(spark, folder):
    root = f"{scratch_dir(spark)}/releases-{uuid.uuid4().hex[:8]}"
    documents = table(spark, folder, "documents")
    release_snapshot(documents, root, "documents", format="csv", release=True)
    return read_snapshot(spark, root, "documents", format="csv", schema=documents.schema)


@query(f"""
WITH {SALES}
SELECT n_name AS "Country", CAST(sum("Cents") AS BIGINT) AS cents
FROM sales JOIN nation ON "Country" = n_nationkey
WHERE n_name NOT IN ('NATION_20', 'NATION_21') GROUP BY n_name
""")
def canonical_members(spark, folder):
    """Totals per member, leaving out members that are aggregates of others."""
    readable = keys.decode_keys(
        sales(spark, folder), "sales", star_model(spark, folder), star_dims(spark, folder)
    )
    counted = refdata.canonical_members(readable, COUNTRY_COL, ["NATION_20", "NATION_21"])
    return counted.groupBy("Country").agg(F.sum("Cents").alias("cents"))


# What queries that write spend on creating and filling their store, to be timed apart.
WRITES = {
    **dict.fromkeys(("upsert_full", "upsert_compressed", "upsert_preview"), _account_store),
    **dict.fromkeys(
        ("filter_copy", "filter_copy_ticket", "ticket_table", "readable_ticket", "upsert_then_collect"), sales_store
    ),
}
