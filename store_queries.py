"""Queries of what a store does beside single operators: ledgers, buckets, partitions, statistics, matrices.

They add to ``QUERIES`` and ``ORACLES`` of :mod:`star_queries` and use its tables and stores.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from keyframe.model import ForeignKey, KeyModel
from keyframe.operators import constraints, keys
from keyframe.plans import ledger, read, write
from keyframe.plans.statistics import stored_single_values
from star_queries import (
    _SALES_CELLS,
    _SALES_NESTED,
    _TEXT,
    CELLS,
    SALES,
    _account_store,
    _as_text,
    _cells,
    _hash_sql,
    _index_map,
    _matrices,
    _rctypes,
    _second_release,
    new_store,
    query,
    sales,
    sales_store,
    star_dims,
    star_model,
    table,
)

# Ledgers


_CHANGED_SALES = """changed AS (SELECT * REPLACE (CASE WHEN "Method" = '5-LOW' THEN "Cents" + 1 ELSE "Cents" END AS "Cents") FROM sales),
hashed AS (SELECT *, {cells} AS digest FROM changed)"""


@query(f"""
WITH {SALES}, {_CHANGED_SALES.format(cells=_SALES_CELLS)}
SELECT 'sales_copy' AS "DBTableName", n_name AS "Country", "Year", "Method",
       {_hash_sql(_SALES_NESTED, "digest")} AS "NestedDataHash"
FROM hashed JOIN nation ON n_nationkey = "Country" GROUP BY n_name, "Year", "Method"
""")
def ticket_incremental(spark, folder):
    """The ticket of a whole table after three upserts, from its ledger: no pass over the table."""
    store = sales_store(spark, folder)
    ledger.keep_ledger(store, "sales_copy", algorithm="md5")
    rows = sales(spark, folder)
    early, low = F.col("Year") <= 1997, F.col("Method") == "5-LOW"
    corrected = rows.filter(low).withColumn("Cents", F.col("Cents") + 1)
    for batch in (rows.filter(early), rows.filter(~early), corrected):
        write.upsert(store, batch, "sales_copy", in_place=True)
    return ledger.ledger_ticket(store, "sales_copy")


@query(f"""
WITH {SALES}, hashed AS (SELECT *, {_SALES_CELLS} AS digest FROM sales WHERE "Country" IN (
  SELECT n_nationkey FROM nation WHERE n_name IN ('NATION_1', 'NATION_2')))
SELECT 'sales_copy' AS "DBTableName", n_name AS "Country", "Year", "Method",
       {_hash_sql(_SALES_NESTED, "digest")} AS "NestedDataHash"
FROM hashed JOIN nation ON n_nationkey = "Country" GROUP BY n_name, "Year", "Method"
""")
def ticket_incremental_copy(spark, folder):
    """A ledger follows a copy that replaces the table, and one that adds to it."""
    store = sales_store(spark, folder)
    ledger.keep_ledger(store, "sales_copy", algorithm="md5")
    for member, empty in (("NATION_1", True), ("NATION_2", False)):
        write.filter_copy(store, "sales", "sales_copy", members=[member], empty_dest=empty, in_place=True)
    return ledger.ledger_ticket(store, "sales_copy")


# Buckets and groups


@query("""
SELECT 1 AS "ValidFromVersion", 1 AS "ValidToVersion", c_nationkey AS "Country", c_custkey AS "Account",
       CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS "Balance" FROM customer
""")
def upsert_bucketed(spark, folder):
    """A correction of some rows of a table without partitions: only the buckets they fall into are written."""
    store, accounts = _account_store(spark, folder, bucket_by={"account": 8})
    write.upsert(store, accounts, "account", in_place=True)
    corrected = accounts.filter("Balance < 0").withColumn("Balance", F.lit(0.0))
    return write.upsert(store, corrected, "account", in_place=True).table


def _half_changed(accounts):
    """The accounts in release v2, those in debt with another balance."""
    changed = F.when(F.col("Balance") < 0, F.col("Balance") - 1).otherwise(F.col("Balance"))
    return _second_release(accounts).withColumn("Balance", F.round(changed, 2))


_HALF_CHANGED = """
SELECT min(v) AS "ValidFromVersion", max(v) AS "ValidToVersion", "Country", "Account", "Balance" FROM (
  SELECT 1 AS v, c_nationkey AS "Country", c_custkey AS "Account", c_acctbal AS "Balance" FROM customer
  UNION ALL
  SELECT 2, c_nationkey, c_custkey, round(CASE WHEN c_acctbal < 0 THEN c_acctbal - 1 ELSE c_acctbal END, 2) FROM customer)
GROUP BY "Country", "Account", "Balance"
"""


@query(_HALF_CHANGED)
def compress_touched_groups(spark, folder):
    """A release added and merged with the rows it equals, without a look at any other group's versions."""
    store, accounts = _account_store(spark, folder)
    write.upsert(store, accounts, "account", in_place=True)
    return write.upsert(store, _half_changed(accounts), "account", in_place=True, compress="groups").table


@query(_HALF_CHANGED)
def compress_touched_partitions(spark, folder):
    store, accounts = _account_store(spark, folder, partition_by={"account": ["Country"]})
    write.upsert(store, accounts, "account", in_place=True)
    return write.upsert(store, _half_changed(accounts), "account", in_place=True, compress="touched").table


# Checks


@query(f"""
WITH {SALES}, broken AS (
  SELECT CASE "Method" WHEN '5-LOW' THEN NULL WHEN '2-HIGH' THEN "Country" + 20 ELSE "Country" END AS "Country",
         "ValidFromVersion", "ValidToVersion" + "Year" % 7 AS "ValidToVersion" FROM sales)
SELECT 'Country' AS "column", count(*) FILTER ("Country" IS NULL OR "Country" NOT IN (SELECT n_nationkey FROM nation)) AS violations FROM broken
UNION ALL SELECT 'ValidFromVersion', count(*) FILTER ("ValidFromVersion" NOT BETWEEN 1 AND 10) FROM broken
UNION ALL SELECT 'ValidToVersion', count(*) FILTER ("ValidToVersion" NOT BETWEEN 1 AND 10) FROM broken
""")
def observed_violations(spark, folder):
    """Rows with a bad foreign key, counted by the way while the rows are written."""
    broken = sales(spark, folder).withColumns(
        {
            "Country": F.when(F.col("Method") == "2-HIGH", F.col("Country") + 20).when(F.col("Method") != "5-LOW", F.col("Country")),
            "ValidToVersion": (F.col("ValidToVersion") + F.col("Year") % 7).cast("int"),
        }
    )
    watched, seen = constraints.observe_foreign_keys(broken, "sales", star_model(spark, folder), star_dims(spark, folder))
    watched.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(list(seen.get.items()), "column string, violations long")


@query("""
SELECT c_custkey, n_nationkey AS c_nationkey FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def encode_keys_listed(spark, folder):
    """Integer values that are not keys yet: encoded on request, after all bad ones would have been listed."""
    rows = table(spark, folder, "customer").select("c_custkey", (F.col("c_nationkey") * 7).alias("c_nationkey"))
    codes = table(spark, folder, "nation").select("n_nationkey", (F.col("n_nationkey") * 7).alias("n_code"))
    model = KeyModel({"customer": rows.schema, "nation": codes.schema}, {"nation": ("n_nationkey",)}, (
        ForeignKey("customer", "c_nationkey", "nation", "n_nationkey", "n_code"),
    ))
    return keys.encode_keys(rows, "customer", model, {"nation": codes}, check="listed", force=["c_nationkey"])


@query(f"""
WITH {SALES}, copied AS (SELECT * FROM sales WHERE "Country" IN (SELECT n_nationkey FROM nation WHERE n_name = 'NATION_1'))
{" UNION ALL ".join(f"SELECT '{c}' AS " + '"column"' + f", count(DISTINCT " + '"' + c + '"' + ") = 1 AS is_single FROM copied" for c in ("OrderID", "Country", "Year", "Method", "ValidFromVersion", "ValidToVersion", "Cents"))}
""")
def single_values_stored(spark, folder):
    """Single-valued columns of a stored table, told by file footers where they can tell."""
    store = sales_store(spark, folder)
    write.filter_copy(store, "sales", "sales_copy", members=["NATION_1"], in_place=True)
    single = stored_single_values(store, "sales_copy")
    rows = [(c, c in single) for c in store["sales_copy"].columns]
    return spark.createDataFrame(rows, "column string, is_single boolean")


# Reads of partitioned tables


@query("""
SELECT 'v1' AS "ValidFromVersion", 'v1' AS "ValidToVersion", n_name AS "Country", c_custkey AS "Account", c_acctbal AS "Balance"
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name NOT IN ('NATION_3', 'NATION_4')
""")
def collect_ticket_long(spark, folder):
    """A ticket of a group for each account; partitions are pruned while the query runs, by the ticket's values."""
    store, accounts = _account_store(spark, folder, partition_by={"account": ["Country"]})
    written = write.upsert(store, accounts, "account", in_place=True, additional=["Account"])
    members = "Country NOT IN ('NATION_3', 'NATION_4')"
    return read.collect_ticket(written.ticket.filter(members), store, verify=True)


@query("""
SELECT 'v1' AS "ValidFromVersion", 'v1' AS "ValidToVersion", n_name AS "Country", c_custkey AS "Account", c_acctbal AS "Balance"
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name IN ('NATION_0', 'NATION_11') AND c_acctbal >= 0
""")
def filter_decoded_partitioned(spark, folder):
    """A readable filter on a stored table: the members it leaves prune the table's partitions."""
    store, accounts = _account_store(spark, folder, partition_by={"account": ["Country"]})
    write.upsert(store, accounts, "account", in_place=True)
    return read.filter_table(store, "account", F.col("Country").isin("NATION_0", "NATION_11"), "Balance >= 0")


def _flow_store(spark, folder, **options):
    """Sales by nation and year, with a dimension of years, and an empty copy."""
    years = sales(spark, folder).select(F.col("Year").alias("YearID"), "Year").distinct()
    flows = sales(spark, folder).select("Country", "Year", "OrderID", "Cents")
    foreign = [("Country", "nation", "n_nationkey", "n_name"), ("Year", "Year", "YearID", "Year")]
    model = KeyModel(
        {"flow": flows.schema, "flow_copy": flows.schema, "nation": table(spark, folder, "nation").schema, "Year": years.schema},
        {"flow": ("Country", "Year", "OrderID"), "flow_copy": ("Country", "Year", "OrderID"), "nation": ("n_nationkey",), "Year": ("YearID",)},
        tuple(ForeignKey(t, *fk) for t in ("flow", "flow_copy") for fk in foreign),
    )
    store = new_store(spark)
    store.upload_dimensions(model, {"nation": table(spark, folder, "nation"), "Year": years}, **options)
    store.replace("flow", flows)
    return store


@query(f"""
WITH {SALES} SELECT "Country", "Year", "OrderID", "Cents" FROM sales
WHERE "Year" IN (1996, 1999) AND "Country" IN (SELECT n_nationkey FROM nation WHERE n_name IN ('NATION_1', 'NATION_2', 'NATION_3'))
""")
def filter_copy_periods(spark, folder):
    """Some members and years, into a partitioned table that held other years before."""
    store = _flow_store(spark, folder, partition_by={"flow_copy": ["Year"]})
    members = ["NATION_1", "NATION_2", "NATION_3"]
    for years in ([1995, 1996], [1996, 1999]):
        copied = write.filter_copy(store, "flow", "flow_copy", members=members, periods=years, in_place=True)
    return copied.table.select("Country", "Year", "OrderID", "Cents")


# Matrices in a store


def _matrix_store(spark):
    """An empty table of matrix cells by year."""
    cells = spark.createDataFrame([], "Year int, matname string, i int, j int, value double")
    store = new_store(spark)
    store.create(KeyModel({"flow": cells.schema}, {"flow": ("Year", "matname", "i", "j")}, ()))
    return store


def _stored_matrices(spark, folder, matrices, complete=False, **options):
    store, maps = _matrix_store(spark), {"index_map": _index_map(spark, folder), "rctypes": _rctypes(spark, folder)}
    written = write.upsert(store, matrices, "flow", in_place=True, **maps, **options)
    read_back = read.filter_table(store, "flow", matrices=True, complete=complete, **maps)
    return store, written, maps, read_back.select("Year", *[_as_text(m) for m in "ANR"])


_WIDE = f"""SELECT "Year", {", ".join(f"{_TEXT} FILTER (matname = '{m}') AS {m}" for m in "ANR")}
FROM cells GROUP BY "Year" """


@query(f"WITH {CELLS} {_WIDE}")
def matrix_store_roundtrip(spark, folder):
    """Matrices are written as cells and read back as matrices."""
    return _stored_matrices(spark, folder, _matrices(spark, folder))[3]


@query(f"WITH {CELLS} {_WIDE}")
def matrix_store_collect(spark, folder):
    """As before, fetched by the ticket that the write gave."""
    store, written, maps, _ = _stored_matrices(spark, folder, _matrices(spark, folder))
    fetched = read.collect_ticket(written.ticket, store, **maps)
    return fetched.select("Year", *[_as_text(m) for m in "ANR"])


_N_IS_ZERO = """CASE WHEN matname = 'N' THEN 0.0 ELSE value END AS value"""


def _without_n(spark, folder):
    """The matrices, all cells of one of them zero."""
    zeroed = F.transform("matval", lambda c: F.when(F.col("matname") == "N", c.withField("value", F.lit(0).cast("double"))).otherwise(c))
    return _matrices(spark, folder).withColumn("matval", zeroed)


@query(f"""WITH {CELLS.replace("cells AS", "given AS")}, cells AS (SELECT * REPLACE ({_N_IS_ZERO}) FROM given) {_WIDE}""")
def matrix_zero_structure(spark, folder):
    """A matrix of zeros keeps its rows and columns if its zeros are stored."""
    return _stored_matrices(spark, folder, _without_n(spark, folder), retain_zeros=True)[3]


@query(f"""
WITH {CELLS.replace("cells AS", "given AS")}, brands AS (SELECT DISTINCT p_brand AS rowname FROM part),
states AS (SELECT DISTINCT l_linestatus AS colname FROM lineitem),
kept AS (SELECT * FROM given WHERE value <> 0 AND value % 7 <> 0),
cells AS (
  SELECT m."Year", m.matname, rowname, colname, coalesce(kept.value, 0) AS value
  FROM (SELECT DISTINCT "Year", matname FROM kept) m CROSS JOIN brands CROSS JOIN states
  LEFT JOIN kept USING ("Year", matname, rowname, colname))
{_WIDE}""")
def matrix_completed(spark, folder):
    """Cells that are not stored come back as zeros in matrices of full shape."""
    sparse = _cells(spark, folder).filter("value % 7 <> 0")
    return _stored_matrices(spark, folder, sparse, complete=True)[3]


@query(f"""
SELECT 'account' AS "DBTableName", n_name AS "Country", 'v1' AS "ValidFromVersion", 'v1' AS "ValidToVersion",
       {_hash_sql("Account,Balance", "digest")} AS "NestedDataHash"
FROM (SELECT *, md5(concat_ws(';', '=' || c_custkey, '=' || CAST(floor(c_acctbal) + 0.5 AS VARCHAR))) AS digest FROM customer)
JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name
""")
def ticket_before_rounding(spark, folder):
    """``hash_rounded=False``: the ticket describes the rows as they were given, the table holds rounded ones."""
    store, accounts = _account_store(spark, folder)
    given = accounts.withColumn("Balance", F.floor("Balance").cast("double") + 0.5)
    options = {"round_doubles": True, "digits": 1, "hash_rounded": False, "algorithm": "md5"}
    return write.upsert(store, given, "account", in_place=True, **options).ticket
