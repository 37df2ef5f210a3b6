"""Tables with keys in a Spark database.

Spark's file tables have no primary or foreign keys, so a table carries its keys
in its table properties, where any session with the same catalog finds them.

A table is replaced by writing a new folder and pointing the catalog entry at it
(``ALTER TABLE ... SET LOCATION``): a plan may read the table it replaces, readers
see the old rows or the new ones, and a failed write changes nothing.  A
partitioned table is instead replaced partition by partition, so that an upsert
rewrites no more than the partitions it touches.  A bucketed table is replaced bucket
by bucket: files of untouched buckets stay, and joins on the primary key do not move its rows.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator, Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyframe.model import ForeignKey, KeyModel
from keyframe.operators.constraints import (
    duplicate_keys,
    foreign_key_nulls,
    key_problems,
    require_empty,
    require_foreign_keys,
    require_primary_key,
)
from keyframe.operators.upsert import merge_rows
from keyframe.sources.storage import delete_folder, exists, list_names, move, read_text, staged, write_text

_NAME, _KEY, _FOREIGN, _NOT_NULL, _PARTITIONS, _BUCKETS, _LEDGER = (
    f"keyframe.{p}" for p in ("name", "primary_key", "foreign_keys", "not_null", "partitions", "buckets", "ledger")
)
# Spark ends the names of a bucket's files with the bucket's number.
_BUCKET_OF = re.compile(r"_(\d+)(?:\..*)?$")
# Says which files replace which, while buckets are exchanged; readers pass over names with an underscore.
_SWAP = "_swap.json"
# Kept with a partitioned table, so that no setting of the session changes while it is written.
_BY_PARTITION = "OPTIONS (partitionOverwriteMode 'dynamic')"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _clustered(key: Sequence[str], buckets: int) -> str:
    return f"CLUSTERED BY ({', '.join(map(_quoted, key))}) INTO {buckets} BUCKETS"


class Warehouse(Mapping[str, DataFrame]):
    """The tables of one database, by name, as lazy DataFrames."""

    def __init__(self, spark: SparkSession, database: str, root: str):
        self.spark = spark
        self.database = database
        self.root = root.rstrip("/")
        location = _literal(f"{self.root}/managed")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)} LOCATION {location}")

    def _id(self, table: str) -> str:
        return f"{_quoted(self.database)}.{_quoted(table)}"

    def _properties(self, table: str) -> dict[str, str]:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self._id(table)}").collect()
        return {r["key"]: r["value"] for r in rows if r["key"].startswith("keyframe.")}

    # Reading

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self:
            raise KeyError(table)
        return self.spark.table(self._id(table))

    def __contains__(self, table: object) -> bool:
        return self.spark.catalog.tableExists(self._id(str(table)))

    def __iter__(self) -> Iterator[str]:
        for row in self.spark.sql(f"SHOW TABLES IN {_quoted(self.database)}").collect():
            if not row["isTemporary"]:
                yield self._properties(row["tableName"]).get(_NAME, row["tableName"])

    def __len__(self) -> int:
        return sum(1 for _ in self)

    def model(self, tables: Sequence[str] | None = None) -> KeyModel:
        """Columns and keys of the stored tables, from the catalog alone."""
        structs, keys, foreign = {}, {}, []
        for table in tables or list(self):
            properties = self._properties(table)
            structs[table] = self[table].schema
            keys[table] = tuple(json.loads(properties.get(_KEY, "[]")))
            foreign += [ForeignKey(table, *fk) for fk in json.loads(properties.get(_FOREIGN, "[]"))]
        # A parent left out by ``tables`` is still needed to describe the key.
        for fk in foreign:
            structs.setdefault(fk.parent, self[fk.parent].schema)
        return KeyModel(structs, {t: k for t, k in keys.items() if k}, tuple(foreign))

    def dimensions(self, model: KeyModel | None = None) -> dict[str, DataFrame]:
        """The distinct parent tables of all foreign keys, as lazy DataFrames."""
        return {parent: self[parent] for parent in (model or self.model()).parents()}

    def partition_columns(self, table: str) -> list[str]:
        return json.loads(self._properties(table).get(_PARTITIONS, "[]"))

    def buckets(self, table: str) -> int:
        """Into how many buckets of its primary key a table is dealt, 0 if it is not."""
        return int(self._properties(table).get(_BUCKETS, "0"))

    def primary_key(self, table: str) -> tuple[str, ...]:
        return tuple(json.loads(self._properties(table).get(_KEY, "[]")))

    def keys_not_null(self, table: str) -> bool:
        """Whether the foreign-key columns of ``table`` must not be NULL."""
        return self._properties(table).get(_NOT_NULL) == "true"

    # Creating

    def create(
        self,
        model: KeyModel,
        *,
        partition_by: Mapping[str, Sequence[str]] | None = None,
        bucket_by: Mapping[str, int] | None = None,
        not_null_keys: bool = True,
        replace: bool = False,
    ) -> None:
        """Create an empty typed table for every table of the model.

        ``partition_by`` names partition columns per table; they must be part of
        the primary key.  ``bucket_by`` says into how many buckets of its primary key a
        table without partitions is dealt.  ``replace`` drops tables of the same name first.
        """
        partition_by, bucket_by = partition_by or {}, bucket_by or {}
        for table, struct in model.structs.items():
            parts, buckets = list(partition_by.get(table, ())), bucket_by.get(table, 0)
            if buckets and (parts or not model.primary_keys.get(table)):
                raise ValueError(f"Buckets need a primary key and no partitions, not so in '{table}'")
            if any(c not in model.primary_keys.get(table, ()) for c in parts):
                raise ValueError(f"Partition columns {parts} must be in the primary key of '{table}'")
            foreign = [
                [fk.column, fk.parent, fk.parent_key, fk.parent_value] for fk in model.foreign_keys_of(table)
            ]
            properties = {
                _NAME: table,
                _KEY: json.dumps(model.primary_keys.get(table, ())),
                _FOREIGN: json.dumps(foreign),
                _NOT_NULL: json.dumps(not_null_keys),
                _PARTITIONS: json.dumps(parts),
                _BUCKETS: str(buckets),
            }
            columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in struct.fields)
            listed = ", ".join(f"{_literal(k)} = {_literal(v)}" for k, v in properties.items())
            if replace:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._id(table)}")
            if parts:
                place = f"{_BY_PARTITION} PARTITIONED BY ({', '.join(map(_quoted, parts))})"
            else:
                place = f"LOCATION {_literal(self._new_folder(table))}"
            if buckets:
                place = f"{_clustered(model.primary_keys[table], buckets)} {place}"
            self.spark.sql(
                f"CREATE TABLE {self._id(table)} ({columns}) USING parquet {place} TBLPROPERTIES ({listed})"
            )

    def require_keys_not_null(self, tables: Sequence[str]) -> None:
        """From now on refuse NULL in the foreign-key columns of ``tables``.

        Rows that hold one already are an error.
        """
        model = self.model(tables)
        for table in tables:
            nulls = foreign_key_nulls(self[table], table, model).filter("nulls > 0")
            require_empty(nulls, f"NULL in a foreign key column of '{table}'")
            self.spark.sql(f"ALTER TABLE {self._id(table)} SET TBLPROPERTIES ({_literal(_NOT_NULL)} = 'true')")

    def upload_dimensions(
        self,
        model: KeyModel,
        dimensions: Mapping[str, DataFrame],
        *,
        partition_by: Mapping[str, Sequence[str]] | None = None,
        bucket_by: Mapping[str, int] | None = None,
        not_null_keys: bool = True,
        replace: bool = False,
    ) -> None:
        """Create the tables of the model and fill the given dimensions.

        Dimensions may refer to each other, so their foreign keys are checked when
        all of them are there.
        """
        for name in dimensions:
            model.primary_key(name)
        options = {"partition_by": partition_by, "bucket_by": bucket_by}
        self.create(model, not_null_keys=not_null_keys, replace=replace, **options)
        for name, rows in dimensions.items():
            self._fill_dimension(name, rows, model)
        for name in dimensions:
            self._require_parents(name, self[name], model)

    def update_dimension(self, table: str, rows: DataFrame) -> None:
        """Upsert rows of one dimension by its primary key."""
        model = self.model([table])
        self._require_parents(table, rows, model)
        self._merge_dimension(table, rows, model)

    def _fill_dimension(self, table: str, rows: DataFrame, model: KeyModel) -> None:
        """First rows of a new dimension, with NULL in the columns they lack."""
        fields = self[table].schema.fields
        unknown = [c for c in rows.columns if c not in {f.name for f in fields}]
        if unknown:
            raise ValueError(f"Columns {unknown} do not exist in table '{table}'")
        self._require_sound_dimension(table, rows, model)
        lacking = {f.name: F.lit(None) for f in fields if f.name not in rows.columns}
        self.replace(table, rows.withColumns(lacking) if lacking else rows)

    def _merge_dimension(self, table: str, rows: DataFrame, model: KeyModel) -> None:
        key = model.primary_key(table)
        require_primary_key(rows, table, key)
        merged = merge_rows(self[table], rows, key, check_source=False)
        # Tables of other models may refer to the dimension too.
        self._require_distinct_values(table, merged, self.model())
        self.replace(table, merged)

    def _readable_values(self, table: str, rows: DataFrame, model: KeyModel) -> list[str]:
        return sorted({fk.parent_value for fk in model.foreign_keys if fk.parent == table} & set(rows.columns))

    def _require_sound_dimension(self, table: str, rows: DataFrame, model: KeyModel) -> None:
        """Refuse NULL and repeated keys and repeated readable values; all are looked for in one pass.

        Only when there is one, the reports that name them run.
        """
        values = self._readable_values(table, rows, model)
        problem = key_problems(rows, [model.primary_key(table), *([v] for v in values)], optional=1)
        if not problem.isEmpty():
            require_primary_key(rows, table, model.primary_key(table))
            self._require_distinct_values(table, rows, model)

    def _require_distinct_values(self, table: str, rows: DataFrame, model: KeyModel) -> None:
        """Refuse a readable value that two keys have: a lookup by it would multiply rows."""
        for value in self._readable_values(table, rows, model):
            twice = duplicate_keys(rows.filter(F.col(f"`{value}`").isNotNull()), [value])
            require_empty(twice, f"Values of '{table}.{value}' that stand for several keys")

    def _require_parents(self, table: str, rows: DataFrame, model: KeyModel) -> None:
        if model.foreign_keys_of(table):
            not_null = self.keys_not_null(table)
            require_foreign_keys(rows, table, model, self.dimensions(model), not_null=not_null)

    # Writing

    def _new_folder(self, table: str) -> str:
        now = datetime.now(timezone.utc)
        return f"{self.root}/{table}/data-{now:%Y%m%dT%H%M%S%fZ}-{uuid.uuid4().hex[:8]}"

    def _aligned(self, table: str, df: DataFrame) -> DataFrame:
        return df.select(
            *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self[table].schema.fields]
        )

    def location(self, table: str) -> str:
        """The folder that holds the rows of a table."""
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self._id(table)}").collect()
        return next(r["data_type"] for r in described if r["col_name"] == "Location").rstrip("/")

    def _prepare_write(self, table: str) -> dict[str, str]:
        """Properties of a table whose rows are about to change: a ledger would be wrong from now on."""
        properties = self._properties(table)
        if _LEDGER in properties:
            self.spark.sql(f"ALTER TABLE {self._id(table)} UNSET TBLPROPERTIES ({_literal(_LEDGER)})")
        if properties.get(_BUCKETS, "0") != "0":
            self.finish_swap(table)
        return properties

    def replace(self, table: str, df: DataFrame) -> None:
        """Replace the rows of ``table`` by ``df``, which may read the table itself.

        In a partitioned table, the partitions in which ``df`` has rows are replaced
        and the others stay.  Rows are first regrouped by partition, where adaptive
        execution splits a partition with very many rows over several tasks.
        """
        parts = json.loads(self._prepare_write(table).get(_PARTITIONS, "[]"))
        df = self._aligned(table, df)
        if parts:
            df.hint("rebalance", *parts).write.insertInto(self._id(table), overwrite=True)
        else:
            folder = self._write_folder(table, df)
            self.spark.sql(f"ALTER TABLE {self._id(table)} SET LOCATION {_literal(folder)}")
        self.spark.catalog.refreshTable(self._id(table))

    def _write_folder(self, table: str, df: DataFrame) -> str:
        """``df`` in a new folder of the table, dealt into its buckets if it has any."""
        folder, buckets = self._new_folder(table), self.buckets(table)
        if not buckets:
            df.write.parquet(folder)
            return folder
        key = self.primary_key(table)
        # Rows are only written in buckets through a table; this one goes again, its files stay.
        name = f"{_quoted(self.database)}.{_quoted('new_' + uuid.uuid4().hex)}"
        columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in self[table].schema.fields)
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet {_clustered(key, buckets)} LOCATION {_literal(folder)}"
        )
        try:
            df.repartition(buckets, *[F.col(f"`{c}`") for c in key]).write.insertInto(name)
        finally:
            self.spark.sql(f"DROP TABLE {name}")
        return folder

    def bucket_ids(self, table: str, keys: DataFrame) -> list[int]:
        """The buckets that rows with these primary keys belong to; at most as many as the table has."""
        # The rule by which Spark deals rows into buckets.
        cells = [F.col(f"`{c}`").cast(self[table].schema[c].dataType) for c in self.primary_key(table)]
        bucket = F.pmod(F.hash(*cells), F.lit(self.buckets(table))).alias("bucket")
        return sorted(r["bucket"] for r in keys.select(bucket).distinct().collect())

    def in_buckets(self, table: str, ids: Sequence[int]) -> DataFrame:
        """The rows of some buckets.  Spark lists and reads their files only, and still knows how they are dealt."""
        self.finish_swap(table)
        if len(ids) == self.buckets(table):
            return self[table]
        names = self._bucket_files(self.location(table), ids)
        return self[table].filter(F.col("_metadata.file_name").isin(names))

    def _bucket_files(self, folder: str, ids: Sequence[int]) -> list[str]:
        found = ((n, _BUCKET_OF.search(n)) for n in list_names(self.spark, folder))
        return [n for n, bucket in found if bucket and int(bucket[1]) in set(ids)]

    def replace_buckets(self, table: str, df: DataFrame, ids: Sequence[int]) -> None:
        """Replace the rows of some buckets by ``df``, which may read them; all other files stay as they are.

        New files are written first and then exchanged for the old ones.  What is to be exchanged is noted
        before, so that the next write completes an exchange that was broken off (:meth:`finish_swap`).
        """
        self._prepare_write(table)
        fresh = self._write_folder(table, self._aligned(table, df))
        folder = self.location(table)
        note = {"from": fresh, "new": list_names(self.spark, fresh), "old": self._bucket_files(folder, ids)}
        write_text(self.spark, f"{folder}/{_SWAP}", json.dumps(note))
        self.finish_swap(table)

    def finish_swap(self, table: str) -> None:
        """Complete an exchange of buckets that has begun; nothing to do otherwise."""
        folder = self.location(table)
        if not exists(self.spark, f"{folder}/{_SWAP}"):
            return
        note = json.loads(read_text(self.spark, f"{folder}/{_SWAP}"))
        for name in note["old"]:
            delete_folder(self.spark, f"{folder}/{name}")
        for name in note["new"]:
            move(self.spark, f"{note['from']}/{name}", f"{folder}/{name}")
        delete_folder(self.spark, f"{folder}/{_SWAP}")
        delete_folder(self.spark, note["from"])
        self.spark.catalog.refreshTable(self._id(table))

    def refill(self, table: str, df: DataFrame) -> None:
        """Replace all rows of ``table`` by ``df``, and leave them as they are if ``df`` cannot be read.

        In a partitioned table the new partitions are written first; then those go that ``df`` lacks.
        ``df`` is computed once: its rows are staged, since they are needed for both.
        """
        parts = self.partition_columns(table)
        if not parts:
            return self.replace(table, df)
        text = F.array(*[F.col(f"`{c}`").cast("string") for c in parts]).alias("values")
        with staged(self._aligned(table, df), table) as rows:
            old = {tuple(r["values"]) for r in self[table].select(text).distinct().collect()}
            new = {tuple(r["values"]) for r in rows.select(text).distinct().collect()}
            self.replace(table, rows)
        for values in sorted(old - new, key=str):
            spec = ", ".join(
                f"{_quoted(c)} = {'NULL' if v is None else _literal(v)}" for c, v in zip(parts, values)
            )
            self.spark.sql(f"ALTER TABLE {self._id(table)} DROP IF EXISTS PARTITION ({spec})")
        self.spark.catalog.refreshTable(self._id(table))

    def append(self, table: str, df: DataFrame) -> None:
        """Add the rows of ``df``, regrouped by partition as in :meth:`replace`."""
        properties = self._prepare_write(table)
        parts, df = json.loads(properties.get(_PARTITIONS, "[]")), self._aligned(table, df)
        if properties.get(_BUCKETS, "0") != "0":
            df = df.repartition(int(properties[_BUCKETS]), *[F.col(f"`{c}`") for c in json.loads(properties[_KEY])])
        (df.hint("rebalance", *parts) if parts else df).write.insertInto(self._id(table))
        self.spark.catalog.refreshTable(self._id(table))

    def empty(self, table: str) -> None:
        """Remove all rows."""
        if self.partition_columns(table):
            self._prepare_write(table)
            self.spark.sql(f"TRUNCATE TABLE {self._id(table)}")
        else:
            self.replace(table, self[table].filter(F.lit(False)))

    def remove_old_folders(self, table: str, keep: int = 1) -> list[str]:
        """Delete replaced folders of a table, except the newest ``keep`` of them.

        Not done on replacing, since a query may still read the folder before.
        Returns the deleted folders.
        """
        current = self.location(table)
        folder = f"{self.root}/{table}"
        names = [n for n in list_names(self.spark, folder) if n.startswith("data-")]
        old = [n for n in names if n != current.rsplit("/", 1)[-1]]
        removed = [f"{folder}/{n}" for n in old[: max(0, len(old) - keep)]]
        for path in removed:
            delete_folder(self.spark, path)
        return removed

    # Ledgers: sums of row hashes beside a table

    def ledger(self, table: str) -> dict | None:
        """What is known of a table's ledger: ``folder``, ``kept`` columns and ``algorithm``; None without a valid one."""
        text = self._properties(table).get(_LEDGER)
        return json.loads(text) if text else None

    def write_sums(self, table: str, sums: DataFrame) -> str:
        """Sums in a new folder, which :meth:`set_ledger` then makes valid."""
        folder = self._new_folder(table).replace("/data-", "/ledger-")
        sums.coalesce(1).write.parquet(folder)
        return folder

    def set_ledger(self, table: str, folder: str, kept: Sequence[str], algorithm: str) -> None:
        """The sums in ``folder`` describe the table as it is now; older ones go, but for the last."""
        note = json.dumps({"folder": folder, "kept": list(kept), "algorithm": algorithm})
        self.spark.sql(f"ALTER TABLE {self._id(table)} SET TBLPROPERTIES ({_literal(_LEDGER)} = {_literal(note)})")
        names = [n for n in list_names(self.spark, f"{self.root}/{table}") if n.startswith("ledger-")]
        for name in names[:-2]:
            delete_folder(self.spark, f"{self.root}/{table}/{name}")
