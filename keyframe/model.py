"""The key model: column types, primary keys and foreign keys of a set of tables.

A model is metadata only.  It is built from a schema table with one row per
column, or read back from the catalog by :class:`keyframe.sources.warehouse.Warehouse`.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from keyframe.functions.casting import DECLARED_TYPES, spark_type
from keyframe.names import KEY_SUFFIX, SCHEMA_TABLE_COLS


@dataclass(frozen=True)
class ForeignKey:
    """``table.column`` holds keys of ``parent.parent_key``, readable as ``parent.parent_value``."""

    table: str
    column: str
    parent: str
    parent_key: str
    parent_value: str


@dataclass(frozen=True)
class KeyModel:
    structs: dict[str, StructType]
    primary_keys: dict[str, tuple[str, ...]] = field(default_factory=dict)
    foreign_keys: tuple[ForeignKey, ...] = ()

    def __post_init__(self) -> None:
        for table, columns in self.primary_keys.items():
            missing = [c for c in columns if c not in self.struct(table).names]
            if missing:
                raise ValueError(f"Primary key columns {missing} are not in table '{table}'")
        for fk in self.foreign_keys:
            for table, column in ((fk.table, fk.column), (fk.parent, fk.parent_key)):
                if column not in self.struct(table).names:
                    raise ValueError(f"Foreign key {fk} names the unknown column '{table}.{column}'")

    @classmethod
    def from_schema_table(
        cls,
        schema_table: DataFrame | Iterable[Mapping],
        *,
        key_suffix: str = KEY_SUFFIX,
        value_columns: Mapping[str, str] | None = None,
    ) -> KeyModel:
        """Build a model from schema rows.

        The readable column of a parent is its key column without ``key_suffix``;
        ``value_columns`` (parent table to column) overrides that rule.  The rows
        are metadata, one per column, so they are read on the driver.
        """
        if isinstance(schema_table, DataFrame):
            schema_table = schema_table.select(*SCHEMA_TABLE_COLS).collect()
        table_col, name_col, pk_col, type_col, fk_table_col, fk_name_col = SCHEMA_TABLE_COLS
        fields: dict[str, list[StructField]] = {}
        keys: dict[str, list[str]] = {}
        foreign = []
        for row in schema_table:
            table, column = row[table_col], row[name_col]
            fields.setdefault(table, []).append(StructField(column, spark_type(row[type_col])))
            if str(row[pk_col]).strip().lower() == "true":
                keys.setdefault(table, []).append(column)
            # "NA" as text, an empty cell and NULL all mean "no foreign key".
            if row[fk_name_col] not in (None, "", "NA"):
                parent, parent_key = row[fk_table_col], row[fk_name_col]
                value = (value_columns or {}).get(parent) or parent_key.removesuffix(key_suffix)
                foreign.append(ForeignKey(table, column, parent, parent_key, value))
        return cls(
            {t: StructType(f) for t, f in fields.items()},
            {t: tuple(c) for t, c in keys.items()},
            tuple(foreign),
        )

    def struct(self, table: str) -> StructType:
        if table not in self.structs:
            raise ValueError(f"Table '{table}' is not in the model")
        return self.structs[table]

    def primary_key(self, table: str) -> tuple[str, ...]:
        self.struct(table)
        if not self.primary_keys.get(table):
            raise ValueError(f"Table '{table}' needs a primary key, and the model names none.")
        return self.primary_keys[table]

    def foreign_keys_of(self, table: str) -> tuple[ForeignKey, ...]:
        return tuple(fk for fk in self.foreign_keys if fk.table == table)

    def foreign_key(self, table: str, column: str) -> ForeignKey:
        found = [fk for fk in self.foreign_keys_of(table) if fk.column == column]
        if len({(fk.parent, fk.parent_key) for fk in found}) != 1:
            raise ValueError(f"Column '{table}.{column}' must have exactly one parent, found {len(found)}")
        return found[0]

    def parents(self) -> tuple[str, ...]:
        """Distinct parent tables, in order of first use."""
        return tuple(dict.fromkeys(fk.parent for fk in self.foreign_keys))

    def empty(self, spark: SparkSession, table: str) -> DataFrame:
        """A typed table with no rows."""
        return spark.createDataFrame([], self.struct(table))

    def schema_rows(self) -> list[dict]:
        """The model as schema-table rows, the inverse of :meth:`from_schema_table`."""
        declared = {spark: name for name, spark in DECLARED_TYPES.items()}
        rows = []
        for table, struct in self.structs.items():
            foreign = {fk.column: fk for fk in self.foreign_keys_of(table)}
            for col in struct.fields:
                fk = foreign.get(col.name)
                values = (
                    table,
                    col.name,
                    col.name in self.primary_keys.get(table, ()),
                    declared[col.dataType],
                    fk.parent if fk else "NA",
                    fk.parent_key if fk else "NA",
                )
                rows.append(dict(zip(SCHEMA_TABLE_COLS, values)))
        return rows
