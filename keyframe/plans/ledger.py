"""Ledgers: tickets of whole stored tables that follow every write without a look at the table.

A ledger keeps, for each group of a ticket, the sums that its hash is made of.  A write adds the sums of the
rows it adds and takes off those of the rows it removes, both of which it has at hand, so the cost of an
up-to-date ticket is that of the change.  Any other replacement of the table's rows makes the ledger invalid.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from keyframe.functions.fingerprint import DEFAULT_ALGORITHM, SUM_COLS, add_sums
from keyframe.model import KeyModel
from keyframe.names import USUAL_GROUP_COLS
from keyframe.operators.keys import Dimensions, decode_keys
from keyframe.operators.tickets import group_columns, sum_rows, ticket_of_sums
from keyframe.sources.warehouse import Warehouse


def keep_ledger(
    store: Warehouse,
    table: str,
    *,
    usual: Sequence[str] | None = USUAL_GROUP_COLS,
    additional: Sequence[str] | None = None,
    algorithm: str = DEFAULT_ALGORITHM,
) -> None:
    """Start a ledger of a stored table, from one pass over it; upserts and copies keep it up to date.

    Its groups are those of the ``usual`` columns that the table has and of the ``additional`` ones.  They do
    not depend on the rows: whether a column is single-valued may change with any write.
    """
    kept = group_columns(store[table], usual=usual, additional=[*(additional or ())], keep_single=False)
    _write(store, table, sum_rows(store[table], kept, algorithm=algorithm), kept, algorithm)


def _write(store: Warehouse, table: str, sums: DataFrame, kept: Sequence[str], algorithm: str) -> None:
    store.set_ledger(table, store.write_sums(table, sums), kept, algorithm)


def ledger_sums(store: Warehouse, table: str) -> DataFrame:
    """The sums of a table's groups, without reading the table."""
    note = store.ledger(table)
    if note is None:
        raise ValueError(f"Table '{table}' has no valid ledger: start one with keep_ledger()")
    return store.spark.read.parquet(note["folder"])


def ledger_ticket(
    store: Warehouse, table: str, *, model: KeyModel | None = None, dims: Dimensions | None = None, decode: bool = True
) -> DataFrame:
    """The ticket of a stored table from its ledger, by default with readable keys."""
    sums = ledger_sums(store, table)
    taken = ticket_of_sums(sums, table, store[table].columns, algorithm=store.ledger(table)["algorithm"])
    if not decode:
        return taken
    model = model or store.model([table])
    return decode_keys(taken, table, model, store.dimensions(model) if dims is None else dims)


class Change:
    """A change of a table that has a ledger: the new sums are written before the rows change, and count afterwards.

    Nothing happens for a table without a ledger.
    """

    def __init__(self, store: Warehouse, table: str):
        self.store, self.table, self.note = store, table, store.ledger(table)

    def __bool__(self) -> bool:
        return self.note is not None

    def prepare(self, added: DataFrame | None = None, removed: DataFrame | None = None, *, whole: bool = False) -> None:
        """Sums after ``added`` rows came and ``removed`` ones went, both with the table's columns and types.

        With ``whole`` the added rows are all that the table will have.
        """
        if not self:
            return
        kept, algorithm = self.note["kept"], self.note["algorithm"]
        sums = lambda rows: [] if rows is None else [sum_rows(rows, kept, algorithm=algorithm)]
        before = [] if whole else [self.store.spark.read.parquet(self.note["folder"])]
        after = add_sums([*before, *sums(added)], sums(removed))
        columns = [*kept, *SUM_COLS]
        self.folder = self.store.write_sums(self.table, after.select(*[f"`{c}`" for c in columns]))

    def commit(self) -> None:
        """The table has changed as prepared."""
        if self:
            self.store.set_ledger(self.table, self.folder, self.note["kept"], self.note["algorithm"])
