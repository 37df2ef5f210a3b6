"""keyframe: versioned, dictionary-encoded tables on Spark."""

from keyframe.model import ForeignKey, KeyModel
from keyframe.plans.read import collect_ticket, filter_table, verify_ticket
from keyframe.plans.write import Written, compress_table, filter_copy, upsert
from keyframe.sources.warehouse import Warehouse

__all__ = [
    "ForeignKey",
    "KeyModel",
    "Warehouse",
    "Written",
    "collect_ticket",
    "compress_table",
    "filter_copy",
    "filter_table",
    "upsert",
    "verify_ticket",
]
