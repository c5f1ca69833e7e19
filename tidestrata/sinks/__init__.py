"""Writers of layer tables."""

from tidestrata.sinks.ledger import append_once, log_changes, log_names
from tidestrata.sinks.merge import merge_latest
from tidestrata.sinks.tables import append, evolve, overwrite_partitions
from tidestrata.sinks.versions import publish

__all__ = [
    "append",
    "append_once",
    "evolve",
    "log_changes",
    "log_names",
    "merge_latest",
    "overwrite_partitions",
    "publish",
]
