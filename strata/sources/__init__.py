from strata.sources.metrics import append_metrics, read_metrics
from strata.sources.stored_models import load_model, save_model
from strata.sources.tables import (
    describe_schema,
    drop_if_present,
    read_table,
    resolve_source,
    write_table,
)

__all__ = [
    "append_metrics",
    "describe_schema",
    "drop_if_present",
    "load_model",
    "read_metrics",
    "read_table",
    "resolve_source",
    "save_model",
    "write_table",
]
