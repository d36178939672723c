from oreflow.plans.lifecycle import (
    KEEP_SECONDS,
    append_table,
    conform,
    drop_table,
    ensure_published,
    ensure_table,
    is_streamed,
    laid_out,
    publish,
    repartition_table,
)
from oreflow.plans.specs import TableSpec, Warehouse

__all__ = [
    "KEEP_SECONDS",
    "TableSpec",
    "Warehouse",
    "append_table",
    "conform",
    "drop_table",
    "ensure_published",
    "ensure_table",
    "is_streamed",
    "laid_out",
    "publish",
    "repartition_table",
]
