"""Sources and sinks: driver tables, role binding, CSV in/out."""

from .tables import (  # noqa: F401
    TPCH_TRANSACTION_ROLES,
    bind_roles,
    dirty_master,
    dirty_transactions,
    product_master,
    read_table,
    transactions,
)
from .csv_io import read_csv, write_csv, write_manifest  # noqa: F401
