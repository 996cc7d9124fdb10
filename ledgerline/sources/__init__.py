"""Sources (driver parquet, role tables) and sinks (layer writers)."""

from ledgerline.sources.fixtures import ROLE_TABLES, RoleTables, role_table_sql  # noqa: F401
from ledgerline.sources.sinks import materialize, read_layer, write_layer  # noqa: F401
from ledgerline.sources.tables import DRIVER_TABLES, read_table  # noqa: F401
