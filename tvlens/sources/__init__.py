"""Sources (parquet readers, derived views) and sinks."""

from tvlens.sources.sinks import (  # noqa: F401
    fetch,
    read_written,
    register_view,
    schema_only,
    write_bucketed,
    write_table,
)
from tvlens.sources.tables import (  # noqa: F401
    CRM_COLUMNS,
    FIXTURE_AS_OF,
    LOG_COLUMNS,
    TABLES,
    crm,
    load_views,
    partner,
    read_table,
    viewing_logs,
)
