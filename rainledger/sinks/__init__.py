"""Writers: staged tables, versioned folders, landed JSON, rebuilt and typed tables, database targets."""

from .database import switching_statement, write_jdbc
from .partitions import (
    partition_path,
    read_table,
    table_path,
    write_by_region,
    write_landing_json,
    write_partition,
    write_table,
)
from .staging import shared_folder, stage, staging_scope
from .tables import (
    conform,
    declared_columns,
    ensure_schemas,
    rebuild_table,
    recreate_views,
    replace_typed,
    with_audit,
)
from .versions import current_folder, finished_versions, write_version

__all__ = [
    "conform",
    "current_folder",
    "declared_columns",
    "ensure_schemas",
    "finished_versions",
    "partition_path",
    "read_table",
    "rebuild_table",
    "recreate_views",
    "replace_typed",
    "shared_folder",
    "stage",
    "staging_scope",
    "switching_statement",
    "table_path",
    "with_audit",
    "write_by_region",
    "write_jdbc",
    "write_landing_json",
    "write_partition",
    "write_table",
    "write_version",
]
