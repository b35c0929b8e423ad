"""Readers: databases over JDBC, date partitions, landed JSON, API payloads, fixed tables."""

from .files import assert_readable, read_folder, read_landing_json, read_partition
from .fixed import DATASETS, LOCATIONS, ingest_plan, inline_rows, locations, regional_orders
from .ingest import CUSTOMER_TABLES, SALES_TABLES, TableSpec, ingest_tables, validate_manifest
from .jdbc import count_jdbc, cuts, equal_shares, jdbc_options, jdbc_reader, key_range, read_jdbc, share_query, split_predicates
from .payload import RECORD_SCHEMA, flatten_daily_payload, payloads_without_days

__all__ = [
    "CUSTOMER_TABLES",
    "DATASETS",
    "LOCATIONS",
    "RECORD_SCHEMA",
    "SALES_TABLES",
    "TableSpec",
    "assert_readable",
    "count_jdbc",
    "cuts",
    "equal_shares",
    "flatten_daily_payload",
    "ingest_plan",
    "ingest_tables",
    "inline_rows",
    "jdbc_options",
    "jdbc_reader",
    "key_range",
    "locations",
    "payloads_without_days",
    "read_folder",
    "read_jdbc",
    "read_landing_json",
    "read_partition",
    "regional_orders",
    "share_query",
    "split_predicates",
    "validate_manifest",
]
