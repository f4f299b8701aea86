from flowline.functions.scalars import (
    audit_time,
    contains_ignore_case,
    counter_name,
    equals_ignore_case,
    grouped_count,
    key_value,
    percentage,
    qualified_source_name,
    revision_or_empty,
    row_checksum,
    staging_name,
    strip_whitespace,
    table_name,
)

__all__ = [
    "audit_time",
    "contains_ignore_case",
    "counter_name",
    "equals_ignore_case",
    "grouped_count",
    "key_value",
    "percentage",
    "qualified_source_name",
    "revision_or_empty",
    "row_checksum",
    "staging_name",
    "strip_whitespace",
    "table_name",
]
