"""Column expressions shared by the operators; all are JVM-side built-ins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Key types whose missing value counts as zero; every other type's
# missing value counts as the empty string.
ZERO_DEFAULT_TYPES = ("int", "bigint")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_value(c: Column | str, data_type: str) -> Column:
    """A key column with null replaced by 0 or '' according to its type.

    Types other than int and bigint are compared as text, since their default
    is the empty string.
    """
    kind = data_type.strip().lower()
    if kind in ZERO_DEFAULT_TYPES:
        return F.coalesce(_col(c), F.lit(0).cast(kind))
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def row_checksum(columns: Sequence[Column | str], sep: str = "") -> Column:
    """md5 over the text of all columns, nulls as ''.

    Without a separator ``("ab", "c")`` and ``("a", "bc")`` have equal sums;
    pass ``sep`` to tell them apart.
    """
    texts = [F.coalesce(_col(c).cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws(sep, *texts))


def audit_time(as_of: Column | None = None) -> Column:
    return F.current_timestamp() if as_of is None else as_of


def contains_ignore_case(text: Column | str, part: Column | str) -> Column:
    return F.contains(F.lower(_col(text)), F.lower(_col(part)))


def equals_ignore_case(a: Column | str, b: Column | str) -> Column:
    return F.lower(_col(a)) == F.lower(_col(b))


def strip_whitespace(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), r"\s", "")


def grouped_count(c: Column | str) -> Column:
    """'1,234' -> 1234."""
    return F.replace(_col(c), F.lit(","), F.lit("")).cast("bigint")


def percentage(part: Column | str, total: Column | str) -> Column:
    return _col(part).cast("double") * F.lit(100.0) / F.nullif(_col(total).cast("double"), F.lit(0.0))


def qualified_source_name(namespace: Column | str, package: Column | str, name: Column | str) -> Column:
    """``"namespace"."package/name"``."""
    return F.format_string('"%s"."%s/%s"', _col(namespace), _col(package), _col(name))


def table_name(name: Column | str) -> Column:
    return F.lower(_col(name))


def staging_name(name: Column | str) -> Column:
    return F.concat(F.lit("stg_"), F.lower(_col(name)))


def counter_name(name: Column | str) -> Column:
    return F.concat(F.lit("sig_ctr_"), F.lower(_col(name)))


def revision_or_empty(revision: Column | str) -> Column:
    """The entity's revision, or one with no client and no version."""
    empty = F.struct(
        F.lit(None).cast("string").alias("client_id"), F.lit(None).cast("bigint").alias("version")
    )
    return F.coalesce(_col(revision), empty)
