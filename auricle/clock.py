"""Time windows relative to a given instant.

`as_of` is always a Column: a literal, or a scalar subquery built by `latest`. Both reach the
scan as a comparison with one value, so Parquet row groups outside the window are skipped.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTITION_DATE = "created_date"


def at(moment: datetime) -> Column:
    """`as_of` given as a UTC datetime."""
    return F.lit(moment.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")


def now() -> Column:
    """`as_of` at the start of the query, in the session's zone (UTC)."""
    return F.localtimestamp()


def latest(df: DataFrame, column: str = "created_at") -> Column:
    """`as_of` taken from the data: the newest value of a column, as a scalar subquery.

    In a date-partitioned table only the newest day is read for it.
    """
    if column == "created_at" and PARTITION_DATE in df.columns:
        newest_day = df.agg(F.max(PARTITION_DATE)).scalar()
        df = df.filter(F.col(PARTITION_DATE) == newest_day)
    return df.agg(F.max(column)).scalar()


def before(as_of: Column, interval: str) -> Column:
    """`as_of` minus an interval such as '24 HOURS' or '7 DAYS'."""
    return as_of - F.expr(f"INTERVAL {interval}")


def recent(
    df: DataFrame, as_of: Column, interval: str = "24 HOURS", column: str = "created_at"
) -> DataFrame:
    """Rows newer than the window bound (strict). A date-partitioned table is pruned as well."""
    bound = before(as_of, interval)
    kept = df.filter(F.col(column) > bound)
    if column == "created_at" and PARTITION_DATE in df.columns:
        kept = kept.filter(F.col(PARTITION_DATE) >= F.to_date(bound))
    return kept
