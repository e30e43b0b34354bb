"""The total order of readings: time, then row id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros(ts: str = "timestamp") -> Column:
    """Microseconds since 1970 of the written wall-clock time in column ``ts``.

    Built from date parts, so a TIMESTAMP_NTZ never passes through the session zone,
    where times skipped by a clock change would fold onto later ones.
    """
    return F.expr(_micros(ts))


def _micros(ts: str) -> str:
    minutes = f"(CAST(unix_date(CAST({ts} AS DATE)) AS BIGINT) * 24 + hour({ts})) * 60 + minute({ts})"
    seconds = f"CAST(date_part('SECOND', {ts}) * 1000000 AS BIGINT)"
    return f"(({minutes}) * 60000000 + {seconds})"


def arrival(ts: str = "timestamp", row_id: str = "row_id") -> Column:
    """(``ts``, ``row_id``) as one number, for row ids from 0 to below 10**18.

    A number fits the fixed-width buffers of hash aggregation; ``max_by`` over a struct
    would make Spark sort every partition first.
    """
    return F.expr(
        f"CAST({_micros(ts)} AS DECIMAL(18, 0)) * CAST(1000000000000000000 AS DECIMAL(19, 0))"
        f" + CAST({row_id} AS DECIMAL(18, 0))"
    )
