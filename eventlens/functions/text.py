"""Text builders: ranked window reports (M5) and warning messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def format_time(c, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(F.col(c) if isinstance(c, str) else c, pattern)


def ranked_report(window_end: str, ranked: str, key: str = "key", cnt: str = "cnt",
                  rank: str = "rank") -> Column:
    """One text block per window from an array<struct<rank,key,cnt>> column (M5).

    ``time: <end>`` then ``No.<i>: <key> <cnt>`` per entry, built with
    ``transform`` + ``array_join`` (no Python).
    """
    lines = F.transform(
        F.array_sort(F.col(ranked)),
        lambda e: F.concat(F.lit("No."), e[rank].cast("string"), F.lit(": key="),
                           e[key].cast("string"), F.lit(" count="), e[cnt].cast("string")))
    return F.concat(F.lit("time: "), format_time(window_end), F.lit("\n"),
                    F.array_join(lines, "\n"), F.lit("\n"))


def warning_text(*parts) -> Column:
    """Concatenate literal strings and columns into a message."""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.concat(*[c.cast("string") for c in cols])
