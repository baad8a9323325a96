"""Timecodes of subtitle files, as milliseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PATTERN = r"(?:(\d+):)?(\d{1,2}):(\d{2})[.,](\d{3})"


def parse(code: Column) -> Column:
    """``[HH:]MM:SS.mmm`` or with a comma as milliseconds; null where it doesn't match."""
    part = lambda i: F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(code, f"^\\s*{PATTERN}\\s*$", i), F.lit("")), F.lit("999999")).cast("long"), F.lit(0))
    return F.when(F.regexp_like(code, F.lit(f"^\\s*{PATTERN}\\s*$")), part(1) * 3_600_000 + part(2) * 60_000 + part(3) * 1000 + part(4))


def render(ms: Column, mark: str = ".", hours: bool = True) -> Column:
    """Milliseconds as ``HH:MM:SS`` + mark + ``mmm``; without ``hours`` those only from one hour on. Negative counts as 0."""
    t = F.greatest(ms, F.lit(0))
    h, m, s, f = F.floor(t / 3_600_000), F.floor(t / 60_000) % 60, F.floor(t / 1000) % 60, t % 1000
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    hour = F.when(h > 99, h.cast("string")).otherwise(two(h))
    rest = F.concat(two(m), F.lit(":"), two(s), F.lit(mark), F.lpad(f.cast("string"), 3, "0"))
    return F.concat(hour, F.lit(":"), rest) if hours else F.when(h > 0, F.concat(hour, F.lit(":"), rest)).otherwise(rest)
