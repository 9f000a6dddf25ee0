"""Time parsing and calendar columns.

Syslog time carries no year, so the year is always a parameter (never "now").
Parsed values are TIMESTAMP_NTZ: wall-clock time, independent of the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import NIGHT_HOURS

SYSLOG_FORMAT = "MMM d HH:mm:ss yyyy"
MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"
# a time in the form that loggers write: its parts stand at fixed places
_PLAIN = r"^(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec) ( [1-9]|[12][0-9]|3[01]) ([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]\z"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def syslog_timestamp(ts_text, year: int) -> Column:
    """'Jan  2 03:04:05' + year → TIMESTAMP_NTZ; unparsable (e.g. Feb 29 of 2025) → NULL.

    The plain form is cut into its numbers; other spacing or case goes through the formatter, which
    takes several times as long."""
    txt = _col(ts_text).cast("string")
    number = lambda at, n: F.ltrim(F.substring(txt, at, n)).try_cast("int")
    month = ((F.instr(F.lit(MONTHS), F.substring(txt, 1, 3)) + 2) / 3).cast("int")
    cut = F.try_make_timestamp_ntz(F.lit(int(year)), month, number(5, 2), number(8, 2), number(11, 2),
                                   number(14, 2).cast("decimal(16,6)"))
    norm = F.regexp_replace(F.trim(txt), r"\s+", " ")
    parsed = F.try_to_timestamp(F.concat(norm, F.lit(f" {int(year)}")), F.lit(SYSLOG_FORMAT))
    return F.when(txt.rlike(_PLAIN), cut).otherwise(parsed.cast("timestamp_ntz"))


def any_timestamp(ts, year: int) -> Column:
    """Per-row: syslog form with the given year, else a generic timestamp text, else NULL.

    Already-typed timestamps pass through unchanged.
    """
    c = _col(ts)
    txt = c.cast("string")
    generic = F.try_to_timestamp(txt).cast("timestamp_ntz")
    return F.coalesce(syslog_timestamp(txt, year), generic)


def is_night(hour) -> Column:
    return F.coalesce(_col(hour).isin(NIGHT_HOURS).cast("int"), F.lit(0))
