"""Column expressions shared by every layer (all JVM-side built-ins, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

CANCELED_STATUSES = ("canceled", "unavailable")


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round2(c: str | Column, digits: int = 2) -> Column:
    """Half-away-from-zero rounding of a double, as a numeric ROUND would do it.

    The value goes through DECIMAL(38,10) first so binary float noise cannot push a tie
    to the wrong side; the result is a double again.
    """
    return F.round(col(c).cast("decimal(38,10)"), digits).cast("double")


def initcap_words(c: str | Column) -> Column:
    """INITCAP where a word starts after any non-alphanumeric character.

    Spark's own ``initcap`` only starts a word after a space, so ``mogi-guacu`` would stay
    ``Mogi-guacu``. The string is split into runs of letters/digits and runs of other
    characters; each run gets its first character upper-cased.
    """
    runs = F.regexp_extract_all(F.lower(col(c)), F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), F.lit(1))
    return F.array_join(
        F.transform(runs, lambda x: F.concat(F.upper(F.substr(x, F.lit(1), F.lit(1))), F.substr(x, F.lit(2)))),
        "")


EPOCH_NTZ = "1970-01-01 00:00:00"


def wall_clock_seconds(ts: str | Column) -> Column:
    """Exact seconds (DECIMAL, microsecond precision) from 1970-01-01 00:00 to a wall-clock
    TIMESTAMP_NTZ. Built on NTZ subtraction, which is zone-free; ``timestamp_diff`` and
    casts to TIMESTAMP would read the session time zone (and its DST gaps)."""
    iv = col(ts) - F.lit(EPOCH_NTZ).cast("timestamp_ntz")
    whole = (F.extract(F.lit("DAY"), iv).cast("decimal(20,0)") * 86400
             + F.extract(F.lit("HOUR"), iv) * 3600 + F.extract(F.lit("MINUTE"), iv) * 60)
    return (whole + F.extract(F.lit("SECOND"), iv)).cast("decimal(20,6)")


def seconds_between(end: str | Column, start: str | Column) -> Column:
    """Exact seconds ``end - start`` as DECIMAL (negative when end is earlier)."""
    return wall_clock_seconds(end) - wall_clock_seconds(start)


def hours_between(end: str | Column, start: str | Column) -> Column:
    """Fractional hours ``end - start`` (negative when end is earlier); NULL-propagating."""
    return seconds_between(end, start).cast("double") / F.lit(3600.0)


def hours_between_seconds(end: str | Column, start: str | Column) -> Column:
    """Second boundaries crossed between the two instants, divided by 3600.0."""
    whole = F.floor(wall_clock_seconds(end)) - F.floor(wall_clock_seconds(start))
    return whole.cast("double") / F.lit(3600.0)


def elapsed_days(start: str | Column, end: str | Column) -> Column:
    """Number of whole 24-hour periods between two timestamps (truncated toward zero)."""
    return (seconds_between(end, start) / 86400).cast("bigint")


def boundary_days(start: str | Column, end: str | Column) -> Column:
    """Number of midnights crossed going from ``start`` to ``end``."""
    return F.datediff(F.to_date(col(end)), F.to_date(col(start)))


def wall_clock_text(ts: str | Column, minutes_only: bool = False) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` (or ``yyyy-MM-dd HH:mm``) of a TIMESTAMP_NTZ, zone-free
    (``date_format`` would pass through the session time zone)."""
    text = col(ts).cast("string")
    return F.substring(text, 1, 16) if minutes_only else F.substring(text, 1, 19)


def year_month(ts: str | Column) -> Column:
    """``yyyyMM`` of a date or timestamp, zone-free."""
    d = F.to_date(col(ts))
    return (F.year(d) * 100 + F.month(d)).cast("string")


def month_start(ts: str | Column) -> Column:
    """First day of the month of a date/timestamp, as TIMESTAMP_NTZ (zone-free)."""
    return F.trunc(F.to_date(col(ts)), "month").cast("timestamp_ntz")


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """``num / NULLIF(den, 0)`` as a double; NULL instead of a division error."""
    return F.try_divide(col(num).cast("double"), F.nullif(col(den), F.lit(0)).cast("double"))


def integer_ratio(num: str | Column, den: str | Column) -> Column:
    """Integer division truncating toward zero (SQL ``int / int``), NULL for a zero divisor."""
    d = F.nullif(col(den), F.lit(0))
    return (col(num).cast("decimal(38,0)") / d.cast("decimal(38,0)")).cast("bigint")


def not_canceled(status: str | Column = "order_status") -> Column:
    """SQL ``status NOT IN ('canceled','unavailable')``: a NULL status is dropped."""
    return ~col(status).isin(*CANCELED_STATUSES)


def not_canceled_keep_null(status: str | Column = "order_status") -> Column:
    """pandas ``~isin``: a NULL status is kept."""
    return col(status).isNull() | ~col(status).isin(*CANCELED_STATUSES)


def null_or_negative_to_zero(c: str | Column) -> Column:
    x = col(c)
    return F.when(x.isNull() | (x < 0), F.lit(0).cast("double")).otherwise(x)


def clamp_keep_null(c: str | Column, lo: int = 1, hi: int = 5) -> Column:
    """Clamp to [lo, hi]; NULL stays NULL (``least``/``greatest`` would skip the NULL)."""
    x = col(c)
    return F.when(x < lo, F.lit(lo)).when(x > hi, F.lit(hi)).otherwise(x)


def pct(part: str | Column, total: str | Column) -> Column:
    """``ROUND(100.0 * part / total, 2)`` computed in double precision."""
    return round2(F.lit(100.0) * col(part).cast("double") / col(total).cast("double"))


def format_amount(c: str | Column) -> Column:
    """Thousands separators and two decimals, e.g. 10,000,000.00."""
    return F.format_number(col(c), 2)



def epoch_seconds(ts: str | Column) -> Column:
    """Whole seconds since 1970-01-01 00:00 of a wall-clock (UTC) timestamp."""
    return F.floor(wall_clock_seconds(ts)).cast("bigint")


def epoch_to_local(epoch_s: str | Column, zone: str | Column) -> Column:
    """Epoch seconds (UTC) -> wall-clock time in ``zone`` (a TIMESTAMP_NTZ)."""
    utc = F.lit(EPOCH_NTZ).cast("timestamp_ntz") + F.make_dt_interval(secs=col(epoch_s).cast("decimal(18,6)"))
    z = F.lit(zone) if isinstance(zone, str) else zone
    return F.convert_timezone(F.lit("UTC"), z, utc)


def share_of_group_total(part: str | Column) -> Column:
    """``ROUND(100 * part / SUM(part) OVER (), 2)`` for a result that is already grouped by a
    small, bounded dimension (review score, status, payment type, category). The window sees
    one row per group, so the whole (tiny) result in one task is fine, and the expensive input
    is computed once instead of once more for a separate total."""
    from pyspark.sql import Window
    return pct(part, F.sum(col(part)).over(Window.partitionBy()))
