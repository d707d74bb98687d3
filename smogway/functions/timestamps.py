"""Time expressions whose result never depends on the session time zone.

Instants are TIMESTAMP, wall clocks are TIMESTAMP_NTZ. Operators accept either as their time column.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smogway.settings import DEFAULTS

TimeLike = Column | datetime | str

# Fixed patterns: ISO-8601 as the cast reads it, an offset at its end, and the rarer spellings.
_PLAIN = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,9})?\s*(Z|[+-]\d{2}(:?\d{2})?)?$"
_OFFSET = r"[T ].*(Z|[+-]\d{2}(:?\d{2})?)$"
_RARE = (
    r"^(\d{4})-?(\d{2})-?(\d{2})"
    r"(?:[T ](\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d{1,9}))?)?)?)?"
    r"\s*(Z|[+-]\d{2}(?::?\d{2})?)?$"
)


def parse_instant(text: Column, naive_tz: str) -> Column:
    """ISO-8601 text to TIMESTAMP, NULL when unparsable; text without an offset is read in `naive_tz`.

    Reference `text` as a plain column: it is used several times.
    """
    zone = F.lit(naive_tz)
    plain = F.when(text.rlike(_OFFSET), text).otherwise(F.concat(text, zone))

    def part(n: int, default: str) -> Column:
        found = F.regexp_extract(text, _RARE, n)
        return F.when(found == "", F.lit(default)).otherwise(found)

    date = F.concat_ws("-", part(1, ""), part(2, ""), part(3, ""))
    time = F.concat_ws(":", part(4, "00"), part(5, "00"), part(6, "00"))
    rare = F.concat(date, F.lit("T"), time, F.lit("."), part(7, "0"), part(8, naive_tz))
    return (
        F.when(text.rlike(_PLAIN), plain)
        .when((F.length(text) == 10) & text.rlike(_RARE), F.concat(text, F.lit("T00:00:00"), zone))
        .when(text.rlike(_RARE), rare)
        .try_cast("timestamp")
    )


def utc_wall_clock(instant: Column) -> Column:
    """TIMESTAMP to TIMESTAMP_NTZ in UTC."""
    seconds = (F.unix_micros(instant) / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    zero = F.lit(0)
    return _ntz("1970-01-01") + F.make_dt_interval(zero, zero, zero, seconds)


def local_wall_clock(instant: Column, tz: str = DEFAULTS.timezone) -> Column:
    """TIMESTAMP to the TIMESTAMP_NTZ shown by a clock in `tz`."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc_wall_clock(instant))


def instant_from_wall_clock(wall_clock: Column, tz: str = "UTC") -> Column:
    """TIMESTAMP_NTZ read in `tz` to TIMESTAMP. Needed before a watermark, which rejects NTZ."""
    in_utc = wall_clock if tz == "UTC" else F.convert_timezone(F.lit(tz), F.lit("UTC"), wall_clock)
    elapsed = (in_utc - _ntz("1970-01-01")).cast("interval second").cast("decimal(18,6)")
    return F.timestamp_seconds(elapsed)


def time_bucket(ts: Column | str, width: str = "1 hour") -> Column:
    """Start of the fixed-width bucket; keeps the column's type and drops rows without a time."""
    return F.window(ts, width)["start"]


def floor_to_hour(df: DataFrame, column: str = "timestamp", width: str = "1 hour") -> DataFrame:
    return df.withColumn(column, time_bucket(F.col(column), width))


def hours(n: float) -> Column:
    """Day-time interval of `n` hours."""
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(n * 3600).cast("decimal(18,6)"))


def _ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def is_wall_clock(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.TimestampNTZType)


def time_literal(value: TimeLike, wall_clock: bool, tz: str = DEFAULTS.timezone) -> Column:
    """A point in time as a literal of the wanted type; naive values are read in `tz`."""
    if isinstance(value, Column):
        return value
    moment = datetime.fromisoformat(value) if isinstance(value, str) else value
    if wall_clock:
        if moment.tzinfo is not None:
            moment = moment.astimezone(ZoneInfo(tz)).replace(tzinfo=None)
        return _ntz(moment.isoformat(sep=" "))
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=ZoneInfo(tz))
    return F.lit(moment.astimezone(ZoneInfo("UTC")).isoformat()).cast("timestamp")


def like_column(value: TimeLike, df: DataFrame, column: str, tz: str = DEFAULTS.timezone) -> Column:
    """`time_literal` in the type of `df[column]`."""
    return time_literal(value, is_wall_clock(df, column), tz)


def time_value(value: TimeLike, df: DataFrame, column: str, tz: str = DEFAULTS.timezone) -> datetime:
    """`like_column` as a Python value: naive for a wall clock, in UTC for an instant."""
    wall_clock = is_wall_clock(df, column)
    literal = time_literal(value, wall_clock, tz)
    micros = F.unix_micros(instant_from_wall_clock(literal) if wall_clock else literal)
    (row,) = df.sparkSession.range(1).select(micros.alias("micros")).collect()
    moment = datetime(1970, 1, 1) + timedelta(microseconds=row["micros"])
    return moment if wall_clock else moment.replace(tzinfo=ZoneInfo("UTC"))


def parse_timestamp(
    df: DataFrame, column: str = "timestamp", naive_tz: str = "UTC", tz: str = DEFAULTS.timezone
) -> DataFrame:
    """Turn `column` into an instant and drop the rows that have none.

    Text is parsed row by row, wall clocks are read in `naive_tz`, instants pass through. `tz` only
    matters for display and is applied by `local_wall_clock` where a wall clock is wanted.
    """
    if column not in df.columns:
        raise ValueError(f"timestamp column {column!r} not found in {df.columns}")
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.StringType):
        parsed = parse_instant(F.col(column), naive_tz)
    elif isinstance(dtype, T.TimestampNTZType):
        parsed = instant_from_wall_clock(F.col(column), naive_tz)
    else:
        parsed = F.col(column)
    return df.withColumn(column, parsed).where(F.col(column).isNotNull())


def add_partition_columns(
    df: DataFrame, column: str = "timestamp", tz: str = DEFAULTS.timezone
) -> DataFrame:
    """Add year, month and day of the local wall clock; a frame without `column` is returned as is."""
    if column not in df.columns:
        return df
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.StringType):
        local = local_wall_clock(parse_instant(F.col(column), tz), tz)
    elif isinstance(dtype, T.TimestampNTZType):
        local = F.col(column)
    else:
        local = local_wall_clock(F.col(column), tz)
    return df.withColumns({"year": F.year(local), "month": F.month(local), "day": F.dayofmonth(local)})


def between_times(
    df: DataFrame,
    start: TimeLike | None = None,
    end: TimeLike | None = None,
    column: str = "timestamp",
) -> DataFrame:
    """Inclusive range on the raw time column, in the form the Parquet reader can push down."""
    if start is not None:
        df = df.where(F.col(column) >= like_column(start, df, column))
    if end is not None:
        df = df.where(F.col(column) <= like_column(end, df, column))
    return df


def prune(
    df: DataFrame,
    start: datetime,
    end: datetime | None = None,
    column: str = "timestamp",
    tz: str = DEFAULTS.timezone,
) -> DataFrame:
    """Inclusive time range that also prunes year/month[/day] partitions, which the range alone does not."""

    def local(moment: datetime) -> datetime:
        if moment.tzinfo is None:
            return moment
        return moment.astimezone(ZoneInfo(tz))

    def ordinal(moment: datetime, parts: list[str]) -> int:
        return sum(getattr(moment, p) * w for p, w in zip(parts, (10_000, 100, 1)))

    wall_clock = is_wall_clock(df, column)
    parts = [p for p in ("year", "month", "day") if p in df.columns]
    if parts[:2] == ["year", "month"]:
        key = sum((F.col(p) * w for p, w in zip(parts, (10_000, 100, 1))), F.lit(0))
        df = df.where(key >= ordinal(local(start), parts))
        if end is not None:
            df = df.where(key <= ordinal(local(end), parts))
    last = None if end is None else time_literal(end, wall_clock, tz)
    return between_times(df, time_literal(start, wall_clock, tz), last, column)
