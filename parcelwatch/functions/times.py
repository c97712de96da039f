"""Dates and timestamps, independent of the session time zone."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelwatch.functions.text import let, strip

MICROS_PER_DAY = 86_400_000_000

_DAY = r"\d{4}-\d{1,2}-\d{1,2}"
_CLOCK = r"([01]?\d|2[0-4]):\d{2}(:\d{2}(\.\d+)?)?"
_ZONE = r"(Z|[+-]\d{2}(:?\d{2})?)"

# Accepted spellings of a date besides ISO; extend through the ``formats`` argument.
DATE_FORMATS = ("M/d/yyyy", "M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "yyyy/M/d", "MMM d, yyyy")

# Spellings of a time besides ISO, by shape: letters A, numbers of four digits Y, other numbers 9. Months are names of
# three letters by then, weekday, zone and fraction are taken off. Dates of two numbers put the month first.
_DAY_SHAPES = {
    "9/9/Y": "M/d/y", "9-9-Y": "M-d-y", "9.9.Y": "d.M.y", "Y/9/9": "y/M/d", "Y.9.9": "y.M.d", "A 9, Y": "MMM d, y", "A 9 Y": "MMM d y",
    "9 A Y": "d MMM y", "9-A-Y": "d-MMM-y", "Y A 9": "y MMM d",
}
_CLOCK_SHAPES = {"": "", " 9:9": " H:m", " 9:9:9": " H:m:s", " 9:9 A": " h:m a", " 9:9:9 A": " h:m:s a", " 9:9A": " h:ma", " 9:9:9A": " h:m:sa"}
TIME_SHAPES = {d + c: f + g for d, f in _DAY_SHAPES.items() for c, g in _CLOCK_SHAPES.items()}
_WEEKDAY = "(?i)^(mon|tue|wed|thu|fri|sat|sun)[a-z]*[,.]? +"
_NAMED_ZONE = r"(?i) *(Z|UTC|GMT|[+-]\d{2}:?\d{2})$"


def _bare_sql(text: str) -> str:
    """SQL text: the spelling without weekday, zone and fraction, months cut to three letters, spaces single."""
    for pattern, to in (
        (_WEEKDAY, ""), (r"(?<=:\d{2}) *(?i:Z|UTC|GMT|[+-]\d{2}:?\d{2})$|(?<=[AaPp][Mm]) *(?i:Z|UTC|GMT|[+-]\d{2}:?\d{2})$", ""),
        (r"(:\d{2})\.\d+", "$1"), (r"([A-Za-z]{3})[a-z]+\.?", "$1"), (r"(\d),? +(?=\d{1,2}:)|(\d)T(?=\d{1,2}:)| at (?=\d{1,2}:)", "$1$2 "), (r" +", " "),
    ):
        text = f"regexp_replace({text}, r'{pattern}', '{to}')"
    return text


def _shape_sql(bare: str) -> str:
    shape = f"regexp_replace({bare}, r'\\b[0-9]{{4}}\\b', 'Y')"
    return f"regexp_replace(regexp_replace({shape}, r'[0-9]+', '9'), r'(?!Y\\b)[A-Za-z]+', 'A')"


def _other_micros_sql() -> str:
    """SQL text over ``stamp``: microseconds since the epoch of a spelling of ``TIME_SHAPES``, or of digits alone; else NULL."""
    read = " ".join(f"WHEN '{shape}' THEN try_to_timestamp(bare || ' +00', '{form} x')" for shape, form in TIME_SHAPES.items())
    digits = "WHEN '9' THEN CASE length(bare) WHEN 8 THEN try_to_timestamp(bare || ' +00', 'yyyyMMdd x') WHEN 14 THEN try_to_timestamp(bare || ' +00', 'yyyyMMddHHmmss x') END"
    zone = rf"regexp_extract(stamp, r'{_NAMED_ZONE}', 1)"
    minutes = "CASE WHEN zone RLIKE r'^[+-]' AND contains(bare, ':') THEN (cast(substr(zone, 1, 3) AS int) * 60 + if(startswith(zone, '-'), -1, 1) * cast(right(zone, 2) AS int)) ELSE 0 END"
    fraction = r"coalesce(cast(rpad(substr(nullif(regexp_extract(stamp, r':\d{2}\.(\d+)', 1), ''), 1, 6), 6, '0') AS bigint), 0)"
    micros = f"unix_micros(CASE shape {read} {digits} END) + {fraction} - 60000000L * ({minutes})"
    # The shape is bound as well: a CASE names its operand once for every branch.
    shaped = f"transform(array({_shape_sql('bare')}), shape -> {micros})[0]"
    return f"transform(array({_bare_sql('stamp')}), bare -> transform(array({zone}), zone -> {shaped})[0])[0]"


def time_shape_sql(text: str) -> str:
    """SQL text: the shape of a spelling, as in ``TIME_SHAPES``."""
    return _shape_sql(_bare_sql(f"trim(cast({text} AS string))"))


def epoch_micros_sql(text: str, kind: T.DataType | None = None) -> str:
    """SQL text: microseconds since the epoch of an ISO text, or one of the shapes of ``TIME_SHAPES``; NULL when it does not parse.

    Only texts that do not start as ISO ones do are looked at for their shape. A text without an offset is UTC. The offset is always made explicit before
    the cast, so the session time zone plays no part. Pass the column's type
    to read timestamp and date columns as they are.
    """
    if isinstance(kind, T.TimestampType):
        return f"unix_micros({text})"
    # The year guard keeps out texts the cast would read as today, such as '12:30' or 'now'.
    # The two common endings are told apart by position, the rare ones by pattern.
    zoned = (
        "CASE WHEN substring(stamp, 5, 1) <> '-' THEN NULL "
        "WHEN NOT contains(stamp, ':') THEN stamp || 'T00:00:00Z' "
        "WHEN right(stamp, 1) = 'Z' THEN stamp "
        "WHEN substring(stamp, -6, 1) IN ('+', '-') AND substring(stamp, -3, 1) = ':' "
        "THEN replace(stamp, ' +', '+') "
        f"WHEN stamp RLIKE r'{_ZONE}$' THEN replace(stamp, ' +', '+') "
        "ELSE stamp || 'Z' END"
    )
    iso = "substring(stamp, 5, 1) = '-' AND substring(stamp, 2, 1) <> '-' AND substring(stamp, 3, 1) <> '-'"
    # Rows without an event have a blank time; it is told at once, not by all shapes.
    micros = f"CASE WHEN stamp IS NULL OR stamp = '' THEN NULL WHEN {iso} THEN unix_micros(try_cast({zoned} AS timestamp)) ELSE {_other_micros_sql()} END"
    return f"transform(array(trim(cast({text} AS string))), stamp -> {micros})[0]"


def iso_utc(micros: Column) -> Column:
    """ISO-8601 UTC text ending in ``Z``; a fraction appears only when not zero."""
    seconds = (micros.cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    wall = F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), seconds
    )
    day_and_clock = F.split(wall.cast("string"), " ")
    padded = F.when(F.pmod(micros, F.lit(1_000_000)) == 0, F.lit(8)).otherwise(F.lit(15))
    # The cast drops trailing zeros of a fraction; a fraction is written in full.
    return F.concat(day_and_clock[0], F.lit("T"), F.rpad(day_and_clock[1], padded, F.lit("0")), F.lit("Z"))


def parse_date(
    c: Column, kind: T.DataType | None = None, formats: Sequence[str] = DATE_FORMATS
) -> Column:
    """Calendar date of a date-like column; NULL when it does not parse.

    Date columns are returned untouched so that a range filter on them still
    reaches the file scan.
    """
    if isinstance(kind, T.DateType):
        return c
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return c.cast("date")

    def read(s: Column) -> Column:
        iso = F.when(
            s.rlike(f"^{_DAY}([T ]{_CLOCK} ?{_ZONE}?)?$"),
            F.regexp_extract(s, f"^({_DAY})", 1).try_cast("date"),
        )
        return F.coalesce(iso, *(F.try_to_timestamp(s, F.lit(f)).cast("date") for f in formats))

    return let(strip(c.cast("string")), read)


def prior_week_range(ref: dt.date | None = None) -> tuple[dt.date, dt.date]:
    """Sunday and Saturday of the week before the one that holds ``ref``."""
    ref = ref or dt.date.today()
    saturday = ref - dt.timedelta(days=ref.isoweekday() % 7 + 1)
    return saturday - dt.timedelta(days=6), saturday


def prior_week_bounds(ref: Column) -> tuple[Column, Column]:
    """The same range for a date column."""
    weekday = F.dayofweek(ref)
    return F.date_sub(ref, weekday + 6), F.date_sub(ref, weekday)


def aware_now(now: dt.datetime | None) -> dt.datetime:
    """The reference instant; a value without a zone is refused."""
    if now is None:
        return dt.datetime.now(dt.timezone.utc)
    if now.tzinfo is None or now.utcoffset() is None:
        raise ValueError("reference_now needs a time zone")
    return now


def whole_days_before(now: dt.datetime, micros: Column) -> Column:
    """Whole 24-hour days from ``micros`` to ``now``, rounded down; NULL stays NULL."""
    since_epoch = now.astimezone(dt.timezone.utc) - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    age = F.lit(since_epoch // dt.timedelta(microseconds=1)).cast("bigint") - micros
    day = F.lit(MICROS_PER_DAY)
    return ((age - F.pmod(age, day)) / day).cast("bigint")
