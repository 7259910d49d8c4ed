"""Scalar column functions (F1-F19). All are built-in Spark expressions: they stay inside
whole-stage codegen and never call Python per row."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------------
# Fixed values that must equal the reference's behaviour.
# NA tokens a pandas ``read_csv(dtype=str)`` turns into missing values (F13), in natural order:
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# Log levels a tagged line can name; anything else is logged as info.
LOG_LEVELS = ["debug", "info", "warning", "error", "critical"]
LOG_LEVEL_PATTERN = r"(?i)@level@\[(.*?)\]"
# Report timestamp text format.
REPORT_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
# ---------------------------------------------------------------------------------------------


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_non_null(*cols: str | Column) -> Column:
    """coalesce of two or more columns."""
    return F.coalesce(*[col_(c) for c in cols])


def year_of(c: str | Column) -> Column:
    """calendar year as BIGINT (the width an embedded SQL engine returns)."""
    return F.year(col_(c)).cast("bigint")


def to_day(c: str | Column) -> Column:
    """timestamp -> date."""
    return col_(c).cast("date")


def year_bucket(year: str | Column, first: int, last: int) -> Column:
    """Year clamped into [first, last]; first bucket is `<= first`, last is `>= last`,
    a null year falls in no bucket (null)."""
    y = col_(year)
    return F.when(y.isNull(), F.lit(None)).otherwise(F.least(F.greatest(y, F.lit(first)), F.lit(last))).cast("bigint")


def parse_utc(c: str | Column) -> Column:
    """ISO text -> UTC wall-clock TIMESTAMP_NTZ; text without an offset is UTC. The wall clock
    is counted from the instant itself, so no session zone or clock change moves it. Null stays
    null; a malformed value raises under ANSI mode, as the reference's parser does."""
    text = col_(c)
    zoned = F.when(text.rlike(r"(Z|z|[+-]\d{2}(:?\d{2})?)$") & text.contains(":"), text) \
             .when(text.contains(":"), F.concat(text, F.lit("Z"))).otherwise(F.concat(text, F.lit("T00:00:00Z")))
    seconds = (F.unix_micros(F.to_timestamp(zoned)).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)


def format_ts(c: str | Column, fmt: str = REPORT_TS_FORMAT) -> Column:
    """timestamp -> text ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(col_(c), fmt)


def full_name(first: str | Column, last: str | Column, email: str | Column | None = None) -> Column:
    """F6 (+P12): ``first + ' ' + last``, null when either is null; when both are empty strings
    and an e-mail column is given, the e-mail is the name."""
    f, l_ = col_(first), col_(last)
    name = F.concat(f, F.lit(" "), l_)
    if email is None:
        return name
    return F.when((f == "") & (l_ == ""), col_(email)).otherwise(name)


def left_chars(c: str | Column, n: int) -> Column:
    """first n characters."""
    return F.substring(col_(c), 1, n)


def iso_week(c: str | Column) -> Column:
    """F8: ISO-8601 week number (spreadsheet week system 21)."""
    return F.weekofyear(col_(c).cast("date"))


def year_week(day_text: str | Column, week: str | Column) -> Column:
    """calendar year of the day text + '-' + ISO week, unpadded (2021-01-01 -> 2021-53)."""
    return F.concat(F.substring(col_(day_text), 1, 4), F.lit("-"), col_(week).cast("string"))


def seconds_between(later: str | Column, earlier: str | Column) -> Column:
    """Whole seconds from ``earlier`` to ``later`` on wall-clock (TIMESTAMP_NTZ) values: no time
    zone enters, so a daylight-saving change of the session zone cannot shift the result."""
    return F.timestamp_diff("SECOND", col_(earlier).cast("timestamp_ntz"), col_(later).cast("timestamp_ntz"))


def delay_hours(later: str | Column, earlier: str | Column) -> Column:
    """later - earlier in hours (null when later is null)."""
    return seconds_between(later, earlier) / F.lit(3600.0)


def delay_days(later: str | Column, earlier: str | Column) -> Column:
    """later - earlier in days."""
    return seconds_between(later, earlier) / F.lit(86400.0)


def fixed_decimal_text(c: str | Column, scale: int = 3) -> Column:
    """Number -> text with a fixed number of decimals (stable across engines)."""
    return F.round(col_(c), scale).cast(f"decimal(38,{scale})").cast("string")


def blank_if_null(c: str | Column) -> Column:
    """F11 for one column: cast to text, null -> ''."""
    return F.coalesce(col_(c).cast("string"), F.lit(""))


def na_to_null(c: str | Column, tokens: list[str] | None = None) -> Column:
    """the pandas NA tokens become null; other text is kept as is."""
    x = col_(c)
    return F.when(x.isin(tokens if tokens is not None else NA_TOKENS), F.lit(None).cast("string")).otherwise(x)


def run_timestamp(ts: datetime) -> Column:
    """one load timestamp per run, computed once on the driver (not per row/table). Passed
    as text so that no session or process time zone shifts the wall-clock value."""
    return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def interval_label(start: date, end: date) -> str:
    """``yyyymmdd-yyyymmdd`` label of a run interval (driver-side, becomes a partition value)."""
    return f"{start:%Y%m%d}-{end:%Y%m%d}"


def base64_text(c: str | Column) -> Column:
    """F16: UTF-8 bytes -> base64 text on one line (Spark may wrap at 76 characters)."""
    return F.regexp_replace(F.base64(F.encode(col_(c), "UTF-8")), r"[\r\n]", "")


def as_text(c: str | Column, data_type: str) -> Column:
    """Bytes -> UTF-8 text, text unchanged, anything else -> ''."""
    x = col_(c)
    if data_type == "binary":
        return F.coalesce(F.decode(x, "UTF-8"), F.lit(""))
    if data_type == "string":
        return F.coalesce(x, F.lit(""))
    return F.lit("")


def rstrip_ws(c: str | Column) -> Column:
    """Remove trailing whitespace (all kinds, as Python's ``rstrip()``)."""
    return F.regexp_replace(col_(c), r"\s+$", "")


def log_tag(c: str | Column) -> Column:
    """lower-cased text of the first ``@level@[...]`` tag, null when the line has none."""
    x = col_(c)
    return F.when(x.rlike(LOG_LEVEL_PATTERN), F.lower(F.regexp_extract(x, LOG_LEVEL_PATTERN, 1)))


def log_level(c: str | Column) -> Column:
    """the level the line is logged at: its tag when it names a known level, else info."""
    tag = log_tag(c)
    return F.when(tag.isin(LOG_LEVELS), tag).otherwise(F.lit("info"))


def csv_field(c: str | Column) -> Column:
    """One CSV cell as pandas ``to_csv`` writes it: quoted (quotes doubled) when the text holds
    a comma, a quote or a line break; null -> empty."""
    x = col_(c).cast("string")
    quoted = F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.coalesce(F.when(x.rlike('[",\r\n]'), quoted).otherwise(x), F.lit(""))


def csv_line(*cols: str | Column) -> Column:
    return F.concat_ws(",", *[csv_field(c) for c in cols])
