"""Column -> Column cleaning and display expressions.

All native Catalyst expressions (stay inside whole-stage codegen). Spark runs in ANSI
mode, so every lenient parse goes through ``try_*`` functions or a regex guard.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = "Column | str"

# Seconds per round, centimetres per foot and per inch, bonus-image suffixes,
# method codes. They must equal the source data's conventions.
ROUND_SECONDS = 300
CM_PER_FOOT = 30.48
CM_PER_INCH = 2.54
DECISION_CODES = ("U-DEC", "S-DEC", "M-DEC")
KNOCKOUT_CODE = "KO/TKO"
SUBMISSION_CODE = "SUB"

# A lenient decimal literal: optional sign, digits with optional fraction, optional exponent,
# surrounding whitespace allowed. Spark's own cast accepts more ('3d', '1f'), so guard it.
_NUMBER_RE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
# Python's str.strip() removes all Unicode whitespace; Java's \s needs the (?U) flag for that.
_LEAD_WS = r"(?U)^\s+"
_TRAIL_WS = r"(?U)\s+$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Python-style strip: leading and trailing Unicode whitespace."""
    return F.regexp_replace(F.regexp_replace(_c(c), _LEAD_WS, ""), _TRAIL_WS, "")


def to_number(c) -> Column:
    """Lenient numeric (pandas ``to_numeric(errors='coerce')``) -> double or NULL."""
    s = _c(c).cast("string")
    return F.when(s.rlike(_NUMBER_RE), F.trim(s).try_cast("double"))


def nullif_blank(c, *sentinels: str) -> Column:
    """Sentinel strings (default ``''``) -> NULL."""
    out = _c(c)
    for s in sentinels or ("",):
        out = F.when(out == F.lit(s), F.lit(None).cast("string")).otherwise(out)
    return out


def location_parts(c, width: int | None = None) -> Column:
    """Split ``city, state, country``. Returns struct(city, state, country).

    Per row (default): 3+ parts -> first, second, last; 2 -> city, country; 1 -> city.
    ``width`` (the widest row of the whole column, see ``cleaners.clean_events``) reproduces
    the column-wide rule: width>=3 -> state = part 2, country = part ``width`` (NULL when the
    row is shorter); width==2 -> country = part 2; width<=1 -> city only.
    """
    parts = F.transform(F.split(_c(c), ","), lambda x: strip(x))
    n = F.size(parts)
    city = F.get(parts, 0)
    if width is None:
        state = F.when(n >= 3, F.get(parts, 1))
        country = F.when(n >= 3, F.get(parts, n - 1)).when(n == 2, F.get(parts, 1))
    elif width >= 3:
        state = F.get(parts, 1)
        country = F.get(parts, width - 1)
    elif width == 2:
        state = F.lit(None).cast("string")
        country = F.get(parts, 1)
    else:
        state = F.lit(None).cast("string")
        country = F.lit(None).cast("string")
    return F.struct(city.alias("city"), state.alias("state"), country.alias("country"))


def height_to_cm(c) -> Column:
    """``5' 10"`` -> 177.8; no match -> NULL."""
    pat = r"(\d+)'\s*(\d+)"
    feet = F.regexp_extract(_c(c), pat, 1).try_cast("double")
    inches = F.regexp_extract(_c(c), pat, 2).try_cast("double")
    return feet * F.lit(CM_PER_FOOT) + inches * F.lit(CM_PER_INCH)


def reach_to_cm(c) -> Column:
    """``71"`` -> 180.34."""
    return to_number(strip(F.replace(_c(c), F.lit('"'), F.lit("")))) * F.lit(CM_PER_INCH)


def time_to_seconds(c) -> Column:
    """C4: ``m:ss`` or ``h:mm:ss`` -> seconds (double); anything else -> NULL."""
    s = _c(c)
    parts = F.transform(F.split(s, ":"), lambda x: to_number(x))
    n = F.size(parts)
    p0, p1, p2 = F.get(parts, 0), F.get(parts, 1), F.get(parts, 2)
    return (
        F.when(s.isNull() | (strip(s) == ""), F.lit(None).cast("double"))
        .when(n == 2, p0 * 60 + p1)
        .when(n == 3, p0 * 3600 + p1 * 60 + p2)
    )


def split_method(c) -> Column:
    """Multi-line method -> struct(short, detail): non-blank lines, first two."""
    lines = F.filter(F.transform(F.split(_c(c), "\n"), lambda x: strip(x)), lambda x: x != "")
    return F.struct(F.get(lines, 0).alias("short"), F.get(lines, 1).alias("detail"))


def parse_percentage(c) -> Column:
    """``37%`` -> 37.0; ``---`` and junk -> NULL."""
    return to_number(F.replace(_c(c), F.lit("%"), F.lit("")))


def parse_fraction(c) -> Column:
    """``20 of 53`` -> struct(landed=20.0, attempted=53.0)."""
    pat = r"(\d+)\s*of\s*(\d+)"
    # without a match the text is empty: a cast would raise and catch an error for every value
    landed, attempted = (F.nullif(F.regexp_extract(_c(c), pat, i), F.lit("")).try_cast("double") for i in (1, 2))
    return F.struct(landed.alias("landed"), attempted.alias("attempted"))


def method_type(c) -> Column:
    """Method code -> Decision / Knockout / Submission / Other (NULL -> Other)."""
    m = _c(c)
    return (
        F.when(m.isin(*DECISION_CODES), "Decision")
        .when(m == KNOCKOUT_CODE, "Knockout")
        .when(m == SUBMISSION_CODE, "Submission")
        .otherwise("Other")
    )


def participant_outcomes(c) -> Column:
    """``Win`` -> (Win, Loss); anything else shared by both participants."""
    r = _c(c)
    return F.struct(
        F.when(r == "Win", F.lit("Win")).otherwise(r).alias("first"),
        F.when(r == "Win", F.lit("Loss")).otherwise(r).alias("second"),
    )


def parse_date(c, fmt: str = "MMMM d, yyyy") -> Column:
    """Lenient date parse (no-break spaces and blanks tolerated) -> DATE or NULL."""
    s = strip(F.translate(_c(c), "\u00a0", " "))
    return F.to_date(F.try_to_timestamp(s, F.lit(fmt)))


def capitalize(c) -> Column:
    """C11: Python ``str.capitalize``: first char upper, the rest lower."""
    s = _c(c)
    return F.concat(F.upper(F.substring(s, 1, 1)), F.lower(F.substring(s, 2, 2147483647)))


def list_item(c, i: int) -> Column:
    """I-th element (0-based) or NULL."""
    return F.get(_c(c), i)


def fight_duration(time_seconds, round_no) -> Column:
    """C14: elapsed seconds = time in final round + full earlier rounds."""
    return _c(time_seconds) + (_c(round_no) - 1) * F.lit(ROUND_SECONDS)


def clean_label(c) -> Column:
    """NULL -> '', lower, strip, space -> '_', drop apostrophes."""
    s = strip(F.lower(F.coalesce(_c(c).cast("string"), F.lit(""))))
    return F.replace(F.replace(s, F.lit(" "), F.lit("_")), F.lit("'"), F.lit(""))


def composite_label(a, b) -> Column:
    """``lower(a) || '_' || lower(b)``; NULL if either is NULL."""
    return F.concat(F.lower(_c(a)), F.lit("_"), F.lower(_c(b)))


def safe_ratio(num, den) -> Column:
    """C17: num/den when den > 0 else NULL."""
    return F.when(_c(den) > 0, _c(num) / _c(den))


def wall_micros(a, b) -> Column:
    """Microseconds from b to a on the wall clock (naive datetimes, as pandas): both sides
    as TIMESTAMP_NTZ, so the session time zone and its DST changes play no part."""
    return F.timestamp_diff("MICROSECOND", _c(b).cast("timestamp_ntz"), _c(a).cast("timestamp_ntz"))


def day_diff(a, b) -> Column:
    """Whole days from b to a, floored (timedelta.days)."""
    return F.floor(wall_micros(a, b) / F.lit(86_400_000_000)).cast("bigint")


def seconds_to_clock(c) -> Column:
    """Seconds -> ``H:MM:SS`` or ``D day(s), H:MM:SS`` (str(timedelta))."""
    n = _c(c).cast("double").cast("bigint")
    days = F.floor(n / 86400).cast("bigint")
    rem = n - days * 86400
    hh = F.floor(rem / 3600).cast("bigint")
    mm = F.floor((rem % 3600) / 60).cast("bigint")
    ss = rem % 60
    clock = F.concat_ws(":", hh.cast("string"), F.lpad(mm.cast("string"), 2, "0"), F.lpad(ss.cast("string"), 2, "0"))
    day_part = F.concat(days.cast("string"), F.when(F.abs(days) == 1, F.lit(" day, ")).otherwise(F.lit(" days, ")))
    return F.when(n.isNull(), F.lit(None).cast("string")).when(days == 0, clock).otherwise(F.concat(day_part, clock))


def date_display(c) -> Column:
    """C20: ``March 05, 2024``."""
    return F.date_format(_c(c), "MMMM dd, yyyy")


def record_string(wins, losses, draws) -> Column:
    """``W-L-D`` with absent totals as 0."""
    parts = [F.coalesce(_c(x), F.lit(0)).cast("bigint").cast("string") for x in (wins, losses, draws)]
    return F.concat_ws("-", *parts)


def display_round(c, digits: int = 2) -> Column:
    """Half-even rounding (Python ``round``). Spark rounds the double's shortest decimal
    form, Python its exact binary value: they differ only when that form ends in 5 at the
    cut (2.675 -> 2.68 here, 2.67 in Python)."""
    return F.bround(_c(c), digits)


def zero_fill(c) -> Column:
    """NULL -> 0."""
    return F.coalesce(_c(c), F.lit(0))


def normalize_header(name: str) -> str:
    """Lower; drop '.'; space -> '_'; '%' -> 'pct'."""
    return name.lower().replace(".", "").replace(" ", "_").replace("%", "pct")


def normalize_header_col(c) -> Column:
    """E6 as a Column expression (header names stored as data)."""
    s = F.replace(F.lower(_c(c)), F.lit("."), F.lit(""))
    return F.replace(F.replace(s, F.lit(" "), F.lit("_")), F.lit("%"), F.lit("pct"))
