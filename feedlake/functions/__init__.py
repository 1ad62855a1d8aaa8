"""Scalar helpers (F1-F15), each a plain Spark ``Column`` expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: the characters Python's str.strip() removes (str.isspace)
PY_WHITESPACE = (
    r"[\t\n\x{0B}\x{0C}\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)

# fixed values: boolean tokens of the spreadsheet source (Portuguese sim/nao included)
BOOL_TOKENS = ("true", "false", "sim", "nao", "yes", "no", "0", "1")
TRUE_TOKENS = ("true", "sim", "yes", "1")
FALSE_TOKENS = ("false", "nao", "no", "0")


def qcol(name: str) -> Column:
    """Column by its exact name (dots, blanks and backticks in the name are literal)."""
    return F.col("`" + name.replace("`", "``") + "`")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# the same characters, as a plain set for btrim
PY_WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column | str) -> Column:
    """Python ``str.strip()``: remove leading and trailing whitespace (scans the ends only)."""
    return F.btrim(_c(c), F.lit(PY_WHITESPACE_CHARS))


def clean_text(c: Column | str) -> Column:
    """lower case, then strip."""
    return strip(F.lower(_c(c)))


def parse_datetime(c: Column | str, strict: bool = False) -> Column:
    """text to timestamp; null on bad input, or raise when ``strict``."""
    c = _c(c)
    return F.to_timestamp_ntz(c) if strict else c.try_cast("timestamp_ntz")


def month_text(c: Column | str) -> Column:
    """month period as ``YYYY-MM`` text."""
    return F.date_format(_c(c), "yyyy-MM")


def numeric_fill(c: Column | str, default: float = 0.0) -> Column:
    """numeric coerce; bad or missing -> ``default``."""
    return F.coalesce(_c(c).try_cast("double"), F.lit(float(default)))


def to_day(c: Column | str) -> Column:
    """date part of a timestamp."""
    return F.to_date(_c(c))


def decimal_comma(c: Column | str) -> Column:
    """number written with a decimal comma (``"1,5"`` -> 1.5)."""
    return F.replace(_c(c), F.lit(","), F.lit(".")).try_cast("double")


def is_bool_token(c: Column | str) -> Column:
    return F.lower(_c(c)).isin(*BOOL_TOKENS)


def bool_token(c: Column | str) -> Column:
    """boolean from a token (true/false, sim/nao, yes/no, 1/0); other text -> null."""
    low = F.lower(strip(_c(c)))
    return F.when(low.isin(*TRUE_TOKENS), F.lit(True)).when(low.isin(*FALSE_TOKENS), F.lit(False))


# fixed values: URL parts (F8, re-aimed from the spreadsheet URL to page URLs)
URL_SCHEME = r"^([a-z]+)://"
URL_HOST = r"^[a-z]+://([^/:?#]+)"
URL_PATH = r"^[a-z]+://[^/?#]*(/[^?#]*)?"
URL_LANG = r"^[a-z]+://[^/?#]*/([a-z]{2})/"
URL_ID = r"^[a-z]+://[^/?#]*/[a-z]{2}/(\d+)"
URL_PAGE = r"[?&]page=(\d+)"


def url_part(c: Column | str, pattern: str, group: int = 1) -> Column:
    """F8: one regex group of a URL, null when absent."""
    v = F.regexp_extract(_c(c), pattern, group)
    return F.when(v != "", v)


def source_name(tap: Column | str) -> Column:
    """last token of the command, file stem, without ``tap-``."""
    last = F.element_at(F.split(strip(_c(tap)), r"\s+"), -1)
    base = F.regexp_extract(last, r"([^/\\]+)$", 1)
    stem = F.regexp_replace(base, r"\.[^.]*$", "")
    return F.replace(stem, F.lit("tap-"), F.lit(""))


def table_name(c: Column | str) -> Column:
    """``-`` and blank to ``_``, lower case."""
    return F.lower(F.translate(_c(c), "- ", "__"))


def nan_to_default(c: Column | str, default: float = 0.0) -> Column:
    """NaN -> ``default`` (opt-in; NaN is kept otherwise)."""
    return F.nanvl(_c(c), F.lit(float(default)))


def log_key(ts: Column | str) -> Column:
    """run-log key ``YYYY-MM-DDTHH-MM-SS``, sortable as text."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH-mm-ss")


def iso_text(ts: Column | str) -> Column:
    """ISO text of a timestamp; the fraction only when it is not zero (``isoformat``)."""
    ts = _c(ts)
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(F.date_format(ts, "SSSSSS") == "000000", whole).otherwise(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )
