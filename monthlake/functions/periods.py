"""Period text, HTTP dates and download-link helpers (raw-ingest planning)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Portuguese month names by two-digit month number, as the source publishes them.
MONTH_NAMES_PT = {
    "01": "janeiro",
    "02": "fevereiro",
    "03": "marco",
    "04": "abril",
    "05": "maio",
    "06": "junho",
    "07": "julho",
    "08": "agosto",
    "09": "setembro",
    "10": "outubro",
    "11": "novembro",
    "12": "dezembro",
}

HTTP_DATE_FORMAT = "EEE, dd MMM yyyy HH:mm:ss 'GMT'"
_HTTP_DATE_BODY = "dd MMM yyyy HH:mm:ss 'GMT'"
_HTTP_DATE_RE = r"^[A-Za-z]{3}, \d{2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2} GMT$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _month_map() -> Column:
    return F.create_map(*[F.lit(x) for kv in MONTH_NAMES_PT.items() for x in kv])


def parse_period(c) -> Column:
    """Free period text -> struct(year, month_num, month_name), all strings.

    year: first run of 4 digits. month_num: first 1-2 digits left after removing that
    year, zero-padded; else the first month (calendar order) whose name or 3-letter
    prefix occurs in the lower-cased text. month_name: Portuguese name, NULL when the
    number is not a month (``'13/2024'``). ``'092024'`` reads as year ``'0920'``, month ``'24'``.
    """
    c = _col(c)
    year = F.nullif(F.regexp_extract(c, r"(\d{4})", 1), F.lit(""))
    rest = F.when(year.isNull(), c).otherwise(F.replace(c, year, F.lit("")))
    digits = F.nullif(F.regexp_extract(rest, r"(\d{1,2})", 1), F.lit(""))
    low = F.lower(c)
    by_name = None
    for num, name in MONTH_NAMES_PT.items():
        hit = low.contains(name) | low.contains(name[:3])
        by_name = F.when(hit, F.lit(num)) if by_name is None else by_name.when(hit, F.lit(num))
    month = F.coalesce(F.lpad(digits, 2, "0"), by_name)
    return F.struct(year.alias("year"), month.alias("month_num"),
                    F.try_element_at(_month_map(), month).alias("month_name"))


def to_period(c) -> Column:
    """Free period text -> ``yyyy-MM``: parse first (``parse_period``), then validate.
    Text without a year or month gives NULL; a month number that is not a month
    (``'13/2024'``) fails under ANSI, like a wrong ``%Y-%m`` string."""
    p = parse_period(c)
    return period_from_parts(p["year"], p["month_num"])


def period_from_parts(year, month_num) -> Column:
    """``yyyy-MM`` from parsed year and month texts (NULL if either is missing)."""
    y, m = _col(year), _col(month_num)
    return normalize_period(F.when(y.isNotNull() & m.isNotNull(), F.concat(y, F.lit("-"), m)))


def current_period() -> Column:
    """Default period: the current month as ``yyyy-MM`` (session time zone)."""
    return F.date_format(F.current_date(), "yyyy-MM")


def normalize_period(c) -> Column:
    """Validate and normalise ``yyyy-MM`` text (``2024-3`` too; error on anything else under ANSI)."""
    return F.date_format(F.to_date(_col(c), "yyyy-M"), "yyyy-MM")


def format_http_date(c) -> Column:
    """Timestamp -> ``'Wed, 21 Oct 2015 07:28:00 GMT'`` (wall time taken as GMT)."""
    return F.date_format(_col(c), HTTP_DATE_FORMAT)


def parse_http_date(c) -> Column:
    """``Last-Modified`` header -> timestamp without time zone (GMT wall time).

    Malformed or missing headers give NULL, i.e. the link counts as undated."""
    c = _col(c)
    return F.when(c.rlike(_HTTP_DATE_RE),
                  F.to_timestamp_ntz(F.substring(c, 6, 64), F.lit(_HTTP_DATE_BODY)))


def download_url(c) -> Column:
    """Listing link -> direct download link (``/view`` -> ``/@@download/file``)."""
    return F.replace(_col(c), F.lit("/view"), F.lit("/@@download/file"))


def file_name(c) -> Column:
    """Last path segment after dropping ``/view``."""
    return F.substring_index(F.replace(_col(c), F.lit("/view"), F.lit("")), "/", -1)


def extension(c) -> Column:
    """Text after the last dot, lower case."""
    return F.lower(F.substring_index(_col(c), ".", -1))
