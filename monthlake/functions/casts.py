"""Tolerant typing of raw text columns (bronze layer)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text tokens a pandas CSV read turns into missing values by default.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nullify_tokens(c, tokens=NULL_TOKENS) -> Column:
    """Missing-value tokens -> NULL; everything else kept as is."""
    c = _col(c)
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def to_int(c) -> Column:
    """Text -> int the way the warehouse's SQL engine casts: surrounding blanks ignored,
    ``'123.0'`` -> 123, halves round away from zero (``'123.5'`` -> 124); empty or
    non-numeric text, or a number outside the range, is an error whatever the session's ANSI
    setting; NULL stays NULL.

    Plain integers take the direct cast; only text that is not one goes through the
    exact decimal rounding. That path is a lambda: written out for each column it makes the
    stage's method so large that the JVM leaves it interpreted."""
    c = _col(c)

    def by_decimal(text: Column) -> Column:
        rounded = F.round(text.try_cast("decimal(38,10)"), 0)
        inside = rounded.between(-(2 ** 31), 2 ** 31 - 1)
        wrong = F.raise_error(F.concat(F.lit("not an integer: "), text)).cast("int")
        return (F.when(text.isNull(), F.lit(None).cast("int"))
                .when(inside, rounded.try_cast("int")).otherwise(wrong))

    return F.coalesce(c.try_cast("int"), F.transform(F.array(c), by_decimal)[0])


def to_money(c, decimal_comma: bool = False) -> Column:
    """Text -> decimal(18,2), half-up rounding. ``decimal_comma`` accepts ``'1.234,56'``."""
    c = _col(c)
    if decimal_comma:
        c = F.replace(F.replace(c, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return c.cast("decimal(18,2)")


def split_code_name(c, sep: str = " - "):
    """``'519940 - LEITURISTA'`` -> (519940, 'LEITURISTA'). Parts after the second
    separator are dropped; without a separator the name is ``''``; NULL -> (NULL, NULL)."""
    c = _col(c)
    code = to_int(F.split_part(c, F.lit(sep), F.lit(1)))
    name = F.trim(F.split_part(c, F.lit(sep), F.lit(2)))
    return code, name
