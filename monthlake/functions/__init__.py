"""Column -> Column helpers built only from ``pyspark.sql.functions`` (JVM-side, codegen'd)."""

from monthlake.functions.casts import NULL_TOKENS, nullify_tokens, split_code_name, to_int, to_money
from monthlake.functions.keys import period_key, surrogate_key
from monthlake.functions.periods import (
    MONTH_NAMES_PT,
    current_period,
    download_url,
    extension,
    file_name,
    format_http_date,
    normalize_period,
    parse_http_date,
    parse_period,
    to_period,
)

__all__ = [
    "NULL_TOKENS", "nullify_tokens", "split_code_name", "to_int", "to_money",
    "period_key", "surrogate_key", "MONTH_NAMES_PT", "current_period", "download_url", "extension",
    "file_name", "format_http_date", "normalize_period", "parse_http_date", "parse_period", "to_period",
]
