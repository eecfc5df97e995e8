from quayside.functions.cleaning import (  # noqa: F401
    clean, lower_clean, upper_or_empty, parse_bool, parse_float, parse_int, parse_decimal,
    parse_timestamp, parse_date, WHITESPACE,
)
