"""Column builders: expressions only, no DataFrames and no actions."""

from courtstats.functions.columns import (  # noqa: F401
    argmax_name,
    argmin_name,
    cut,
    decode_season,
    format_number,
    iso_date,
    label_if,
    negate,
    margin,
    numeric,
    parse_minutes,
    rounded,
    sign_flag,
    to_number,
)
