from tillroll.functions.columns import (  # noqa: F401
    as_bool,
    as_double,
    change_or_null,
    days_in_month,
    fmt_decimal,
    fmt_money,
    fmt_pct,
    money,
    norm_code,
    pct_change,
    period_label,
    period_ordinal,
    period_start,
    py_strip,
    safe_ratio,
)
