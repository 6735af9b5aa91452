"""Column-level building blocks (all built-in Spark expressions, no UDFs)."""

from lanecost.functions.expr import (  # noqa: F401
    col,
    fmt_count,
    fmt_pct,
    mixed_date,
    null_if_marker,
    period_label_col,
    period_sort_key_col,
    round_half_even_exact,
    text_bool,
)
