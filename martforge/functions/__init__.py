from martforge.functions.expr import (  # noqa: F401
    abs_diff, any_null, calendar_key, day_name, line_amount, month_name, or_unknown,
    safe_ratio, to_total,
)
