from lumen.functions.calendar import (  # noqa: F401
    as_date,
    calendar_columns,
    date_from_parts,
    day_name,
    day_type,
    days_until,
    display_date,
    month_name,
    period_start,
    year_end,
)
from lumen.functions.expressions import (  # noqa: F401
    case_when,
    count_where,
    first_column,
    level_position,
    pct,
    pct_change,
    rate_where,
    round_half_up,
    safe_ratio,
)
