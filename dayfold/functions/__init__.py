from dayfold.functions.scalar import (  # noqa: F401
    INF_TEXT,
    day_bounds,
    as_date,
    epoch_seconds,
    epoch_seconds_sql,
    FLAG_DELETED,
    FLAG_LIVE,
    FULL_NAME_SQL,
    full_name,
    inf,
    ntz,
    null_safe_differs,
    on_day,
    one_second,
)
