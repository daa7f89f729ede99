from railwatch.functions.scalars import (  # noqa: F401
    clamp_floor_zero,
    cosine,
    detector_ok,
    instant_millis,
    is_scored,
    non_blank,
    safe_ratio,
    window_name,
)
