"""Column-expression helpers (JVM-side, codegen friendly)."""

from beatline.functions.columns import (  # noqa: F401
    clamp, epoch_micros, finite_or_zero, hour_of_day_utc, round_half_up,
    safe_div, strip_trailing_dots,
)
