"""Column-level functions (built-in expressions only)."""

from wardstat.functions.numeric import (  # noqa: F401
    NUMBER_PATTERN, clip, count_above, count_present, nan_to_null, row_max, row_mean,
    row_min, row_sum, sum_present, tolerant_double,
)
from wardstat.functions.tiers import (  # noqa: F401
    importance_band, metric_band, risk_tier, round_score, score_percent, sigmoid,
)
