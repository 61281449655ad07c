from fieldcast.functions.numeric import (
    clip, coerce_double, is_true, nan_to_null, round_even, safe_ratio, weighted_mean,
)
from fieldcast.functions.scores import (
    composite_score, soil_score, tolerance_score, yield_score,
)
from fieldcast.functions.temporal import days_in_month, mean_flux_to_kwh
from fieldcast.functions.text import (
    dept_code_normalise, lookup, number_text, strip_space, yes_no,
)
