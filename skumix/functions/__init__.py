"""Column expressions (JVM-side, codegen'd); no Python UDFs."""

from .columns import (  # noqa: F401
    attribute_label,
    concentration_ratio,
    half_up_mean,
    nonneg_round,
    smoothed_concentration,
    truncate_name,
    week_key,
    with_default,
)
from .distance import nearest_center, squared_distance  # noqa: F401
from .naming import SEGMENTS, segment_name  # noqa: F401
