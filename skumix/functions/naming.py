"""H2: name a cluster from its feature means and the global medians."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The four segment names (English labels of the reference's
# four names, in the order its rule assigns them).
HIGH_CENTRALISED = "high_turnover_centralised"
HIGH_DISPERSED = "high_turnover_dispersed"
LOW = "low_turnover"
MEDIUM = "medium_turnover"
SEGMENTS = (HIGH_CENTRALISED, HIGH_DISPERSED, MEDIUM, LOW)
UNDEFINED = "undefined"


def segment_name(mean_volume: Column, mean_frequency: Column, mean_concentration: Column,
                 med_volume: Column, med_frequency: Column, med_concentration: Column) -> Column:
    """Strict comparisons; anything not strictly above or below on both
    volume and frequency (equality included) is medium turnover."""
    high = (mean_volume > med_volume) & (mean_frequency > med_frequency)
    low = (mean_volume < med_volume) & (mean_frequency < med_frequency)
    return (F.when(high & (mean_concentration > med_concentration), F.lit(HIGH_CENTRALISED))
            .when(high, F.lit(HIGH_DISPERSED))
            .when(low, F.lit(LOW))
            .otherwise(F.lit(MEDIUM)))
