"""Inventory strategy per named segment.

The strategies are a static dimension of four rows; it is joined to the
(at most k) named clusters, so every broadcast here is size-bounded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import attribute_label, with_default
from ..functions.naming import HIGH_CENTRALISED, HIGH_DISPERSED, LOW, MEDIUM

# Strategy attributes per segment (English wording of the
# reference's strategy table), attribute order as shown in the report.
ATTRIBUTES = ("description", "storage", "replenishment", "stock_level", "rotation", "kpis")
STRATEGIES = {
    HIGH_CENTRALISED: (
        "in high demand, sold mostly to few large customers",
        "easy-access zone next to loading and unloading - strategic location A1",
        "frequency: weekly or bi-weekly - volumes: large",
        "high (3-4 weeks of cover)",
        "very high (under 7 days per cycle)",
        "stock-out rate < 2% | obsolescence rate < 1%",
    ),
    HIGH_DISPERSED: (
        "in high demand, sold to many different customers",
        "easy-access zone with frequent distribution - strategic location A2",
        "frequency: weekly - volumes: medium",
        "medium-high (2-3 weeks of cover)",
        "high (7-14 days per cycle)",
        "stock-out rate < 3% | pick/pack efficiency > 95%",
    ),
    MEDIUM: (
        "moderate and steady demand",
        "middle zone of the warehouse - strategic location B",
        "frequency: bi-weekly - volumes: small to medium",
        "medium (2 weeks of cover)",
        "medium (14-30 days per cycle)",
        "stock-out rate < 5% | coverage rate > 90%",
    ),
    LOW: (
        "specialised products with low or sporadic demand",
        "deep zone of the warehouse - strategic location C (back)",
        "frequency: monthly or on demand - volumes: very small",
        "low (4+ weeks of cover or on demand)",
        "low (over 30 days per cycle)",
        "obsolescence rate < 10% | storage cost minimised",
    ),
}
UNMAPPED = "cluster not mapped to a predefined strategy"

# The short forms (three attributes, and a one-line
# strategy), chosen by a substring test on the segment name.
SHORT = {
    "centralised": ("easy-access zone (area A1)", "weekly/bi-weekly, large volumes",
                    "stock-out < 2%, obsolescence < 1%",
                    "high stock, few suppliers, concentrated distribution"),
    "dispersed": ("easy-access zone (area A2)", "weekly, medium volumes",
                  "stock-out < 3%, pick/pack efficiency > 95%",
                  "high stock, several suppliers, wide distribution"),
    "low_turnover": ("deep zone (area C)", "monthly or on demand",
                     "obsolescence < 10%, minimise storage cost",
                     "low stock, suppliers on demand, special monitoring"),
    "other": ("middle zone (area B)", "bi-weekly", "stock-out < 5%, coverage > 90%",
              "moderate stock, flexible replenishment"),
}


def strategy_table(spark: SparkSession) -> DataFrame:
    """The four-row dimension, built from literals on the JVM side (no
    Python rows to serialise)."""
    rows = [F.struct(F.lit(seg).alias("segment"), *[F.lit(v).alias(a) for a, v in zip(ATTRIBUTES, vals)])
            for seg, vals in STRATEGIES.items()]
    return spark.range(1).select(F.inline(F.array(*rows)))


def strategy_lookup(names: DataFrame) -> DataFrame:
    """E3 + C8: (cluster, segment, six attributes); a segment without a
    strategy keeps its row with empty (null) attributes."""
    strat = strategy_table(names.sparkSession)
    return names.join(F.broadcast(strat), "segment", "left").select("cluster", "segment", *ATTRIBUTES)


def strategy_report(names: DataFrame) -> DataFrame:
    """H4 (+C6, C8): long form (cluster, segment, ordinal, attribute,
    value); segment upper-cased, attribute keys as display labels, an
    unknown segment reported with one default line."""
    looked = strategy_lookup(names).withColumn("_mapped", F.col(ATTRIBUTES[0]).isNotNull())
    pairs = F.array(*[F.struct(F.lit(i + 1).alias("ordinal"), attribute_label(F.lit(a)).alias("attribute"),
                               F.col(a).alias("value")) for i, a in enumerate(ATTRIBUTES)])
    default = F.array(F.struct(F.lit(1).alias("ordinal"), F.lit("STRATEGY").alias("attribute"),
                               F.lit(UNMAPPED).alias("value")))
    return (looked.select("cluster", F.upper(with_default(F.col("segment"), "undefined")).alias("segment"),
                          F.explode(F.when(F.col("_mapped"), pairs).otherwise(default)).alias("p"))
            .select("cluster", "segment", "p.ordinal", "p.attribute", "p.value"))


def short_strategy(names: DataFrame) -> DataFrame:
    """H4b + C9: the short strategy chosen by a substring test on the
    name (centralised / dispersed / low turnover / anything else)."""
    seg = F.col("segment")

    def pick(i: int):
        return (F.when(seg.contains("centralised"), F.lit(SHORT["centralised"][i]))
                .when(seg.contains("dispersed"), F.lit(SHORT["dispersed"][i]))
                .when(seg.contains("low_turnover"), F.lit(SHORT["low_turnover"][i]))
                .otherwise(F.lit(SHORT["other"][i])))

    return names.select("cluster", "segment", pick(0).alias("storage"), pick(1).alias("replenishment"),
                        pick(2).alias("kpis"), pick(3).alias("summary"))
