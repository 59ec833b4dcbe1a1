"""Deal classification of asking prices against a predicted fair rent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import DEAL_LABELS, FAIR_BAND
from ..functions.numeric import deal_label, delta_percent, fair_band


def label_deals(df: DataFrame, asking: str = "asking_price", pred: str = "predicted_rent_eur",
                band: float = FAIR_BAND) -> DataFrame:
    """Adds max_fair, min_fair, delta, delta_percent and the three-way label."""
    a, p = F.col(asking), F.col(pred)
    hi, lo = fair_band(p, band)
    return df.select("*", hi.alias("max_fair"), lo.alias("min_fair"), (a - p).alias("delta"),
                     delta_percent(a, p).alias("delta_percent"), deal_label(a, p, band).alias("deal"))


def deal_message(deal: str = "deal", pct: str = "delta_percent", asking: str = "asking_price",
                 pred: str = "predicted_rent_eur"):
    """Human-readable verdict: how far above/below the prediction, in one decimal."""
    great, fair, over = DEAL_LABELS
    p = F.format_number(F.abs(F.col(pct)), 1)
    tail = F.concat(F.lit(" (Asking: €"), F.format_number(F.col(asking), 2), F.lit(" vs Predicted: €"),
                    F.format_number(F.col(pred), 2), F.lit(")"))
    return (F.when(F.col(deal) == over, F.concat(F.lit("Overpriced by ~"), p, F.lit("%"), tail))
            .when(F.col(deal) == great, F.concat(F.lit("Great Deal! Below market by ~"), p, F.lit("%"), tail))
            .otherwise(F.concat(F.lit("Fair Price within the ±10% band"), tail)))


def deal_quality(df: DataFrame, predicted: str = "deal", actual: str = "true_deal",
                 positive: str = DEAL_LABELS[0], scale: int = 6) -> DataFrame:
    """Accuracy over rows with both labels, precision and recall for the positive label. Other rows
    are counted as ``unlabelled``; ratios over nothing are NULL."""
    known = F.col(predicted).isNotNull() & F.col(actual).isNotNull()
    pp, ap = known & (F.col(predicted) == positive), known & (F.col(actual) == positive)
    agg = df.agg(F.count_if(known).alias("n"), F.count_if(~known).alias("unlabelled"),
                 F.count_if(F.col(predicted) == F.col(actual)).alias("agree"),
                 F.count_if(pp & ap).alias("tp"), F.count_if(pp).alias("pred_pos"),
                 F.count_if(ap).alias("actual_pos"))
    return agg.select("n", "unlabelled", "tp", "pred_pos", "actual_pos",
                      F.round(F.col("agree") / F.nullif(F.col("n"), F.lit(0)), scale).alias("accuracy"),
                      F.round(F.col("tp") / F.nullif(F.col("pred_pos"), F.lit(0)), scale).alias("precision"),
                      F.round(F.col("tp") / F.nullif(F.col("actual_pos"), F.lit(0)), scale).alias("recall"))
