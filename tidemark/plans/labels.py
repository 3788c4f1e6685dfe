"""Multi-horizon churn labels and the time split for training."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.operators.joins import spine


def churn_label(
    state: DataFrame,
    first: dt.date,
    n_months: int,
    horizons: tuple[int, ...] = K.HORIZONS,
    require_full_horizon: bool = False,
) -> DataFrame:
    """Whether a customer churns in (as_of, as_of + horizon], for months before the churn month.

    Labels are rows of the state expanded in place, so no join or shuffle is needed.
    With require_full_horizon, horizons reaching past the observed window are left out.
    """
    rows = spine(
        state.select("customer_id", "churn_month", "churn_reason"), first, n_months, horizons
    )
    as_of, churn = F.col("as_of_month"), F.col("churn_month")
    rows = rows.filter(churn.isNull() | (as_of < churn))
    boundary = F.add_months(as_of, F.col("prediction_horizon_months"))
    if require_full_horizon:
        rows = rows.filter(boundary < F.add_months(F.lit(first), n_months))
    churned = F.coalesce(churn <= boundary, F.lit(False))
    return rows.select(
        "customer_id", "as_of_month", "prediction_horizon_months",
        churned.alias("churned"),
        F.when(churned, churn).alias("churn_date"),
        F.when(churned, F.col("churn_reason")).alias("churn_reason"),
    )


def training_split(features: DataFrame) -> DataFrame:
    """Rows of the training horizon, marked train or eval by as-of month."""
    month = F.col("as_of_month")
    return features.filter(F.col("prediction_horizon_months") == K.TRAIN_HORIZON).withColumn(
        "split", F.when(month <= F.lit(K.LAST_TRAIN_MONTH), "train").otherwise("eval")
    )
