"""Prediction for one reference date from the hourly table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.functions.time import to_datetime
from hourglass.operators.forecast import LagModel, forecast_series, mean_lag_predict
from hourglass.operators.select import fetch_range
from hourglass.operators.series import daily_sum


def predict_for_date(
    hourly: DataFrame,
    reference_date: "str | datetime",
    model: LagModel,
    pickup_locations: "int | Sequence[int] | None" = None,
    grid: bool = False,
) -> DataFrame:
    """Next-day prediction per location from ``[ref - max_lag days, ref + 1 day)``.

    ``hourly`` is the hourly table (``HourlyTable.scan()`` or any frame with
    its columns; a table scan prunes months and pushes the range).  The mean
    model returns (unique_id, ds, y, y_hat) for the day after the window, the
    linear model (unique_id, ds, y_pred, step) for one step.  ``grid=True``
    when the window is a complete grid (it is, read from the zero-filled
    table): the skew-safe bucketed windows are used.
    """
    ref = to_datetime(reference_date)
    window = fetch_range(hourly, ref - timedelta(days=model.max_lag), ref + timedelta(days=1), pickup_locations)
    daily = daily_sum(window)
    if model.coefs is None:
        pred = mean_lag_predict(daily, model.lags, model.freq, grid=grid)
        return pred.where(F.col("y").isNull())
    return forecast_series(daily, model, 1, min_history=model.max_lag, grid=grid)
