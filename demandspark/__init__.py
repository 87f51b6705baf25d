"""Time-series preparation, forecasting and scoring as Spark DataFrame jobs."""

from demandspark.keys import SeriesKeys

__all__ = ["SeriesKeys"]
