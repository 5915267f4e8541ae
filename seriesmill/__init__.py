"""seriesmill: feature building, profiling and forecasting for time-ordered tables on Spark."""

__version__ = "0.1.0"
