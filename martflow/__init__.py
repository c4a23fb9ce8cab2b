"""martflow: retail marts, business answers and daily sales forecasts as Spark DataFrame jobs."""

__version__ = "0.1.0"
