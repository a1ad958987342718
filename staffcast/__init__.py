"""Staffing-request scoring on Spark: DataFrame in, DataFrame out."""

from staffcast.settings import Settings

__all__ = ["Settings"]
__version__ = "0.1.0"
