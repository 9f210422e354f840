"""Labelled-profile analytics on Spark, driven by a column contract."""

from profilespark.contract import SURVEY, Contract

__all__ = ["Contract", "SURVEY"]
__version__ = "0.1.0"
