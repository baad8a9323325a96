"""Timed-text analytics on Spark: interval algebra, sessionisation, text comparison and cue segmentation over DataFrames."""

__version__ = "0.1.0"
