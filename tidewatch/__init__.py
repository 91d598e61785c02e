"""Behavioural risk analytics on Spark: features, anomaly scores and explained alerts."""

__version__ = "0.1.0"
