"""Lattica: spatial multi-omics analytics as Spark DataFrame plans."""

from lattica.session import get_spark

__all__ = ["get_spark"]
