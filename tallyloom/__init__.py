"""Retail star-schema ETL and analytics on Spark DataFrames."""

from tallyloom.params import MartParams
from tallyloom.session import build_session

__all__ = ["MartParams", "build_session"]
