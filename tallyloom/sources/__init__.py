from tallyloom.sources.files import read_csv, read_json, read_parquet
from tallyloom.sources.registry import SOURCES, Extraction, extract_all

__all__ = ["SOURCES", "Extraction", "extract_all", "read_csv", "read_json", "read_parquet"]
