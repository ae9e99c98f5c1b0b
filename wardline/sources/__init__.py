from wardline.sources.core import Core, open_core
from wardline.sources.csv import read_csv_extract, read_csv_extracts
from wardline.sources.parquet import conform, read_parquet_extracts

__all__ = ["Core", "conform", "open_core", "read_csv_extract", "read_csv_extracts", "read_parquet_extracts"]
