"""Sources: parquet tables, the appointments fixture view, typed CSV."""

from cohortlens.sources.tables import read_table
from cohortlens.sources.appointments import appointments, APPOINTMENT_COLUMNS
from cohortlens.sources.csv import RAW_SCHEMA, read_raw_csv, recode, write_raw_csv

__all__ = ["read_table", "appointments", "APPOINTMENT_COLUMNS", "RAW_SCHEMA",
           "read_raw_csv", "recode", "write_raw_csv"]
