from cohortloom.sources.buckets import read_bucketed, store_bucketed
from cohortloom.sources.database import (
    KeyCuts,
    key_bounds_sql,
    key_cuts,
    key_quantiles_sql,
    query_options,
    read_query,
)
from cohortloom.sources.sinks import load_model, model_versions, save_model, write_day, write_predictions
from cohortloom.sources.tables import (
    DatabaseSource,
    ParquetSource,
    SourceTables,
    as_accounts,
    as_commitments,
    as_register,
    as_schemes,
    read_accounts,
    read_commitments,
    read_register,
    read_schemes,
    read_tables,
)

__all__ = [
    "DatabaseSource",
    "ParquetSource",
    "SourceTables",
    "as_accounts",
    "as_commitments",
    "as_register",
    "as_schemes",
    "KeyCuts",
    "key_bounds_sql",
    "key_cuts",
    "key_quantiles_sql",
    "load_model",
    "model_versions",
    "query_options",
    "read_accounts",
    "read_bucketed",
    "read_commitments",
    "read_query",
    "read_register",
    "read_schemes",
    "read_tables",
    "save_model",
    "store_bucketed",
    "write_day",
    "write_predictions",
]
