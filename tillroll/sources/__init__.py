"""Table sources: the typed contract of the input relations, loading, folding,
and the stand-in views built from the driver's TPC-H-style tables."""

from tillroll.sources.contract import CONTRACT, ContractError
from tillroll.sources.normalize import canonical_tables, ingest_tables
from tillroll.sources.tables import TABLES, Tables, load_tables

__all__ = ["CONTRACT", "TABLES", "ContractError", "Tables", "canonical_tables", "ingest_tables", "load_tables"]
