"""All catalogue queries and oracles; importing the modules registers them."""

from . import contract_queries, diff_queries, lineage_queries, record_queries, report_queries, scalar_queries, section_queries, source_queries, text_queries  # noqa: F401
from .views import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
