"""Detection and anonymization of personal data as Spark jobs."""

from .functions.masks import register_mask, register_python_mask
from .operators.anonymize import anonymize, anonymize_table, process_table
from .operators.detect import Recognizer, detect
from .operators.findings import findings
from .operators.lexicon import lexicon_findings
from .operators.upsert import upsert
from .plans.database import anonymize_tables, database_report, write_anonymized
from .policy import ColumnPolicy, EntityPolicy, Pattern, Policy, PolicyError, TablePolicy
from .sources.query import query_results
from .sources.tables import TableSet

__all__ = [
    "ColumnPolicy", "EntityPolicy", "Pattern", "Policy", "PolicyError", "Recognizer", "TablePolicy", "TableSet",
    "anonymize", "anonymize_table", "anonymize_tables", "database_report", "detect", "findings", "lexicon_findings",
    "process_table", "query_results", "register_mask", "register_python_mask", "upsert", "write_anonymized",
]
