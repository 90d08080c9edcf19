"""Batch analytics for security-incident records on Spark DataFrames."""

from breachlens.batch import BatchResult, run_batch
from breachlens.plans.cleaning import Cleaned, clean_incidents
from breachlens.plans.features import engineer_features
from breachlens.sources.incident_table import IncidentTable, load_engineered

__all__ = [
    "BatchResult",
    "Cleaned",
    "IncidentTable",
    "clean_incidents",
    "engineer_features",
    "load_engineered",
    "run_batch",
]
