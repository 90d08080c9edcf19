"""Where rows come from and go to: CSV files, layers in the shared folder, the query table."""

from breachlens.sources.csv_files import read_incident_csv, read_header, write_csv
from breachlens.sources.incident_table import IncidentTable
from breachlens.sources.layers import write_layer
from breachlens.sources.value_index import ValueIndex
from breachlens.sources.workspace import new_folder

__all__ = [
    "IncidentTable",
    "ValueIndex",
    "new_folder",
    "read_header",
    "read_incident_csv",
    "write_csv",
    "write_layer",
]
