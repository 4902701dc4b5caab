"""Whole jobs and the queries registered for the driver."""
import importlib

MODULES = ["catalogue_queries", "reconcile_queries", "label_queries", "report_queries",
           "cell_queries", "web_queries", "request_queries", "job_queries", "stream_queries", "group_queries",
           "store_queries"]


def load_queries() -> None:
    for module in MODULES:
        importlib.import_module(f"{__name__}.{module}")
