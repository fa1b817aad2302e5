"""Listing ingest, record quality and consolidation as Spark DataFrame plans."""

from __future__ import annotations

__version__ = "0.1.0"


def ship_helpers() -> None:
    """Send the few Python helpers along with their UDFs, so that executors need no install."""
    from pyspark import cloudpickle

    from .functions import json
    from .operators import extract

    for module in (json, extract):
        cloudpickle.register_pickle_by_value(module)


ship_helpers()
