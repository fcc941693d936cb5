"""Queries that run each operator over the tables of a folder, and their SQL counterparts."""

from stepstream.catalogue.batch import BATCH_QUERIES
from stepstream.catalogue.oracle import ORACLES
from stepstream.catalogue.streams import STREAM_QUERIES

QUERIES = {**BATCH_QUERIES, **STREAM_QUERIES}

__all__ = ["BATCH_QUERIES", "ORACLES", "QUERIES", "STREAM_QUERIES"]
