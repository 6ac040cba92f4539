"""Registered queries by area; importing this package registers them all."""

from . import (  # noqa: F401
    artefact_queries,
    extract_queries,
    gap_queries,
    io_queries,
    ledger_queries,
    merge_queries,
    stream_queries,
    work_queries,
)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
