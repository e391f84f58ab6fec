"""Registered queries by family; importing this package fills the registry."""

from tabwright.catalog import aggregations, modelling, preparation, projections, reshaping, stages, statistics  # noqa: F401
from tabwright.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
