"""Tabwright: supervised tabular analytics as Spark DataFrame operators and ml stages."""

__version__ = "0.1.0"
