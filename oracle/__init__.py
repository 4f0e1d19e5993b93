"""DuckDB SQL for the registered queries, written against the sample tables."""

from oracle.sql import ORACLES

__all__ = ["ORACLES"]
