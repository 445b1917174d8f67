"""Queries of the corpus operators and the SQL that checks them."""

from tallyloom.llm.queries import QUERIES
from tallyloom.llm.statements import SQL

__all__ = ["QUERIES", "SQL"]
