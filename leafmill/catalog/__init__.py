"""Every operator as a query over the driver's tables, with the SQL that must agree.

Where an operator needs an input the tables do not hold (Markdown, CSV,
option bags, member names, ...), the query makes it from their rows, so its
work grows with them.
"""

from leafmill.catalog import admission, archives, bounds, converter, documents, files, ledger  # noqa: F401
from leafmill.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
