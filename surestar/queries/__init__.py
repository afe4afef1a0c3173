"""Operator queries on the driver tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from surestar.queries import curation, dimensions, expressions, quality, relational, star
from surestar.queries.base import Query

ALL: dict[str, Query] = {}
for module in (expressions, relational, dimensions, curation, star, quality):
    ALL.update(module.QUERIES)
