"""Every query of the library by name, with the SQL that gives the same rows."""

from __future__ import annotations

from groundtable.plans import keeping, pricing, reading, storing

QUERIES = {**pricing.QUERIES, **keeping.QUERIES, **reading.QUERIES, **storing.QUERIES}
ORACLE_SQL = {**pricing.ORACLE_SQL, **keeping.ORACLE_SQL, **reading.ORACLE_SQL, **storing.ORACLE_SQL}
