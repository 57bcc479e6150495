"""Named queries and the SQL that gives the same rows."""

from . import audits, evidence, evidence_sql, stores

QUERIES: dict = evidence.QUERIES | stores.QUERIES | audits.QUERIES
ORACLE_SQL: dict = evidence_sql.ORACLE_SQL | stores.ORACLE_SQL | audits.ORACLE_SQL
