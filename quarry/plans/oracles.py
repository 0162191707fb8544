"""DuckDB oracle SQL for every registered query (same column names)."""

from __future__ import annotations

from quarry.plans import bindings as B
from quarry.plans.job_bindings import oracles as job_oracles
from quarry.plans.oracle_sql import fts_scores_sql, headline_sql

ORACLES: dict[str, str] = {}

ORACLES["fts_match"] = fts_scores_sql("documents", "doc_id", "text", B.FTS_QUERY)

ORACLES["fts_rank"] = (
    f"SELECT id, score FROM ({fts_scores_sql('documents', 'doc_id', 'text', B.FTS_QUERY)}) "
    f"ORDER BY score DESC, id ASC LIMIT 20"
)

ORACLES["fts_boolean"] = " UNION ALL ".join(
    f"SELECT '{q}' AS query, id, score FROM ({fts_scores_sql('documents', 'doc_id', 'text', q)})"
    for q in B.BOOLEAN_QUERIES
)

_hits = fts_scores_sql("documents", "doc_id", "text", B.SNIPPET_QUERY)
ORACLES["snippet"] = (
    f"WITH hitdocs AS (SELECT d.doc_id AS id, d.text FROM documents d "
    f"WHERE d.doc_id IN (SELECT id FROM ({_hits}))) "
    f"SELECT * FROM ({headline_sql('hitdocs', B.SNIPPET_QUERY)})"
).replace("WITH hitdocs AS", "WITH hitdocs AS", 1)
ORACLES["snippet_two_fragments"] = (
    f"WITH hitdocs AS (SELECT d.doc_id AS id, d.text FROM documents d "
    f"WHERE d.doc_id IN (SELECT id FROM ({_hits}))) "
    f"SELECT * FROM ({headline_sql('hitdocs', B.SNIPPET_QUERY, width=40, frags=2)})"
)


def oracle_sql() -> dict[str, str]:
    out = job_oracles()
    out.update(ORACLES)
    return out
