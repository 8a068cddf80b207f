"""All registered queries of the library's core, and their SQL."""

from __future__ import annotations

from checks import histories, landings, measures, oracle, queries, streams

QUERIES = dict(queries.QUERIES)
ORACLE = dict(oracle.ORACLE)
for module in (streams, histories, measures, landings):
    QUERIES |= module.QUERIES
    ORACLE |= module.ORACLE
