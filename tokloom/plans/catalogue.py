"""Every registered query and its oracle SQL."""

from __future__ import annotations

from tokloom.plans import (corpus_queries, eval_queries, io_queries, stream_ingest_queries,
                           stream_queries, token_queries)
from tokloom.plans.oracle import SQL

QUERIES = {}
for mod in (corpus_queries, token_queries, stream_queries, eval_queries,
            stream_ingest_queries, io_queries):
    QUERIES.update(mod.QUERIES)

ORACLE = {k: v for k, v in SQL.items() if k in QUERIES}
