"""Query catalog: every registered query with its DuckDB oracle.

``queries()`` maps a key to ``fn(spark, sf_dir) -> DataFrame``;
``oracle_sql()`` maps the same key to SQL over the raw test tables.
"""

from __future__ import annotations

import importlib

_MODULES = [
    "strata.catalog.metric_queries",
    "strata.catalog.history_queries",
    "strata.catalog.time_queries",
    "strata.catalog.ops_queries",
]


def _load():
    qs, sqls = {}, {}
    for m in _MODULES:
        mod = importlib.import_module(m)
        qs.update(mod.Q)
        sqls.update(mod.SQL)
    return qs, sqls


def queries():
    return _load()[0]


def oracle_sql():
    return _load()[1]
