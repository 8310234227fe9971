"""Refresh groups: "rebuild everything from staging X to mart Y" as one
Spark job sequence over the model graph.

Each model of the chain is materialized in dependency order as a Parquet
table under ``root`` and re-read, so later models start from written data
(short lineage, survives lost executors). The clock (cron) belongs to the
user's scheduler.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..operators import gated, quality
from ..sources.sinks import materialize
from .graph import DEPENDS, RAW, ModelGraph, topo_order

# Refresh groups: (first model, last model), fixed values.
GROUPS = {
    "earnings": ("stg_earnings_calls", "mart_earnings_summary"),
    "filings": ("stg_sec_filings", "mart_filing_dashboard"),
    "prices": ("stg_stock_prices", "mart_research_signals"),
    "ml": ("ml_filing_embeddings", "ml_sentiment_training"),
}

LAYER = {"stg": "staging", "int": "staging", "mart": "analytics", "ml": "ml", "dt": "analytics"}


def _ancestors(name: str) -> set[str]:
    out: set[str] = set()
    stack = [name]
    while stack:
        for d in DEPENDS.get(stack.pop(), []):
            if d not in out:
                out.add(d)
                stack.append(d)
    return out


def group_models(group: str) -> list[str]:
    first, last = GROUPS[group]
    if group == "ml":
        names = {first, last}
        names |= {a for n in (first, last) for a in _ancestors(n) if a in DEPENDS}
    else:
        names = {last} | {a for a in _ancestors(last) if a in DEPENDS}
    return topo_order(sorted(names))


def raw_inputs(group: str) -> list[str]:
    """The raw tables that the models of the group read."""
    read = set().union(*(_ancestors(m) for m in group_models(group)))
    return [name for name in RAW if name in read]


def run_pipeline(graph: ModelGraph, group: str, root: str,
                 gate: dict[str, list] | None = quality.SUITES, quarantine: bool = False) -> dict[str, DataFrame]:
    """Materialize every model of the group; returns the re-read tables.

    ``gate`` checks the raw inputs that the group reads while they are written
    (``operators/gated.py``: one scan each), and the models read what was
    written. If a check fails, ``QualityGateError`` is raised before anything
    is staged; with ``quarantine`` rows that fail are set aside and only
    checks of the whole table stop the run. It is on by default; the
    row-count bounds of ``quality.SUITES`` are parameters of a deployment
    (pass suites with other bounds for larger feeds, or None).
    """
    built: dict[str, DataFrame] = {}
    g = graph
    if gate:
        raws = {name: graph.get(name) for name in raw_inputs(group) if name in gate}
        for name, done in gated.gate_all(raws, gate, f"{root}/gate/{uuid.uuid4().hex[:12]}", quarantine).items():
            g = g.with_overrides({name: (lambda _df, t=done.clean: t)})
    for name in group_models(group):
        df = materialize(g.get(name), name, "table", LAYER[name.split("_")[0]], root)
        built[name] = df
        # downstream models read the written table, not the upstream plan
        g = g.with_overrides({name: (lambda _df, t=df: t)})
    return built
