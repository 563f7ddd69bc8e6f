"""The registry of queries by inventory id."""

from __future__ import annotations

from functools import partial

from plumbline.operators import grouped
from plumbline.plans import catalog, core, inventory, montages, norms, reports, signals, spectra
from plumbline.plans.sql import duck_sql, run, with_views

SQL = catalog.QUERIES | montages.QUERIES | spectra.QUERIES | reports.SHARED | inventory.SHARED | {"c8_efficiency_three_hops": grouped.C8_SQL}


def _sql(text: str, spark, sf_dir: str):
    return run(spark, sf_dir, text)


def queries():
    return {name: partial(_sql, text) for name, text in SQL.items()} | core.QUERIES | grouped.QUERIES | signals.QUERIES | reports.QUERIES | inventory.QUERIES


def oracle_sql():
    return {name: duck_sql(with_views(text)) for name, text in (SQL | core.ORACLES | signals.ORACLES | reports.ORACLES | inventory.ORACLES).items()}


flagship = norms.flagship
