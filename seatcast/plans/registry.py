"""Collects the registered queries of every catalog module."""

from __future__ import annotations

from seatcast.session import ensure_checkpoint_dir


def _load():
    from seatcast.plans import catalog, catalog_models, catalog_reports  # noqa: F401  (importing registers)
    return catalog


def _with_session_setup(fn):
    def run(spark, sf_dir):
        ensure_checkpoint_dir(spark)
        return fn(spark, sf_dir)
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def all_queries():
    c = _load()
    return {k: _with_session_setup(v) for k, v in c.QUERIES.items()}


def all_oracle_sql():
    return dict(_load().ORACLE)
