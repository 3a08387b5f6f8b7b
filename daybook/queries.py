"""Query registry: name -> (Spark callable(spark, sf_dir) -> DataFrame, DuckDB oracle SQL).

"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import oracle as O
from .plans.build import Warehouse
from .session import ensure_session

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_session(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (run, sql)
        return run

    return deco


def wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse.from_driver(spark, sf_dir)


# ---------------------------------------------------------------- models (F, J, K)
# query name -> (warehouse attribute, oracle model name)
_MODEL_QUERIES = {
    "stg_repositories": ("stg_repositories", "stg_github_repositories"),
    "stg_commits": ("stg_commits", "stg_github_commits"),
    "stg_pull_requests": ("stg_pull_requests", "stg_github_pull_requests"),
    "stg_issues": ("stg_issues", "stg_github_issues"),
    "stg_calendar_events": ("stg_calendar_events", "stg_calendar_events"),
    "stg_emails": ("stg_emails", "stg_gmail_messages"),
    "stg_plays": ("stg_plays", "stg_spotify_plays"),
    "int_daily_activity": ("int_daily_activity", "int_daily_activity"),
    "int_calendar_activity": ("int_calendar_activity", "int_calendar_activity"),
    "int_project_activity": ("int_project_activity", "int_project_activity"),
    "dim_date": ("dim_date", "dim_date"),
    "dim_repository": ("dim_repository", "dim_repository"),
    "fct_commits": ("fct_commits", "fct_commits"),
    "mart_daily_activity": ("mart_daily_activity", "mart_daily_activity"),
    "mart_project_activity": ("mart_project_activity", "mart_project_activity"),
    "mart_monthly_summary": ("mart_monthly_summary", "mart_monthly_summary"),
    "fct_calendar_events": ("fct_calendar_events", "fct_calendar_events"),
    "fct_pull_requests": ("fct_pull_requests", "fct_pull_requests"),
    "fct_issues": ("fct_issues", "fct_issues"),
    "fct_email_messages": ("fct_email_messages", "fct_email_messages"),
    "fct_plays": ("fct_plays", "fct_spotify_plays"),
}


# Models built on the shared per-day results: these are written first (one scan of each fact).
_ON_SHARED = ("int_daily_activity", "dim_date", "mart_daily_activity", "mart_monthly_summary")


def shared(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse with its per-day results written."""
    return wh(spark, sf_dir).materialize()


def _model_query(attr: str) -> QueryFn:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return (shared if attr in _ON_SHARED else wh)(spark, sf_dir).model(attr)

    q.__name__ = attr
    return q


for _name, (_attr, _oracle_name) in _MODEL_QUERIES.items():
    register(_name, O.model_sql(_oracle_name))(_model_query(_attr))


def _load_all() -> None:
    """Import the modules that register the remaining queries."""
    from . import (queries_analytics, queries_ingest, queries_load, queries_ops,  # noqa: F401
                   queries_stream, queries_sync)


def queries() -> dict[str, QueryFn]:
    _load_all()
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
