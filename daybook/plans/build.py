"""The model DAG as plain Python: raw tables in, every model out (lazy DataFrames).

`Warehouse(raw)` builds each model on first access; Spark inlines the view layers and
Catalyst prunes columns down to the Parquet scans. `build` writes, checks and publishes them.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import landing as L
from ..sources.bindings import raw_tables
from . import marts as M
from . import staging as S

MART_MODELS = (
    "dim_date", "dim_repository", "fct_commits", "fct_calendar_events", "fct_pull_requests",
    "fct_issues", "fct_email_messages", "fct_plays", "mart_daily_activity",
    "mart_project_activity", "mart_monthly_summary",
)
VIEW_MODELS = (
    "stg_repositories", "stg_commits", "stg_pull_requests", "stg_issues",
    "stg_calendar_events", "stg_emails", "stg_plays", "int_daily_activity",
    "int_calendar_activity", "int_project_activity",
)


#: Models built at the same time (the source system's build runs as many).
BUILD_THREADS = 4


class FailedChecks(Exception):
    """A build whose checks failed; it wasn't published. `failures`: (check, model, column, failures)."""

    def __init__(self, failures: list[tuple]):
        super().__init__(", ".join(f"{kind} {model}.{column}: {n}" for kind, model, column, n in failures))
        self.failures = failures


class Warehouse:
    def __init__(self, raw, project_days: int = 14):
        self.raw = raw
        self.project_days = project_days

    @classmethod
    def from_driver(cls, spark: SparkSession, sf_dir: str, **kw) -> "Warehouse":
        return cls(raw_tables(spark, sf_dir), **kw)

    # staging
    @cached_property
    def stg_repositories(self): return S.stg_repositories(self.raw["raw_github_repositories"])
    @cached_property
    def stg_commits(self): return S.stg_commits(self.raw["raw_github_commits"])
    @cached_property
    def stg_pull_requests(self): return S.stg_pull_requests(self.raw["raw_github_pull_requests"])
    @cached_property
    def stg_issues(self): return S.stg_issues(self.raw["raw_github_issues"])
    @cached_property
    def stg_calendar_events(self): return S.stg_calendar_events(self.raw["raw_calendar_events"])
    @cached_property
    def stg_emails(self): return S.stg_emails(self.raw["raw_gmail_messages"])
    @cached_property
    def stg_plays(self): return S.stg_plays(self.raw["raw_spotify_plays"])

    # reductions shared by the marts
    @cached_property
    def commits_daily(self): return M.commits_daily(self.stg_commits)
    @cached_property
    def commits_by_repository(self): return M.commits_by_repository(self.stg_commits)
    @cached_property
    def commits_monthly(self): return M.commits_monthly(self.stg_commits)
    @cached_property
    def repository_keys(self): return self.stg_repositories.select("source_id", "repository_key", "name")
    @cached_property
    def int_calendar_activity(self): return M.int_calendar_activity(self.stg_calendar_events)
    @cached_property
    def meetings_daily(self): return M.meetings_daily(self.int_calendar_activity)

    # intermediate
    @cached_property
    def int_daily_activity(self): return M.int_daily_activity(self.commits_daily, self.meetings_daily)
    @cached_property
    def int_project_activity(self):
        return M.int_project_activity(self.repository_keys, self.commits_by_repository, self.project_days)

    # marts
    @cached_property
    def dim_date(self): return M.dim_date(self.commits_daily, self.int_calendar_activity)
    @cached_property
    def dim_repository(self): return M.dim_repository(self.stg_repositories)
    @cached_property
    def fct_commits(self): return M.fct_commits(self.stg_commits, self.repository_keys)
    @cached_property
    def fct_calendar_events(self): return M.fct_calendar_events(self.stg_calendar_events)
    @cached_property
    def fct_pull_requests(self): return M.fct_pull_requests(self.stg_pull_requests, self.repository_keys)
    @cached_property
    def fct_issues(self): return M.fct_issues(self.stg_issues, self.repository_keys)
    @cached_property
    def fct_email_messages(self): return M.fct_email_messages(self.stg_emails)
    @cached_property
    def fct_plays(self): return M.fct_plays(self.stg_plays)
    @cached_property
    def mart_daily_activity(self): return M.mart_daily_activity(self.dim_date, self.int_daily_activity)
    @cached_property
    def mart_project_activity(self): return M.mart_project_activity(self.int_project_activity)
    @cached_property
    def mart_monthly_summary(self):
        return M.mart_monthly_summary(
            M.monthly_commits(self.commits_monthly, self.repository_keys),
            M.monthly_meetings(self.int_calendar_activity),
            M.monthly_active_days(self.mart_daily_activity))

    def model(self, name: str) -> DataFrame:
        return getattr(self, name)

    # The per-day results that the daily and monthly models share: as many rows as the calendar
    # has days (times categories). Written once to the shared checkpoint folder, they cut lineage
    # and each fact is scanned once for them.
    SHARED = ("commits_daily", "int_calendar_activity")
    # What the repository dimension is joined by, and commits folded to its grain: dimension-sized.
    BY_REPOSITORY = ("repository_keys", "commits_by_repository")

    def materialize(self, *names: str) -> "Warehouse":
        """Replace the named models by Parquet tables written under `spark.checkpoint.dir`
        (columnar, with real sizes for the planner; lineage ends at the written table)."""
        from ..session import scratch_path

        names = names or self.SHARED
        frames = {name: getattr(self, name) for name in names}
        paths = {name: scratch_path(df.sparkSession, name) for name, df in frames.items()}

        def write(name: str) -> None:
            frames[name].write.mode("overwrite").parquet(paths[name])

        # models that don't need one another are built at the same time, a few at once
        with ThreadPoolExecutor(BUILD_THREADS) as pool:
            list(pool.map(inheritable_thread_target(write), names))
        for name in names:
            df = frames[name]
            self.__dict__[name] = df.sparkSession.read.schema(df.schema).parquet(paths[name])
            for dep in self._DEPENDENTS.get(name, ()):
                self.__dict__.pop(dep, None)
        return self

    def build(self, root: str, checks: Callable[[Warehouse], DataFrame] | None = None) -> dict[str, DataFrame]:
        """A4: build, check and publish the whole warehouse. By level: what the models share, then the
        tables, `BUILD_THREADS` at a time (each job on a thread of its own), then the views over the raw tables.

        `checks` gets the warehouse with its written tables and returns (check, model, column, failures)
        rows. If one fails, `FailedChecks` is raised and readers keep the release before. Otherwise one
        pointer publishes all tables together. Returns them, as read from the release.
        """
        self.materialize(*self.SHARED, *self.BY_REPOSITORY)
        tables = {name: self.model(name) for name in MART_MODELS}
        spark = tables[MART_MODELS[0]].sparkSession
        snaps = L.stage(tables, root, BUILD_THREADS)
        written = L.staged(spark, root, snaps, {name: df.schema for name, df in tables.items()})
        self.__dict__.update(written)
        if checks is not None:
            # a row a declared check
            failed = [tuple(r) for r in checks(self).where(F.col("failures") > 0).select("check", "model", "column", "failures").collect()]
            if failed:
                raise FailedChecks(sorted(failed))
        L.release(spark, root, snaps)
        for name in VIEW_MODELS:
            self.model(name).createOrReplaceTempView(name)
        return written

    _DEPENDENTS = {
        "repository_keys": ("int_project_activity", "mart_project_activity", "fct_commits", "fct_pull_requests",
                            "fct_issues", "mart_monthly_summary"),
        "commits_by_repository": ("int_project_activity", "mart_project_activity"),
        "commits_daily": ("int_daily_activity", "dim_date", "mart_daily_activity", "mart_monthly_summary"),
        "int_calendar_activity": ("meetings_daily", "int_daily_activity", "dim_date",
                                  "mart_daily_activity", "mart_monthly_summary"),
    }
