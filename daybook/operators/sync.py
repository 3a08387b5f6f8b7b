"""The batch syncs: one run of a service over landed pages, from its cursor to its audit row.

A run reads the pages through the load path (`operators.load`), keeps what its cursor asks for,
loads it, advances the cursor and counts. Repositories are the entities of the code-hosting feeds:
one whose feed can't be read (an unreadable page or a malformed record) is left out whole, its cursor
stays and it counts as one failure; the run is then `partial`. The other services have a single
entity; their malformed records are quarantined one by one. An error that ends a run leaves a
`failed` audit row with its message in the audit table (`recorded`) and is raised again.

Nothing here is collected but one-row counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged
from . import incremental as D
from . import load
from . import runs as E
from . import upsert as U


@dataclass
class Run:
    """What a run leaves: the loaded tables, the cursor state, its audit row and the rejects."""

    tables: dict[str, DataFrame]
    state: DataFrame
    audit: DataFrame
    rejected: DataFrame | None = None
    batches: tuple[load.Batch, ...] = ()

    def release(self) -> None:
        """Give up the parsed batches, once what the run leaves is written."""
        for b in self.batches:
            b.release()


def _audit(source: str, now: str, fetched: int, inserted: int, updated: int, failed: int, spark,
           run_id: Column | None = None) -> DataFrame:
    m = spark.createDataFrame([(fetched, inserted, updated, failed)], "fetched long, inserted long, updated long, failed long")
    return E.run_row(m, source, now, now, run_id=run_id)


def aborted(spark, source: str, now: str, error: BaseException) -> DataFrame:
    """The audit row of a run that an error ended: nothing counted, the message kept."""
    m = spark.createDataFrame([(0, 0, 0, 0)], "fetched long, inserted long, updated long, failed long")
    return E.run_row(m, source, now, now, aborted=True, error_message=str(error))


@contextmanager
def recorded(spark, source: str, now: str, path: str) -> Iterator[None]:
    """Around a run and the writes of what it leaves: an error appends the `failed` row to the audit
    table at `path` and is raised again, also when that row can't be written."""
    try:
        yield
    except Exception as error:
        try:
            aborted(spark, source, now, error).write.mode("append").parquet(path)
        except Exception as lost:
            error.add_note(f"no audit row was written: {lost}")
        raise


def github_run(repos: DataFrame, repos_before: DataFrame, rows: DataFrame, before: DataFrame, failed: DataFrame,
               now: str, source: str = "github", run_id: Column | None = None) -> DataFrame:
    """The audit row of a code-hosting run from its repositories and rows (both in raw shape), the
    tables before it, and the failed entities: repositories and rows count alike, rows of failed
    entities not at all."""
    keys = ["source", "source_id"]
    good = D.drop_failed(rows, failed, "repository_source_id", "entity")
    a, b = U.upsert_counts(repos_before, repos, keys).first(), U.upsert_counts(before, good, keys).first()
    return _audit(source, now, sum(a) + sum(b), a["inserted"] + b["inserted"], a["updated"] + b["updated"],
                  failed.count(), rows.sparkSession, run_id)


def failed_entities(batch: load.Batch, entity: str) -> DataFrame:
    """The entities of a batch with an unreadable page or a malformed record."""
    return batch.broken.select(F.col(entity).alias("entity")).unionByName(batch.bad.select(F.col(entity).alias("entity")))


def sync_entities(connector: str, pages: DataFrame, feeds: list[load.Feed], ts: str, tables: dict[str, DataFrame],
                  state: DataFrame, repos: DataFrame, repos_before: DataFrame, now: str, default_since: Column,
                  full: bool = False, source: str = "github") -> Run:
    """Commits (or issues and pull requests: two feeds over the same pages) since each repository's
    cursor. `pages`: payload, arrival, repo_full_name, repo_source_id. `tables` by raw name."""
    spark = pages.sparkSession
    read = load.read_batches(pages, feeds, now)
    failed = reduce(DataFrame.unionByName, [failed_entities(b, "repo_source_id") for b in read]).distinct()
    failed = staged(failed, "failed")
    keys = ["source", "source_id"]
    a = U.upsert_counts(repos_before, repos, keys).first()
    out, batches, inserted, updated, rejected = {}, [], a["inserted"], a["updated"], None
    for f, batch in zip(feeds, read, strict=True):
        rows = D.drop_failed(batch.rows, failed, "repository_source_id", "entity")
        rows = D.select_since(rows, state, connector, "repository_source_id", ts, default_since, full, banded=False)
        rows = staged(rows, f.table)
        out[f.table], i, u = load.apply_rows(tables[f.table], rows, f, now)
        inserted, updated = inserted + i, updated + u
        batches.append(rows.select("repository_source_id", ts))
        rejected = batch.rejected if rejected is None else rejected.unionByName(batch.rejected)
    seen = reduce(DataFrame.unionByName, batches)
    state = D.advance(state, seen, connector, "repository_source_id", ts, now)
    audit = _audit(source, now, inserted + updated, inserted, updated, failed.count(), spark)
    return Run(out, state, audit, rejected, tuple(read))


def sync_single(connector: str, pages: DataFrame, feed: load.Feed, table: DataFrame, state: DataFrame, now: str, *,
                since: Column, ts: str, first: Column | None = None, empty: str = "now", kind: str = "iso",
                source: str | None = None) -> Run:
    """A service with one entity. `since` is the condition that its cursor puts on the rows, `first`
    the one of a run without a cursor (or `full`). The new cursor is the newest `ts` of the batch, or
    the run's start (`empty`: see `primary_cursor`)."""
    batch = load.read_batch(pages, feed, now)
    rows = batch.rows.where(since if first is None else first)
    out, inserted, updated = load.apply_rows(table, rows, feed, now)
    cursor = D.primary_cursor(rows, ts, now, empty=empty, kind=kind)
    state = D.upsert_state(state, D.state_rows(connector, cursor, now), now)
    audit = _audit(source or connector, now, inserted + updated, inserted, updated, 0, pages.sparkSession)
    return Run({feed.table: out}, state, audit, batch.rejected, (batch,))
