"""Run the scheduled jobs over stored tables (the sinks).

A job reads the tables of one state (those of ``sf_dir`` before there is one)
and publishes all its tables together as the next state (``state.Store``), so
listings, log and outbox never disagree; what was read is never overwritten.
The ingest publishes its run records as 'running' before the work and closes
them with its other tables: a run that dies leaves them 'running'.  The first
ingest writes the listings in hash buckets of the slug, a later one adds a
layer of the rows it changes (``layers``).  A dry run
(S9) builds every plan but writes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestar.operators import store as ops
from lodestar.plans import jobs, layers
from lodestar.plans.state import Conflict, Snapshot, Store

__all__ = ["Conflict", "Snapshot", "Store", "newest", "run_daily", "run_ingest", "run_weekly", "versions"]


def _split(path: str) -> tuple[str, str]:
    root, _, table = path.rstrip("/").rpartition("/")
    return root, table


def versions(spark: SparkSession, path: str) -> list[int]:
    """The published versions of the table ``out_dir/<table>``."""
    root, table = _split(path)
    return Store(spark, root).versions(table)


def newest(spark: SparkSession, path: str) -> DataFrame | None:
    """The table ``out_dir/<table>`` of the newest state."""
    root, table = _split(path)
    return Store(spark, root).read(table)


def _finish(store: Store, base: Snapshot, out: dict, names: dict[str, str], read: tuple[str, ...], dry_run: bool) -> dict[str, bool]:
    if not dry_run:
        store.commit(base, {table: out[name] for name, table in names.items()}, read)
    return dict.fromkeys(names, not dry_run)


def run_daily(spark: SparkSession, sf_dir: str, out_dir: str, as_of: str, dry_run: bool = False,
              outcomes: DataFrame | None = None) -> dict:
    """Outbox rows, the appended log and the counts, published together."""
    store = Store(spark, out_dir)
    base = store.snapshot()
    out = jobs.daily_distribution(spark, sf_dir, as_of, store.read("listings", base), store.read("log", base), outcomes)
    written = _finish(store, base, out, {"outbox": "daily_outbox", "counts": "daily_counts", "log": "log"}, ("listings",), dry_run)
    return {"written": written, "report": out["report"]}


def run_weekly(spark: SparkSession, sf_dir: str, out_dir: str, as_of: str, dry_run: bool = False) -> dict:
    """C4: digest outbox row and the appended log, published together."""
    store = Store(spark, out_dir)
    base = store.snapshot()
    out = jobs.weekly_digest(spark, sf_dir, as_of, f"digest-{as_of[:10]}", store.read("listings", base), store.read("log", base))
    written = _finish(store, base, out, {"outbox": "weekly_outbox", "log": "log"}, ("listings",), dry_run)
    return {"written": written, "report": out["report"]}


def _with_history(before: DataFrame | None, runs: DataFrame) -> DataFrame:
    """Run records: earlier ones, those of the same id replaced."""
    if before is None:
        return runs
    return before.join(runs.select("id"), "id", "left_anti").select(*runs.columns).unionByName(runs)


def run_ingest(spark: SparkSession, sf_dir: str, out_dir: str, as_of: str, dry_run: bool = False, **options) -> dict:
    """The upserted listings table, run records and review flags.
    ``options`` are those of ``jobs.ingest`` (responses, sources, ...)."""
    store = Store(spark, out_dir)
    base = store.snapshot()
    if not dry_run:
        opened = ops.open_runs(jobs.source_sites(spark, sf_dir, options.get("sources")), as_of)
        base = store.commit(base, {"runs": _with_history(store.read("runs", base), opened)})
    out = jobs.ingest(spark, sf_dir, store.read("listings", base), as_of, dry_run, **options)
    names = {"runs": "runs", "flags": "flags", "upserted": "listings"}
    if not dry_run:
        entries = store.put({"runs": _with_history(store.read("runs", base), out["runs"]), "flags": out["flags"]})
        if layers.is_layered(store, "listings", base):
            entries |= layers.write_changes(store, "listings", out["changed"], base)
        else:
            entries |= layers.write_base(store, "listings", out["upserted"], "slug")
        state = store.publish(base, entries)
        if len(layers.parts("listings", "d", state)) > layers.MAX_LAYERS:
            try:
                layers.compact(store, "listings", state)
            except Conflict:    # another writer was first: the next run compacts
                pass
    return {"written": dict.fromkeys(names, not dry_run), "results": out["results"]}
