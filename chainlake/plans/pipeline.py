"""Jobs over a lake's folders: Bronze files to Silver to Gold, each dataset swapped in whole."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from chainlake.plans import gold, quality, silver
from chainlake.sources import files

log = logging.getLogger(__name__)

LENDING_GOLD = ["daily_borrow_activity", "daily_repayment_activity", "daily_liquidation_activity", "daily_lending_summary"]
SWAP_GOLD = {"swaps_per_minute": gold.swaps_per_minute, "top_pools": gold.top_pools, "pipeline_summary": gold.pipeline_summary, "recent_swaps": gold.recent_swaps}


@dataclass(frozen=True)
class Lake:
    """Where the layers are."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def manifest(self) -> str:
        return f"{self.root}/silver/processed_files.json"

    def silver(self, name: str) -> str:
        return f"{self.root}/silver/{name}"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"


def run_swap_silver(spark: SparkSession, lake: Lake) -> tuple[int, int] | None:
    """Merge the Bronze files that the manifest does not have; rows before and after, or None if there are none. The manifest is
    saved last: after a crash the files are merged again, to the same result. A manifest without its table is an error, as the rows
    of its files would be missing from then on."""
    done = files.load_manifest(spark, lake.manifest)
    new = files.unprocessed(files.discover(spark, lake.bronze), done, lake.bronze)
    if not new:
        return None
    path = lake.silver("swaps")
    files.settle(spark, path)
    old = files.table(spark, path)
    if done and old is None:
        raise FileNotFoundError(f"{lake.manifest} lists processed files, but their table is missing: {path}")
    before = old.count() if old is not None else 0
    after = files.publish(silver.swaps(files.scan(spark, new, lake.bronze), old), path)
    files.save_manifest(spark, lake.manifest, done | {files.manifest_entry(f, lake.bronze) for f in new})
    return before, after


def run_lending_silver(spark: SparkSession, lake: Lake) -> dict[str, int]:
    """Rebuild the lending datasets from all Bronze files; rows of each, {} without Bronze."""
    if not files.discover(spark, lake.bronze):
        return {}
    bronze = files.scan(spark, lake.bronze)
    return {m.name: files.publish(silver.lending(bronze, m), lake.silver(m.name)) for m in silver.MODELS}


def run_swap_gold(spark: SparkSession, lake: Lake) -> dict[str, int]:
    table = files.table(spark, lake.silver("swaps"))
    if table is None:
        raise FileNotFoundError(f"swap Silver is missing: {lake.silver('swaps')}")
    return {name: files.publish(build(table), lake.gold(name)) for name, build in SWAP_GOLD.items()}


def run_lending_gold(spark: SparkSession, lake: Lake) -> dict[str, int]:
    """Rows of the four datasets. {} if neither inputs nor outputs are there; outputs without inputs would be stale, and some of the inputs
    would give a partial result: both are errors."""
    paths = [lake.silver(m.name) for m in silver.MODELS]
    found = [files.table(spark, p) for p in paths]
    if all(t is None for t in found):
        if any(files.table(spark, lake.gold(n)) is not None for n in LENDING_GOLD):
            raise FileNotFoundError("lending Gold would be stale: all of its Silver inputs are missing")
        return {}
    if missing := [p for p, t in zip(paths, found, strict=True) if t is None]:
        raise FileNotFoundError(f"missing inputs: {', '.join(missing)}")
    events = [gold.lending_events(t).persist() for t in found]  # each is read twice
    tables: list[DataFrame] = [gold.daily_borrow_activity(events[0]), gold.daily_repayment_activity(events[1]), gold.daily_liquidation_activity(events[2]), gold.daily_lending_summary(*events)]
    try:
        return {name: files.publish(t, lake.gold(name)) for name, t in zip(LENDING_GOLD, tables, strict=True)}
    finally:
        for e in events:
            e.unpersist()


def run_silver(spark: SparkSession, lake: Lake) -> dict:
    return {"swaps": run_swap_silver(spark, lake), **run_lending_silver(spark, lake)}


def run_gold(spark: SparkSession, lake: Lake) -> dict[str, int]:
    """All Gold: swaps first, then lending."""
    return {**run_swap_gold(spark, lake), **run_lending_gold(spark, lake)}


def run_checks(spark: SparkSession, lake: Lake) -> None:
    tables = [files.table(spark, p) for p in (lake.silver("swaps"), lake.gold("pipeline_summary"))]
    if any(t is None for t in tables):
        raise FileNotFoundError("swap Silver or its summary is missing")
    quality.check_swaps(*tables)
    quality.check_lending(spark, f"{lake.root}/gold")
