"""Bronze to gold in one call: what runs after new batches have landed."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import suppress
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from eventmart.operators.incremental import LOOKBACK_MINUTES
from eventmart.operators.quality import run_checks
from eventmart.plans import bronze, gold, silver
from eventmart.plans.catalog import publish
from eventmart.plans.check_state import CheckState
from eventmart.plans.checks import SUITES
from eventmart.plans.store import ConcurrentCommit, LayerTable
from eventmart.plans.value_counts import ValueCounts
from eventmart.schemas import FAMILIES
from eventmart.session import require_utc, staging
from eventmart.sources.scan import SOURCE, require_sources

BRONZE = [f.table for f in FAMILIES.values()]
SILVER = ["silver_device_events", "silver_transactions", "silver_user_activity"]
GOLD = ["gold_platform_events", "gold_user_conversion", "gold_user_engagement"]

#: Groups by day, from which the platform and the engagement mart are added up.
DAILY = "gold_platform_daily"
USER_DAYS = "gold_user_days"
DAILY_CHOICES = "gold_user_choices"

# table -> (key, partition column, sort column, marked columns)
_LAYOUT = {
    **{f.table: (f.key, f.date, f.window, (SOURCE,)) for f in FAMILIES.values()},
    "silver_device_events": ("event_id", "event_date", "event_window_start", ("event_window_start",)),
    "silver_transactions": (
        "transaction_id",
        "transaction_date",
        "transaction_window_start",
        ("transaction_window_start",),
    ),
    "silver_user_activity": ("activity_id", "event_date", "activity_window_start", ("activity_window_start",)),
    **{name: (None, None, None, ()) for name in GOLD},
    DAILY: (None, "event_date", None, ()),
    USER_DAYS: (None, "event_day", None, ()),
    DAILY_CHOICES: (None, "event_date", None, ()),
}


# table -> the tables it is built from
INPUTS = {
    "silver_device_events": ("bronze_device_events",),
    "silver_transactions": ("bronze_transaction_events",),
    "silver_user_activity": ("bronze_device_events", "bronze_session_events"),
    "gold_platform_events": ("silver_device_events",),
    "gold_user_conversion": ("silver_user_activity", "silver_transactions"),
    "gold_user_engagement": ("silver_device_events",),
}


def depends_on(name: str, source: str) -> bool:
    return name == source or any(depends_on(i, source) for i in INPUTS.get(name, ()))


class CheckFailure(ValueError):
    """A table was built and does not pass its checks."""


@dataclass
class Warehouse:
    """The layer tables under one root folder.

    `salts` spreads a heavy user of the activity join further. With `keep_versions` each build is
    followed by upkeep: days in many files are folded and versions beyond the newest so many expire,
    which readers of older ones must be able to bear. With `catalog` the tables are named in the
    session catalog after each build, in namespaces bronze, silver and gold.
    """

    spark: SparkSession
    root: str
    lookback_minutes: int = LOOKBACK_MINUTES
    retract_unmatched: bool = False
    salts: int = 1
    keep_versions: int | None = None
    catalog: bool = False

    def __post_init__(self) -> None:
        require_utc(self.spark)

    def table(self, name: str) -> LayerTable:
        _, partition, sort, marks = _LAYOUT[name]
        return LayerTable(self.spark, f"{self.root}/{name.split('_')[0]}", name, partition, sort, marks)

    def read(self, name: str) -> DataFrame:
        df = self.table(name).read()
        if df is None:
            raise ValueError(f"{name} has not been built")
        return df

    def register_views(self) -> list[str]:
        """A temporary view per built table, for ad-hoc SQL; each keeps the version it saw."""
        built = [name for name in _LAYOUT if self.table(name).exists()]
        for name in built:
            self.read(name).createOrReplaceTempView(name)
        return built

    def publish(self, name: str) -> str | None:
        """Point `layer.name` in the catalog at the newest build, for every session; None where there is none."""
        return publish(self.spark, self.table(name), name.split("_")[0], max(2, self.keep_versions or 0))

    # ---- bronze ----

    def load_bronze(self, directory: str, family: str, as_of: datetime) -> int | None:
        """Upsert the batches named after the last one loaded."""
        fam = FAMILIES[family]
        table = self.table(fam.table)
        snapshot = table.snapshot()
        mark = (snapshot.mark(SOURCE) if snapshot else None) or ""
        with staging(self.spark):
            return table.upsert(bronze.load(self.spark, directory, family, as_of=as_of, mark=mark), fam.key)

    # ---- silver ----

    def _bounds(self, name: str):
        window = _LAYOUT[name][2]
        return self.table(name).bounds(window, self.lookback_minutes)

    def build_silver(self, name: str, as_of: datetime) -> int | None:
        """Upsert the rows inside the lookback; those that the table holds already, but for when they were processed, change nothing."""
        table = self.table(name)
        retract = None
        if name == "silver_user_activity" and self.retract_unmatched:
            retract = silver.stale_unmatched

        def batch(target: DataFrame | None) -> DataFrame:
            options = {
                "target": target,
                "as_of": as_of,
                "lookback_minutes": self.lookback_minutes,
                "bounds": self._bounds(name),
            }
            if name == "silver_device_events":
                return silver.silver_device_events(self.read("bronze_device_events"), **options)
            if name == "silver_transactions":
                return silver.silver_transactions(self.read("bronze_transaction_events"), **options)
            return silver.silver_user_activity(
                self.read("bronze_device_events"), self.read("bronze_session_events"), salts=self.salts, **options
            )

        return table.upsert(batch, _LAYOUT[name][0], retract=retract, ignore=("processed_at",))

    # ---- gold ----

    def _versions(self, names: tuple[str, ...]) -> dict[str, int]:
        return {n: self.table(n).snapshot().version for n in names}

    def build_gold(self, name: str, as_of: datetime) -> int | None:
        """Build a mart again if a table that it is made from has changed; None if none has."""
        table = self.table(name)
        now = self._versions(INPUTS[name])
        held = table.snapshot()
        if held and all(held.batches.get(n) == v for n, v in now.items()):
            return None
        with staging(self.spark):
            if name == "gold_platform_events":
                self.build_daily(DAILY)
                return table.replace(gold.platform_mart(self.read(DAILY), as_of), now)
            if name == "gold_user_conversion":
                mart = gold.gold_user_conversion(
                    self.read("silver_user_activity"), self.read("silver_transactions"), as_of
                )
            else:
                self.build_daily(USER_DAYS)
                self.build_daily(DAILY_CHOICES)
                scores = ValueCounts(self.spark, f"{self.root}/gold", "gold_score_counts")
                scores.follow(self.table(USER_DAYS), "engagement_score")
                ranked = scores.ranked(self.read(USER_DAYS), "engagement_score", "engagement_percentile")
                mart = gold.engagement_mart(ranked, self.read(DAILY_CHOICES))
            return table.replace(mart, now)

    def build_daily(self, name: str = DAILY) -> list[str] | None:
        """Bring stored daily groups up to date: only days whose events have changed are grouped again. The days, or None for all."""
        source, table = self.table("silver_device_events"), self.table(name)
        groups = {DAILY: gold.platform_daily, USER_DAYS: gold.scored_user_days, DAILY_CHOICES: gold.daily_choices}[name]
        now = self._versions(("silver_device_events",))
        held = table.snapshot()
        since = held.batches.get("silver_device_events") if held else None
        days = source.changed_days(since) if since is not None else None
        if days is None:
            table.replace(groups(source.read()), now)
        elif days:
            table.replace_days(groups(source.read_days(days)), days, now)
        return days

    def check(self, name: str) -> DataFrame:
        """The report of a table's suite, evaluated once: a row per check.

        A table with a key is judged by what changed since the last report, others as a whole.
        """
        table, key = self.table(name), _LAYOUT[name][0]
        if key and table.snapshot() and table.snapshot().keyed:
            return CheckState(table, key, SUITES[name], f"{self.root}/checks").report()
        report = run_checks(self.read(name), SUITES[name])
        return self.spark.createDataFrame(report.collect(), report.schema)

    def refresh(
        self,
        directory: str | None,
        as_of: datetime | None = None,
        layers: tuple[str, ...] = ("bronze", "silver", "gold"),
        family: str | None = None,
        on_failure: str = "report",
    ) -> dict[str, DataFrame]:
        """Build the layers in order and return the check report per checked table.

        The tables of a layer are built side by side, each by jobs of its own; a run that fails half way is simply
        repeated, since upserts of the same rows change nothing. With `family` only the
        tables that depend on it, or were never built, are built, and of those only the
        ones whose inputs are there. Each checked table is checked right after its build; `on_failure="raise"`
        then stops the run after that layer.
        """
        if on_failure not in ("report", "raise"):
            raise ValueError(f"on_failure is report or raise, not {on_failure}")
        as_of = as_of or datetime.now(timezone.utc).replace(tzinfo=None)
        families = [family] if family else list(FAMILIES)
        reports: dict[str, DataFrame] = {}

        def built(name: str) -> None:
            if self.keep_versions:
                # Upkeep can wait where other writers are too busy for it.
                with suppress(ConcurrentCommit):
                    self.table(name).compact()
                    self.table(name).expire(self.keep_versions)
            if self.catalog:
                self.publish(name)
            if name in SUITES:
                reports[name] = self.check(name)
                failed = [f"{r['check']} {r['column']}: {r['failing_rows']}" for r in reports[name].collect() if not r["passed"]]
                if failed and on_failure == "raise":
                    raise CheckFailure(f"{name}: {'; '.join(failed)}")

        if "bronze" in layers:
            require_sources(self.spark, directory, families)

            def load(each: str) -> None:
                self.load_bronze(directory, each, as_of)
                built(FAMILIES[each].table)

            _side_by_side(load, families)
        for layer, names, build in (("silver", SILVER, self.build_silver), ("gold", GOLD, self.build_gold)):
            due = []
            for name in names if layer in layers else []:
                if family:
                    wanted = depends_on(name, FAMILIES[family].table) or not self.table(name).exists()
                    if not wanted or not all(self.table(i).exists() for i in INPUTS[name]):
                        continue
                due.append(name)

            def make(name: str, build=build) -> None:
                build(name, as_of)
                built(name)

            _side_by_side(make, due)
        return {name: reports[name] for name in SUITES if name in reports}


def _side_by_side(work: Callable[[str], None], names: list[str]) -> None:
    """Tables of one layer do not read each other: their jobs are submitted together, and the first error is raised when all have ended."""
    if names:
        with ThreadPoolExecutor(len(names)) as pool:
            list(pool.map(work, names))
