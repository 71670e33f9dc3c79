"""The reconciliation graph as one lazily built, memoised set of DataFrames.

`Ledger` takes a source of raw tables (the driver fixture, or Parquet written
by `load_overwrite`) and exposes every staged, intermediate and mart frame.
Frames read by several marts (both trial balances, the transaction-level mart)
are written once as Parquet tables, so each is computed a single time per
session and a lost executor re-reads files. The postings are a projection of
their feeds, and the staged GL is its feed without the superseded copies, which
are found and written once: neither is written whole.
"""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tieout.operators import balances, marts, matching, postings, replays, staging
from tieout.sources.schemas import DATA_FEEDS


@dataclass(frozen=True)
class RunParams:
    """Clock values are parameters, never `current_date` inside an operator."""

    recon_at: dt.datetime = dt.datetime(2024, 2, 1, 8, 0, 0)
    as_of: dt.date = dt.date(2001, 8, 1)  # aging reference date
    freshness_as_of: dt.datetime = dt.datetime(2024, 2, 1, 20, 0, 0)
    carry_forward: bool = False


@dataclass
class Ledger:
    spark: SparkSession
    raw: Callable[[str], DataFrame]
    seed: Callable[[str], DataFrame]
    params: RunParams = field(default_factory=RunParams)
    persist: bool = True
    # shared folder for materialised layers; None keeps them as cached frames
    table_dir: str | None = None
    # frames that a run builds in another way (by key), already written by it
    built_by: dict[str, Callable[[], DataFrame]] = field(default_factory=dict)
    # feeds as frames that nothing is written for; None where they are landed tables anyway
    derived: Callable[[str], DataFrame] | None = None
    _memo: dict = field(default_factory=dict)
    _locks: dict = field(default_factory=dict)
    _guard: threading.Lock = field(default_factory=threading.Lock)

    def _get(
        self, key: str, build: Callable[[], DataFrame], persist: bool = False, plain: Sequence[str] = (),
    ) -> DataFrame:
        # layers are built from several threads; one lock per key builds each once
        with self._guard:
            lock = self._locks.setdefault(key, threading.Lock())
        with lock:
            return self._build_once(key, build, persist, plain)

    def _build_once(self, key: str, build: Callable[[], DataFrame], persist: bool, plain: Sequence[str]) -> DataFrame:
        if key not in self._memo:
            own = self.built_by.get(key)
            df = own() if own else build()
            if persist and self.persist and not own:
                if self.table_dir:
                    from tieout.plans.materialize import write_table

                    df = write_table(df, f"{self.table_dir}/{key}", plain=plain)
                else:
                    df = df.persist()
            self._memo[key] = df
        return self._memo[key]

    def feed(self, table: str) -> DataFrame:
        """A raw feed for readers that go over it once or twice and need no landed files."""
        if self.derived:
            return self._get(f"feed_{table}", lambda: self.derived(table))
        return self.raw(table)

    # ----------------------------------------------------------------- staging
    def stg(self, table: str) -> DataFrame:
        if table == "gl_journal":
            return self.stg_gl()
        return self._get(f"stg_{table}", lambda: staging.stage(self.feed(table), table))

    def stg_gl(self) -> DataFrame:
        return self._get("stg_gl", lambda: replays.staged_gl(self.feed("gl_journal")))

    def tolerance_rules(self) -> DataFrame:
        return self.seed("tolerance_rules")

    def materiality(self) -> DataFrame:
        return self.seed("materiality")

    # ------------------------------------------------------------ intermediate
    def postings(self) -> DataFrame:
        return self._get(
            "postings",
            lambda: postings.subledger_postings(
                self.stg("ap_invoices"), self.stg("ap_payments"), self.stg("ar_invoices"),
                self.stg("ar_receipts"), self.stg("inv_transactions"),
            ),
        )

    def sl_tb(self) -> DataFrame:
        return self._get("sl_tb", lambda: balances.trial_balance(self.postings()), persist=True)

    def gl_tb(self) -> DataFrame:
        return self._get("gl_tb", lambda: balances.trial_balance(self.stg_gl()), persist=True)

    # -------------------------------------------------------- document look-ups
    def _by_document(self, name: str, table: Callable[[], DataFrame]) -> DataFrame:
        from tieout.operators import drill
        from tieout.plans.materialize import new_table_dir

        def build():
            path = f"{self.table_dir}/{name}" if self.table_dir else new_table_dir(self.spark, name)
            return drill.lay_out(table(), path, table().count())

        return self._get(name, build)

    def postings_by_document(self) -> DataFrame:
        return self._by_document("postings_by_document", self.postings)

    def gl_by_document(self) -> DataFrame:
        return self._by_document("gl_by_document", self.stg_gl)

    # ------------------------------------------------------------------- marts
    def matched(self) -> DataFrame:
        return self._get("matched", lambda: matching.match_transactions(self.postings(), self.stg_gl()))

    def txn_level(self) -> DataFrame:
        return self._get(
            "txn_level",
            lambda: matching.recon_transaction_level(self.matched(), self.tolerance_rules(), self.params.recon_at),
            persist=True, plain=matching.PLAIN_COLUMNS,
        )

    def control(self) -> DataFrame:
        return self._get(
            "control",
            lambda: marts.recon_control_account(
                self.sl_tb(), self.gl_tb(), self.stg("dim_account"), self.tolerance_rules(), self.materiality(),
                carry_forward=self.params.carry_forward,
            ),
            persist=True,
        )

    def roll_forward(self) -> DataFrame:
        return self._get("roll_forward", lambda: marts.recon_roll_forward(self.sl_tb(), self.gl_tb()), persist=True)

    def variance(self) -> DataFrame:
        return self._get(
            "variance",
            lambda: marts.recon_variance_analysis(self.control(), self.stg("dim_entity"), self.stg("dim_account")),
            persist=True,
        )

    def aging(self) -> DataFrame:
        return self._get("aging", lambda: marts.recon_aging(self.txn_level(), self.params.as_of), persist=True)

    def fx_reval(self) -> DataFrame:
        return self._get("fx_reval", lambda: marts.recon_fx_revaluation(self.stg_gl(), self.stg("fx_rate")), persist=True)

    def suspense(self) -> DataFrame:
        return self._get("suspense", lambda: marts.recon_suspense_monitor(self.gl_tb()), persist=True)

    def manual_je(self) -> DataFrame:
        return self._get("manual_je", lambda: marts.recon_manual_je_flag(self.stg_gl(), self.stg("dim_account")), persist=True)

    def summary(self) -> DataFrame:
        return self._get(
            "summary",
            lambda: marts.recon_summary(self.control(), self.txn_level(), self.roll_forward()).unionByName(
                marts.summary_duplicate_invoices(marts.recon_duplicate_invoices(self.stg("ap_invoices")))
            ),
            persist=True,
        )

    def hierarchy(self) -> DataFrame:
        return self._get("hierarchy", lambda: balances.account_hierarchy(self.stg("dim_account").select(
            "account_code", "account_name", "account_type", "parent_account_code", "is_control_account",
            "subledger_source",
        )))

    # ------------------------------------------------------------------- audit
    def scorecard(self) -> DataFrame:
        from tieout.operators import audit

        return self._get("scorecard", lambda: audit.monthly_scorecard(
            self.control(), self.txn_level(), self.roll_forward()), persist=True)

    def audit_checks(self) -> DataFrame:
        """Current state of the check results: latest event per (run, check)."""
        from pyspark.sql import functions as F

        from tieout.operators import audit

        return self._get("audit_checks", lambda: audit.check_results(
            self.scorecard().withColumn("run_id", F.concat(F.lit("run-"), F.col("business_month")))))

    def run_events(self) -> DataFrame:
        """Append-only run log: RUNNING start events then finalize events."""
        from pyspark.sql import functions as F

        from tieout.operators import audit

        def build():
            start = audit.audit_start_run(audit.runs_from_scorecard(self.scorecard()))
            # the runs derived from the data take five minutes each
            final, _ = audit.audit_finalize(start, self.audit_checks(), F.expr("started_at + INTERVAL 5 MINUTES"))
            return start.select(*audit.RUN_COLUMNS).unionByName(final)

        return self._get("run_events", build)

    def audit_runs(self) -> DataFrame:
        from tieout.operators import audit

        return self._get("audit_runs", lambda: audit.latest_runs(self.run_events()))

    def run_row_counts(self) -> DataFrame:
        from tieout.operators import audit

        return self._get("run_row_counts", lambda: audit.source_row_counts_by_month(
            {t: self.feed(t) for t in DATA_FEEDS}))

    def unpersist(self) -> None:
        for df in self._memo.values():
            df.unpersist()
        self._memo.clear()


def seed_frames(spark: SparkSession) -> Callable[[str], DataFrame]:
    from tieout.sources.files import seed_from_literals

    cache: dict[str, DataFrame] = {}

    def get(name: str) -> DataFrame:
        if name not in cache:
            cache[name] = seed_from_literals(spark, name)
        return cache[name]

    return get


_LEDGERS: dict[tuple[int, str], Ledger] = {}


def fixture_ledger(spark: SparkSession, sf_dir: str) -> Ledger:
    """Ledger over the driver fixture; one per (session, sf_dir)."""
    from tieout.sources.fixtures import fixture

    from tieout.plans.materialize import new_table_dir, write_table
    from tieout.sources.files import scan_raw_table
    from tieout.sources.schemas import raw_schema

    key = (id(spark), sf_dir)
    led = _LEDGERS.get(key)
    if led is None or led.spark is not spark:
        fx = fixture(spark, sf_dir)
        warehouse = new_table_dir(spark, "fixture-warehouse")

        def typed(t: str) -> DataFrame:
            # typed as declared, ingestion times kept (they order GL replays)
            src = fx.raw(t)
            return src.select(*[src[f.name].cast(f.dataType).alias(f.name) for f in raw_schema(t).fields])

        def raw(t: str) -> DataFrame:
            """The feed as a landed table, written when first asked for."""

            def land() -> DataFrame:
                write_table(typed(t), f"{warehouse}/{t}")
                return scan_raw_table(spark, warehouse, t)

            return led._get(f"raw_{t}", land)  # noqa: SLF001

        led = Ledger(spark, raw, seed_frames(spark), table_dir=f"{warehouse}/marts", derived=typed)
        _LEDGERS[key] = led
    return led
