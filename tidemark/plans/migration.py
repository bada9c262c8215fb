"""The cascade from source tables to core: raw, evaluated, staging, quarantine and core of all entities.

Order matters. Dimensions hold accepted rows only, so a rejected customer rejects its accounts, and those
reject their transactions and balances.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.verdict import GateFailure
from tidemark.operators.changes import latest
from tidemark.operators.constraints import audit_constraints
from tidemark.operators.lineage import with_lineage
from tidemark.operators.rulebook import BOOKS, KEYED_BOOKS
from tidemark.operators.rules import accepted, evaluate, quarantine, staging_gate
from tidemark.operators.standardise import standardise
from tidemark.plans.core import CORE_NAMES, COUNTED, build_core, publish
from tidemark.plans.ledger import FAILED, MESSAGE_CHARS, RUNNING, SUCCEEDED, Ledgers, without
from tidemark.plans.reconcile import reconcile_financials, reconcile_transactions
from tidemark.schemas import ENTITIES
from tidemark.session import materialise
from tidemark.sources.landing import land, read_batch, verify_landing
from tidemark.sources.raw import PARTITION, load_raw, read_raw, replace_batch, unseen, without_batches
from tidemark.sources.readers import EmptyExtract, remove_path
from tidemark.sources.sinks import read_published, replace_path
from tidemark.streaming.incremental import Checkpoint, after, extract_control, stored_checkpoint, unplaced

ORDER = ("branch", "customer", "account", "transaction", "daily_balance")
PARENTS = {
    "branch": (),
    "customer": (),
    "account": ("branch", "customer"),
    "transaction": ("account",),
    "daily_balance": ("account",),
}


@dataclass(frozen=True)
class Run:
    """Parameters fixed once per run, so that every rule, retry and rerun sees the same values."""

    batch_id: str
    ingested_at: str
    rejected_at: str
    as_of: str

    def instant(self, name: str) -> Column:
        return F.lit(getattr(self, name)).cast("timestamp")

    def today(self) -> Column:
        return F.lit(self.as_of).cast("date")


@dataclass
class Layers:
    """Lazily built layers; asking for one entity builds only that entity and its parents.

    The evaluated table of an entity in ``settle`` is written once and then read by everything downstream. It holds
    every raw row next to its verdict, so the raw layer is served from it as well. Sources in ``keyed`` are known to hold
    every key once. Rules that need no lineage are judged on the source rows and the verdicts stamped, so that hashes and
    record keys travel through no join.
    """

    sources: Mapping[str, DataFrame]
    run: Run
    settle: tuple[str, ...] = ()
    keyed: tuple[str, ...] = ()
    _evaluated: dict[str, DataFrame] = field(default_factory=dict)
    _core: dict[str, DataFrame] = field(default_factory=dict)

    def raw(self, name: str) -> DataFrame:
        if name in self.settle:
            return self.evaluated(name).drop("is_valid", "failed_rules")
        return self._stamped(name)

    def _stamped(self, name: str) -> DataFrame:
        return self._with_lineage(self.sources[name], name)

    def _with_lineage(self, rows: DataFrame, name: str, *keep: str) -> DataFrame:
        return with_lineage(rows, ENTITIES[name], self.run.batch_id, self.run.instant("ingested_at"), keep=keep)

    def evaluated(self, name: str) -> DataFrame:
        if name not in self._evaluated:
            dimensions = {p: self.core(p) for p in PARENTS[name]}
            book = (KEYED_BOOKS if name in self.keyed else BOOKS)[name]
            rows = self._stamped(name) if book.by_version else self.sources[name].select(*ENTITIES[name].columns)
            verdict = evaluate(rows, book, dimensions, self.run.today(), materialise)
            if not book.by_version:
                verdict = self._with_lineage(verdict, name, "is_valid", "failed_rules")
            self._evaluated[name] = materialise(verdict, f"evaluated-{name}") if name in self.settle else verdict
        return self._evaluated[name]

    def verdicts(self, name: str, *columns: str) -> DataFrame:
        """Some columns of the evaluated table, written once: for reports that read little of it, and that several times."""
        return materialise(self.evaluated(name).select(*columns, "is_valid", "failed_rules"), f"verdicts-{name}")

    def staging(self, name: str) -> DataFrame:
        return standardise(accepted(self.evaluated(name)), name)

    def rejected(self, name: str) -> DataFrame:
        return quarantine(self.evaluated(name), BOOKS[name], self.run.instant("rejected_at"))

    def kept_core(self, name: str, *columns: str) -> DataFrame:
        """Some columns of a core table, written once; from then on they stand for it, in lookups too."""
        self._core[name] = materialise(self.core(name).select(*dict.fromkeys(columns)), f"core-{name}")
        return self._core[name]

    def core(self, name: str) -> DataFrame:
        if name in self._core:
            return self._core[name]
        return build_core(accepted(self.evaluated(name)), name)


class LandingMismatch(RuntimeError):
    """Files of a landed batch differ from its manifest."""


@dataclass
class Migration:
    """One run over a folder: what the tables share, and what has been built so far."""

    sources: Mapping[str, DataFrame]
    run: Run
    root: str
    ledgers: Ledgers
    newest_only: bool
    core: dict[str, DataFrame] = field(default_factory=dict)

    @property
    def spark(self) -> SparkSession:
        return self.ledgers.spark

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def load(self, name: str, incremental: bool, resume: bool) -> int:
        """Land the rows of a table, verify the files, append them to raw and store the position; returns their number."""
        entity, run, spark = ENTITIES[name], self.run, self.spark
        at, rows = run.instant("ingested_at"), self.sources[name]
        if incremental:
            reached = stored_checkpoint(self.ledgers.positions(), entity.source_table, entity.schema, entity.key)
            rows = after(rows, "updated_at", entity.key, reached).unionByName(self.unplaced_rows(name, rows, reached))
        try:
            manifest = land(rows, entity, f"{self.root}/landing", run.batch_id, at, finish=resume)
        except EmptyExtract:
            if not incremental:
                raise
            return 0  # nothing new
        verified = verify_landing(spark, entity, f"{self.root}/landing", run.batch_id).first()
        if verified.status != "PASS":
            raise LandingMismatch(f"{name}: {verified.file_mismatches} files differ, {verified.landed_rows} of {verified.manifest_rows} rows")
        landed = read_batch(spark, entity, f"{self.root}/landing", run.batch_id)
        if resume:
            replace_batch(with_lineage(landed, entity, run.batch_id, at), self.path("raw", name))
        else:
            load_raw(landed, entity, self.path("raw", name), run.batch_id, at)
        return manifest.agg(F.max("row_count")).first()[0]

    def unplaced_rows(self, name: str, rows: DataFrame, reached: Checkpoint | None) -> DataFrame:
        """Source rows that have no place before or after the position and that raw does not hold."""
        entity = ENTITIES[name]
        lane = unplaced(rows, "updated_at", entity.key, reached)
        if reached is None:
            return lane
        stamped = with_lineage(lane, entity, self.run.batch_id, self.run.instant("ingested_at"))
        return unseen(stamped, self.visible_raw(name)).select(*entity.columns)

    def visible_raw(self, name: str) -> DataFrame:
        """Raw without rolled back batches."""
        return without_batches(read_raw(self.spark, ENTITIES[name], self.path("raw", name)), self.ledgers.rolled_back())

    def build(self, name: str) -> int:
        """Evaluate raw once, gate and write staging and quarantine, and publish core; returns the records rejected."""
        raw, book, spark = self.visible_raw(name), BOOKS[name], self.spark
        dimensions = {p: self.core[p] for p in PARENTS[name]}
        verdict = evaluate(latest(raw) if self.newest_only else raw, book, dimensions, self.run.today(), materialise)
        replace_path(verdict, self.path("evaluated", name))
        evaluated = self.evaluated(name)
        counts = staging_gate(evaluated).first()
        if name in COUNTED and counts.status != "PASS":
            raise GateFailure(
                f"{name}: raw={counts.raw_rows}, valid={counts.valid_rows}, rejected={counts.rejected_records}"
            )
        staging = standardise(accepted(evaluated), name)
        replace_path(staging, self.path("staging", name))
        replace_path(quarantine(evaluated, book, self.run.instant("rejected_at")), self.path("quarantine", name))
        staging = spark.read.schema(staging.schema).parquet(self.path("staging", name))
        self.core[name] = publish(name, staging, staging, dimensions, self.path("core", CORE_NAMES[name]), label=self.run.batch_id)
        return counts.rejected_records

    def evaluated(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path("evaluated", name))

    def reconcile(self) -> None:
        """Compare the layers as they lie in their files, and store the results; what fails is for their reader."""
        run_at, raw = F.lit(datetime.now(timezone.utc)), {n: self.evaluated(n).drop("is_valid", "failed_rules") for n in ORDER}
        rejected = {n: self.spark.read.parquet(self.path("quarantine", n)) for n in COUNTED}
        staged = self.spark.read.parquet(self.path("staging", "transaction"))
        checks = {
            "transaction_reconciliation": reconcile_transactions(
                self.sources["transaction"], raw["transaction"], staged, self.core["transaction"], rejected["transaction"], run_at
            ),
            "financial_reconciliation": reconcile_financials(
                self.sources["transaction"], self.sources["daily_balance"], raw["transaction"], raw["daily_balance"],
                self.core["daily_balance"], rejected["daily_balance"], run_at,
            ),
            "constraint_audit": audit_constraints(raw),
        }
        for name, rows in checks.items():
            replace_path(rows, self.path("reconciliation", name))


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _message(error: BaseException) -> str:
    return f"{type(error).__name__}: {error}"[:MESSAGE_CHARS]


def migrate(
    sources: Mapping[str, DataFrame],
    run: Run,
    root: str,
    resume: bool = False,
    newest_only: bool = False,
    incremental: bool = False,
    initiated_by: str = "operator",
) -> dict[str, DataFrame]:
    """Land, verify, load, evaluate, gate and publish every table below ``root``, reconcile; returns the core tables.

    Each raw batch is evaluated exactly once; staging and quarantine are two filters over that result. The control
    tables record the batch, every table run (a failed one with its message) and the position reached in each source.
    ``resume`` continues an interrupted run of the same batch: published tables are skipped, a complete landing is reused,
    and the raw partition of the batch is overwritten rather than appended to. ``newest_only`` keeps the newest version of
    every record before the rules see it; without it a second full batch of a table stops at the duplicate-key gate.
    ``incremental`` extracts only what lies behind the stored positions and implies ``newest_only``.
    """
    ledgers = Ledgers(next(iter(sources.values())).sparkSession, root)
    job = Migration(sources, run, root, ledgers, newest_only or incremental)
    kind, batch_start = "INCREMENTAL" if incremental else "HISTORICAL", _now()

    def note(status: str, done: datetime | None, error: str | None) -> None:
        ledgers.append("migration_batch", run.batch_id, kind, None, None, batch_start, done, status, initiated_by, error)

    note(RUNNING, None, None)
    finished = ledgers.finished(run.batch_id) if resume else set()
    try:
        for name in ORDER:
            entity, started, loaded = ENTITIES[name], _now(), None
            if entity.source_table in finished:
                job.core[name] = read_published(job.spark, job.path("core", CORE_NAMES[name]))
                continue
            try:
                found = job.load(name, incremental, resume)
                own = job.visible_raw(name).where(F.col(PARTITION) == run.batch_id)
                loaded = own.count()
                rejected = job.build(name)
                position = extract_control(own, entity.source_table, "updated_at", entity.key, run.batch_id, F.lit(_now())).first()
                if position.last_watermark_ts is not None:  # nothing loaded, or nothing with a time: the old position holds
                    ledgers.append("source_extract_control", *position)
            except Exception as error:
                ledgers.append("table_run", run.batch_id, entity.source_table, None, None, loaded, None, started, _now(), FAILED, _message(error))
                raise
            ledgers.append("table_run", run.batch_id, entity.source_table, found, found, loaded, rejected, started, _now(), SUCCEEDED, None)
        job.reconcile()
    except Exception as error:
        note(FAILED, _now(), _message(error))
        raise
    note(SUCCEEDED, _now(), None)
    return job.core


RECONCILED = ("transaction_reconciliation", "financial_reconciliation", "constraint_audit")


def roll_back(
    spark: SparkSession,
    run: Run,
    root: str,
    batch_id: str,
    reason: str = "",
    sources: Mapping[str, DataFrame] | None = None,
    newest_only: bool | None = None,
) -> dict[str, DataFrame]:
    """Hide a batch and rebuild staging, quarantine and core from the batches that stay; raw files are not touched.

    The position of an incremental extract goes back to where the batch began (``Ledgers.positions``). ``newest_only`` is
    the option of the run; by default it holds if an increment is among the batches that stay, which are kept to their
    newest versions, and does not otherwise. With ``sources`` the reconciliations are made anew; without, the stored ones
    are removed, since they describe what was before.
    """
    ledgers = Ledgers(spark, root)
    ledgers.append("rolled_back_batch", batch_id, _now(), reason)
    if newest_only is None:
        stay = without(ledgers.batches(), "batch_id", ledgers.rolled_back())
        newest_only = not stay.where((F.col("migration_type") == "INCREMENTAL") & (F.col("status") == SUCCEEDED)).isEmpty()
    job = Migration(sources or {}, run, root, ledgers, newest_only)
    for name in ORDER:
        job.build(name)
    if sources is not None:
        job.reconcile()
    else:
        for name in RECONCILED:
            remove_path(spark, job.path("reconciliation", name))
    return job.core
