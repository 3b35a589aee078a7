"""Metadata-driven table updates.

A table of rules says which columns of which partition take which values. Each
job becomes an ordered list of SQL statements; running the job executes them
and a dry run returns them, so what is shown is what would happen.

Three ways to commit a rewritten partition:

``relocate``   write the rewritten rows to a folder of their own, check them,
               point the partition there and delete the old files. The rows
               are written once and the switch is a single catalog operation:
               readers see the old rows or the new ones. The default for
               Parquet and ORC tables, and only for them.
``overwrite``  the same through a table like the target, which writes any
               format with the target's options. The default for other formats.
``rename``     stage, move the old partition aside under its recovery name,
               append the stage, drop the old rows. Used for rules that rewrite
               the partition column itself, since such rows change partition.

A stage that has been checked is kept until its rows are known to be in the
table, with or without a ledger: the next run of the same job starts from it.

Other writers may append meanwhile. The files of a partition are noted before
it is read. If they are others when the rows are to be committed, in this run or
a later one, the stage is made anew; files that come after that are found next
to the old ones before these are deleted, and their rows are added as they are,
as if appended after the update. Every attempt writes to a folder of its own.

Successive batches of one partition that read nothing else are composed into
one projection and rewrite it once.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from millrace.errors import (
    ConcurrentChangeError,
    ConflictingRulesError,
    RowCountMismatchError,
    UnfinishedJobError,
)
from millrace.operators import manifest
from millrace.operators.guards import fingerprint, require_equal_counts, require_same_rows
from millrace.operators.rewrite import Rule, rewrite_expressions
from millrace.operators.tables import (
    SELF_DESCRIBING,
    STAGE_FORMAT,
    PartitionSpec,
    drop_partition_if_exists,
    drop_table,
    is_whole,
    new_folder,
    partition_exists,
    partition_location,
    partitions_below,
    purge_location,
    purge_statements,
    rename_partition,
    require_partition,
    require_partition_column,
    session_setting,
    table_location,
    table_provider,
)
from millrace.operators.worklist import JOB_KEY, job_rules
from millrace.plans import ledger as ledgers
from millrace.plans.audit import Run, audited
from millrace.sources.catalog import read_partition

# Progress markers, in the order a job passes them.
CONFIGURED = "FOR_LOOP_WITH_KEY_VARIABLE_CONFIGURED"
COLUMNS_FOUND = "FOUND_ALL_SOURCE_TABLE_COLUMNS"
TRANSFORMED = "COLUMN_TRANSFORMATION_COMPLETE"
RENAMED = "PARTITION_RENAMED"
INSERTED = "INSERT_TRANSFORMED_DATA_TO_SOURCE"
TEMP_DROPPED = "DROP_TEMP_PARTITION"

OVERWRITE = "overwrite"
RENAME = "rename"
RELOCATE = "relocate"
MODES = (OVERWRITE, RENAME, RELOCATE)

NEEDED = [*JOB_KEY, "update_column", "case_when"]

# States of a stage, kept as a property of the stage table itself.
STATE_PROPERTY = "millrace.state"
REPLACED_PROPERTY = "millrace.replaced_location"
RULES_PROPERTY = "millrace.rules"
LATE_PROPERTY = "millrace.late_files"
CHECKED = "CHECKED"
APPENDED = "APPENDED"
COMMITTED = "COMMITTED"

# Folder beside that of the staged rows: the list of files that were read. A
# stage that is a table like the target lies there too, its rows do not.
NOTED = "-files"
# How often a stage is made anew because the partition has changed meanwhile.
ATTEMPTS = 5
# Batches in one rewrite: beyond that the plan's size costs more than a rewrite.
MOST_FUSED = 32
# Rules with a query of their own may read what other jobs write.
SUBQUERY = re.compile(r"\bselect\b|\bfrom\b|\btable\b", re.IGNORECASE)
# Fixed value: words that may follow a table in a from-clause without renaming it.
AFTER_TABLE = {
    "", "join", "inner", "left", "right", "full", "cross", "semi", "anti", "natural", "where",
    "on", "using", "lateral",
}

STEP_SCHEMA = (
    "table_name string, batch_number bigint, partition_column string, step_no int, "
    "step string, statement string, row_count bigint"
)


@dataclass(frozen=True)
class UpdateJob:
    """One row of the work list with its rules, and later batches it is fused with."""

    table: str
    batch: int
    partition: str
    temporary_partition: str | None
    from_clause: str
    rules: tuple[Rule, ...]
    also: tuple[UpdateJob, ...] = ()
    # The partition the rules name, where this job is for one of several below it.
    within: str | None = None

    @property
    def steps(self) -> tuple[UpdateJob, ...]:
        """The batches one by one."""
        return (replace(self, also=()), *self.also)

    @property
    def title(self) -> str:
        batches = ", ".join(str(step.batch) for step in self.steps)
        return f"{self.table} batch {batches} partition {self.partition}"

    @property
    def stage(self) -> str:
        """Stage name; fixed per job so that a later run finds it again."""
        mark = zlib.crc32(self.partition.replace("'", "").encode())
        return f"{self.table}_tmp_{self.batch}_{mark:08x}"

    @property
    def helper(self) -> str:
        return f"{self.stage}_old"

    @property
    def joins(self) -> bool:
        return self.from_clause != self.table


@dataclass
class JobPlan:
    """Statements of a job: those that stage, then (progress marker, statement)."""

    job: UpdateJob
    mode: str
    spec: PartitionSpec
    select: str
    folder: str
    kept: tuple[str, ...] = ()
    files: int | None = None
    staging: list[str] = field(default_factory=list)
    commit: list[tuple[str, str]] = field(default_factory=list)
    # Query of the place of every target row a join gives, where one is joined.
    places: str | None = None

    @property
    def moves_rows(self) -> bool:
        """Whether a rule rewrites a partition column itself."""
        return _moves_rows(self.job, self.spec)

    @property
    def mark(self) -> str:
        """Tells the rules that made a stage from others."""
        return hashlib.sha256(f"{self.mode}\n{self.select}".encode()).hexdigest()

    @property
    def statements(self) -> list[tuple[str, str]]:
        return [*((TRANSFORMED, text) for text in self.staging), *self.commit]

    @property
    def untouched(self) -> list[str]:
        """Columns no rule rewrites."""
        ruled = {rule.column.lower() for step in self.job.steps for rule in step.rules}
        return [c for c in self.kept if c.lower() not in ruled]


def _moves_rows(job: UpdateJob, spec: PartitionSpec) -> bool:
    return any(r.column.lower() in spec.columns for step in job.steps for r in step.rules)


def plan_job(
    spark: SparkSession,
    job: UpdateJob,
    mode: str | None = None,
    files: int | None = None,
    *,
    must_exist: bool = True,
) -> JobPlan:
    """Turn a job into statements; nothing is read but the catalog.

    The stage has as many files as the rewrite has tasks, unless ``files`` asks
    for a number at the price of a shuffle. Without a ``mode`` the table's
    format decides. The partition must be one the table has, unless an earlier
    job may make it.
    """
    schema = spark.table(job.table).schema
    provider = table_provider(spark, job.table)
    if mode is None:
        mode = RELOCATE if provider in SELF_DESCRIBING else OVERWRITE
    if mode not in MODES:
        raise ValueError(f"unknown mode: {mode!r}")
    spec = PartitionSpec.parse(job.partition)
    require_partition_column(spark, job.table, spec)
    if must_exist:
        require_partition(spark, job.table, spec)
    qualifier = _qualifier(spark, job, schema.names)
    where = spec.predicate_of(f"{qualifier}." if qualifier else "")
    source = f"{job.from_clause} WHERE {where}"
    select = _select(schema, job.rules, source, qualifier, files if not job.also else None)
    for step in job.also:
        inner = f"({select}) AS {_short(job.table)}"
        select = _select(schema, step.rules, inner, None, files if step is job.also[-1] else None)
    kept = tuple(c for c in schema.names if c.lower() not in spec.columns)
    columns = ", ".join(f"`{c}`" for c in kept)
    folder = new_folder(spark, job.table, str(job.batch))
    plan = JobPlan(job, mode, spec, select, folder, kept, files)
    if job.joins:
        plan.places = _places(spark, qualifier, f"FROM {source}")
    if plan.moves_rows:
        plan.mode = RENAME
    stage, drop_stage = job.stage, [(TEMP_DROPPED, f"DROP TABLE {job.stage}")]
    if plan.mode == RENAME:
        if not job.temporary_partition:
            raise ConflictingRulesError(f"{job.title}: no temporary partition given")
        aside = _aside(plan)
        plan.staging = [
            f"CREATE TABLE {stage} USING {STAGE_FORMAT} LOCATION '{folder}' AS {plan.select}"
        ]
        plan.commit = [
            (
                RENAMED,
                f"ALTER TABLE {job.table} PARTITION ({spec.sql}) "
                f"RENAME TO PARTITION ({aside.sql})",
            ),
            (INSERTED, f"INSERT INTO {job.table} SELECT {_spread(plan)}* FROM {stage}"),
            (TEMP_DROPPED, f"ALTER TABLE {job.table} DROP IF EXISTS PARTITION ({aside.sql})"),
            *drop_stage,
        ]
        return plan
    if plan.mode == RELOCATE and provider not in SELF_DESCRIBING:
        raise ValueError(f"{job.title}: cannot relocate {provider} partitions")
    plan.select = f"SELECT {columns} FROM ({select})"
    if plan.mode == RELOCATE:
        plan.staging = [
            f"CREATE TABLE {stage} USING {provider} LOCATION '{folder}' AS {plan.select}"
        ]
    else:
        plan.staging = [
            f"CREATE TABLE {stage} LIKE {job.table} LOCATION '{folder}{NOTED}'",
            f"ALTER TABLE {stage} ADD PARTITION ({spec.sql}) LOCATION '{folder}'",
            f"INSERT OVERWRITE TABLE {stage} PARTITION ({spec.sql}) {plan.select}",
        ]
    exists = must_exist or partition_exists(spark, job.table, spec)
    old = partition_location(spark, job.table, spec) if exists else "its location by then"
    switch = f"ALTER TABLE {job.table} PARTITION ({spec.sql}) SET LOCATION '{folder}'"
    plan.commit = [
        (INSERTED, switch),
        *[(TEMP_DROPPED, text) for text in purge_statements(job.helper, old)],
        *drop_stage,
    ]
    return plan


def _spread(plan: JobPlan) -> str:
    """Hint for rows that go to many partitions: one file each for small ones, more for a hot one."""
    if not plan.moves_rows:
        return ""
    return f"/*+ REBALANCE({', '.join(f'`{c}`' for c, _ in plan.spec.levels)}) */ "


def _select(
    schema: T.StructType,
    rules: Sequence[Rule],
    source: str,
    qualifier: str | None,
    files: int | None,
) -> str:
    items = rewrite_expressions(schema, rules, qualifier)
    hint = f"/*+ REPARTITION({files}) */ " if files else ""
    return f"SELECT {hint}{', '.join(items)} FROM {source}"


def _short(table: str) -> str:
    """The table's name without its database, as columns may be qualified with."""
    return f"`{table.rsplit('.', 1)[-1].strip('`')}`"


def _aside(plan: JobPlan) -> PartitionSpec:
    """The recovery partition; it may name only those levels that differ."""
    given = PartitionSpec.parse(plan.job.temporary_partition)
    known = set(plan.spec.columns)
    if not set(given.columns) <= known:
        return given
    return plan.spec.replaced(given)


def _qualifier(spark: SparkSession, job: UpdateJob, names: Sequence[str]) -> str | None:
    """Table prefix for the target's columns where a joined source shares a name.

    It works when the from-clause does not rename the target; otherwise shared
    names stay ambiguous and Spark says so.
    """
    if not job.joins:
        return None
    short = _short(job.table)
    try:
        spark.sql(f"SELECT {', '.join(f'{short}.`{c}`' for c in names)} FROM {job.from_clause}")
    except AnalysisException:
        return None
    return short


def _places(spark: SparkSession, qualifier: str | None, source: str) -> str | None:
    """Query of file and position of the target's rows in a join.

    Parquet files tell them, where the from-clause does not rename the target;
    else only the number of rows is compared.
    """
    place = f"{qualifier}._metadata" if qualifier else "_metadata"
    query = f"SELECT {place}.file_path AS file, {place}.row_index AS position {source}"
    try:
        spark.sql(query)
    except AnalysisException:
        return None
    return query


def pending_jobs(
    spark: SparkSession,
    rules: DataFrame,
    ledger: str | None = None,
    only: Column | None = None,
) -> list[UpdateJob]:
    """Jobs in the order they apply, each with its rules; nothing is written.

    The rules steer the driver's loop, one Spark write per job. They are control
    data, at most one row per table column and batch, and read in one go.
    """
    if ledger is not None and spark.catalog.tableExists(ledger):
        rules = ledgers.pending(rules, spark.table(ledger))
    found: dict[tuple, list] = {}
    rows = job_rules(rules, only).collect()
    for row in rows:
        empty = [name for name in NEEDED if row[name] is None]
        if empty:
            raise ConflictingRulesError(f"rule without {', '.join(empty)}: {row}")
    for row in sorted(rows, key=lambda r: [r[name] for name in JOB_KEY]):
        key = (row.table_name, row.batch_number, row.partition_column.replace("'", ""))
        found.setdefault(key, []).append(row)
    jobs = []
    for same in found.values():
        first = same[0]
        job = UpdateJob(
            first.table_name,
            first.batch_number,
            first.partition_column,
            first.temporary_partition,
            first.from_clause,
            tuple(Rule(r.update_column, r.case_when) for r in same),
        )
        if len({(r.temporary_partition, r.from_clause) for r in same}) > 1:
            raise ConflictingRulesError(
                f"{job.title}: rules disagree on from-clause or temporary partition"
            )
        jobs.append(job)
    return jobs


def expand_jobs(
    spark: SparkSession, jobs: list[UpdateJob], ledger: str | None = None
) -> list[UpdateJob]:
    """Jobs for the first partition columns only become one for each partition below.

    Those a ledger has as finished are left out.
    """
    found = []
    for job in jobs:
        spec = PartitionSpec.parse(job.partition)
        require_partition_column(spark, job.table, spec)
        if is_whole(spark, job.table, spec):
            found.append(job)
            continue
        require_partition(spark, job.table, spec)
        done = set()
        if ledger is not None and spark.catalog.tableExists(ledger):
            done = ledgers.finished(spark.table(ledger), job.table, job.batch)
        for below in partitions_below(spark, job.table, spec):
            if below.predicate.replace("'", "") not in done:
                found.append(replace(job, partition=below.predicate, within=job.partition))
    return found


def fuse_jobs(spark: SparkSession, jobs: list[UpdateJob]) -> list[UpdateJob]:
    """Successive batches of one partition as one job, as far as nothing can tell.

    A job that joins, moves rows or holds a query of its own may depend on any
    job before it and be read by any after it, so nothing is fused across it.
    Other jobs read and write their own partition only.
    """
    found: list[UpdateJob] = []
    open_jobs: dict[tuple, int] = {}
    for job in jobs:
        spec = PartitionSpec.parse(job.partition)
        text = " ".join(rule.case_when for rule in job.rules)
        if job.joins or _moves_rows(job, spec) or SUBQUERY.search(text):
            open_jobs.clear()
            found.append(job)
            continue
        key = (job.table.lower(), *sorted((c.lower(), v) for c, v in spec.levels))
        if key in open_jobs and len(found[open_jobs[key]].steps) < MOST_FUSED:
            first = found[open_jobs[key]]
            fused = replace(first, also=(*first.also, job))
            if _composes(spark, fused):
                found[open_jobs[key]] = fused
                continue
        open_jobs[key] = len(found)
        found.append(job)
    return found


def _composes(spark: SparkSession, job: UpdateJob) -> bool:
    """Whether the rules of fused batches can be resolved on one another's result."""
    try:
        spark.sql(plan_job(spark, job, must_exist=False).select)
    except AnalysisException:
        return False
    return True


def _checked_count(spark: SparkSession, plan: JobPlan, rewritten: DataFrame) -> int:
    """Rows of the partition, provided the rewrite has the same.

    A projection cannot trade one row for another, a join can: there the
    columns no rule touches are compared too, whatever the table's format.
    """
    before = read_partition(spark, plan.job.table, plan.spec.predicate)
    if plan.job.joins and plan.untouched:
        return require_same_rows(before, rewritten, plan.untouched, plan.job.title)
    original, new = before.count(), rewritten.count()
    require_equal_counts(original, new, plan.job.title)
    return new


def _require_each_row_once(spark: SparkSession, plan: JobPlan) -> None:
    """Refuse a join that gives a target row more than once, whatever the totals are."""
    if plan.places is None:
        return
    places = spark.sql(plan.places)
    repeated = places.groupBy("file", "position").count().where("count > 1").limit(3).collect()
    if repeated:
        raise RowCountMismatchError(
            f"{plan.job.title}: the join gives rows of the target more than once, "
            f"{repeated[0]['count']} times row {repeated[0]['position']} of {repeated[0]['file']}"
        )


def _plans(
    spark: SparkSession,
    jobs: list[UpdateJob],
    mode: str | None,
    files: int | None,
) -> list[JobPlan]:
    """Plans of all jobs.

    A partition may be absent if rows that an earlier job moves may make it, or
    if an interrupted run of the job has moved it aside.
    """
    plans: list[JobPlan] = []
    for job in jobs:
        made = any(p.moves_rows and p.job.table == job.table for p in plans)
        begun = _stage_state(spark, job.stage) is not None
        plans.append(plan_job(spark, job, mode, files, must_exist=not (made or begun)))
    return plans


def dry_run(
    spark: SparkSession,
    rules: DataFrame,
    *,
    mode: str | None = None,
    files: int | None = None,
    ledger: str | None = None,
    audit_table: str | None = None,
    only: Column | None = None,
    job_name: str = "table_update",
    fuse: bool = True,
) -> DataFrame:
    """Ordered statements of all pending jobs, with the checked row count of each job.

    Reads and rewrites for the counts but changes no table except the audit's,
    which gets a row as for any run. Every job is counted on the state that the
    jobs before it would leave. That state is a projection of the table, so it
    costs a scan of the columns that decide. A join that cannot be resolved on
    it has no count. Fused batches are shown under the first of them.
    """
    with audited(spark, job_name, audit_table) as run:
        rows = []
        jobs = expand_jobs(spark, pending_jobs(spark, rules, ledger, only), ledger)
        plans = _plans(spark, fuse_jobs(spark, jobs) if fuse else jobs, mode, files)
        states: dict[str, str] = {}
        # Where no rule moves rows, every job finds as many as there are today.
        moving = {plan.job.table.lower() for plan in plans if plan.moves_rows}
        for plan in plans:
            job = plan.job
            run.message = f"{job.title}: {CONFIGURED}, {COLUMNS_FOUND}"
            n = _count_on(spark, plan, states.get(job.table.lower()))
            for number, (step, statement) in enumerate(plan.statements, 1):
                rows.append((job.table, job.batch, job.partition, number, step, statement, n))
            if job.table.lower() in moving:
                before = states.get(job.table.lower(), job.table)
                states[job.table.lower()] = _state_after(spark, plan, before)
        run.message = f"shown, not run: {len(plans)} jobs with {len(rows)} statements"
        return spark.createDataFrame(rows, STEP_SCHEMA)


def _count_on(spark: SparkSession, plan: JobPlan, state: str | None) -> int | None:
    """Checked rows of a job on the table, or on what earlier jobs make of it."""
    job = plan.job
    if state is None:
        if not partition_exists(spark, job.table, plan.spec):
            return None
        _require_each_row_once(spark, plan)
        return _checked_count(spark, plan, spark.sql(plan.select))
    before = spark.sql(f"SELECT * FROM {state} WHERE {plan.spec.predicate}")
    if not job.joins:
        return before.count()
    source = _from_state(job, state)
    if source is None:
        return None
    try:
        prefix = f"{_short(job.table)}."
        items = ", ".join(f"{prefix}`{c}`" for c in plan.untouched) or "1"
        joined = spark.sql(
            f"SELECT {items} FROM {source} WHERE {plan.spec.predicate_of(prefix)}"
        )
    except AnalysisException:
        return None
    if plan.untouched:
        return require_same_rows(before, joined, plan.untouched, job.title)
    require_equal_counts(before.count(), n := joined.count(), job.title)
    return n


def _from_state(job: UpdateJob, state: str) -> str | None:
    """The from-clause with a state in the table's place, where it names it once."""
    found = list(re.finditer(rf"(?<![\w.`]){re.escape(job.table)}(?![\w.`])", job.from_clause))
    outside = [m for m in found if job.from_clause[m.end() : m.end() + 1] != "."]
    if len(outside) != 1:
        return None
    head, rest = job.from_clause[: outside[0].start()], job.from_clause[outside[0].end() :]
    word = re.match(r"\s*(\w*)", rest)[1].lower()
    return f"{head}{state}{rest if word in AFTER_TABLE else ''}" if word in AFTER_TABLE else None


def _state_after(spark: SparkSession, plan: JobPlan, before: str) -> str:
    """What a job leaves of its table, as a query over what was there before.

    The rules apply to the rows of the partition; others stay. One projection a
    batch, so the text grows with the batches only. A join's values are not
    followed, only where its rows go; so a rule that takes the partition from a
    joined column leaves the rows where they are here.
    """
    job, schema = plan.job, spark.table(plan.job.table).schema
    state, inside = before, plan.spec.predicate
    for step in job.steps:
        ruled = {rule.column.lower(): rule.case_when for rule in step.rules}
        items = []
        for column in schema.fields:
            name, rule = f"`{column.name}`", ruled.get(column.name.lower())
            kind = column.dataType.simpleString()
            if rule is None:
                items.append(name)
                continue
            new = f"cast(case {rule} else {name} end as {kind})"
            items.append(f"case when {inside} then {new} else {name} end as {name}")
        query = f"(SELECT {', '.join(items)} FROM {state}) AS {_short(job.table)}"
        try:
            spark.sql(f"SELECT 1 FROM {query}")
        except AnalysisException:
            continue
        state = query
    return state


def run_updates(
    spark: SparkSession,
    rules: DataFrame,
    *,
    mode: str | None = None,
    files: int | None = None,
    ledger: str | None = None,
    audit_table: str | None = None,
    only: Column | None = None,
    job_name: str = "table_update",
    fuse: bool = True,
) -> list[UpdateJob]:
    """Apply all enabled rules, job after job, and audit the run.

    With a ``ledger`` each (table, batch, partition) is applied once however
    often the run is repeated. The first failure stops the run; jobs before it
    stay applied and the audit row names the last step reached. Fused batches
    whose common stage fails are run one by one, so the same holds for them.
    """
    with audited(spark, job_name, audit_table) as run:
        jobs = pending_jobs(spark, rules, ledger, only)
        each = expand_jobs(spark, jobs, ledger)
        # Planning all jobs first finds bad rules before anything has changed.
        plans = _plans(spark, _with_stages(spark, each, fuse), mode, files)
        if ledger is not None:
            ledgers.create_ledger(spark, ledger)
        for plan in plans:
            _run_fused(spark, plan, run, ledger)
        if ledger is not None:
            for job in jobs:
                if any(e.within == job.partition and e.batch == job.batch for e in each):
                    ledgers.record_done(spark, ledger, job.table, [job.batch], job.partition)
        return jobs


def _with_stages(spark: SparkSession, jobs: list[UpdateJob], fuse: bool) -> list[UpdateJob]:
    """The jobs to run; a stage that an earlier run left decides what is fused with it.

    Whether it holds one batch or several is told by its rules' mark.
    """
    if not fuse:
        return jobs
    found = []
    for job in fuse_jobs(spark, jobs):
        begun = job.also and _stage_state(spark, job.stage) is not None
        if not begun:
            found.append(job)
            continue
        mark = _stage_property(spark, job.stage, RULES_PROPERTY)
        for n in range(len(job.steps), 0, -1):
            first = replace(job, also=job.also[: n - 1])
            marks = {plan_job(spark, first, m, must_exist=False).mark for m in _modes_of(spark, job)}
            if mark in marks:
                break
        found += [first, *job.also[n - 1 :]]
    return found


def _modes_of(spark: SparkSession, job: UpdateJob) -> list[str]:
    known = table_provider(spark, job.table) in SELF_DESCRIBING
    able = MODES if known else [m for m in MODES if m != RELOCATE]
    return [m for m in able if m != RENAME or job.temporary_partition]


def _run_fused(spark: SparkSession, plan: JobPlan, run: Run, ledger: str | None) -> None:
    """Run a job; batches whose common stage cannot be made are run in turn."""
    job = plan.job
    if job.also and _stage_state(spark, job.stage) is None:
        try:
            _stage(spark, plan, run)
        except Exception:
            for step in job.steps:
                run_job(spark, plan_job(spark, step, plan.mode, plan.files), run, ledger)
            return
    run_job(spark, plan, run, ledger)


def run_job(spark: SparkSession, plan: JobPlan, run: Run, ledger: str | None = None) -> None:
    """Stage, check and commit one job.

    A stage that an earlier, interrupted run has checked is committed as it is,
    if the same rules made it and the partition still has the files it was made
    from; once the commit has begun it may be the only copy of the rows. The
    stage goes last.
    """
    job = plan.job
    run.message = f"{job.title}: {CONFIGURED}, {COLUMNS_FOUND}"
    for attempt in range(ATTEMPTS):
        if attempt:
            plan = plan_job(spark, job, plan.mode, plan.files)
        state = _stage_state(spark, job.stage)
        if state is None:
            rows = _stage(spark, plan, run)
            run.message = f"{job.title}: {TRANSFORMED} ({rows:,} rows)"
            state = CHECKED
        elif _stage_property(spark, job.stage, RULES_PROPERTY) != plan.mark:
            raise UnfinishedJobError(
                f"{job.title}: {job.stage} holds checked rows ({state}) that other rules or "
                "another mode made; finish that run, or drop the stage if its rows are not needed"
            )
        else:
            run.message = f"{job.title}: {TRANSFORMED} (in an earlier run)"
        if state != CHECKED or _begun(spark, plan):
            break
        if not manifest.changes(spark, _replaced(spark, job), _folder(spark, job) + NOTED):
            break
        _discard(spark, plan)
    else:
        raise ConcurrentChangeError(
            f"{job.title}: the partition changed during each of {ATTEMPTS} attempts to rewrite it"
        )

    folder, old = _folder(spark, job), _replaced(spark, job)
    if state != COMMITTED:
        if plan.mode == RENAME:
            _commit_by_rename(spark, plan, run, state, folder)
        else:
            _commit_by_switch(spark, plan, run, folder, old)
        _set_stage_property(spark, job.stage, STATE_PROPERTY, COMMITTED)
    if plan.mode == RENAME:
        drop_partition_if_exists(spark, job.table, _aside(plan))
    else:
        purge_location(spark, job.helper, old)
    run.message = f"{job.title}: {TEMP_DROPPED}"
    if ledger is not None:
        batches = [step.batch for step in job.steps]
        ledgers.record_done(spark, ledger, job.table, batches, job.partition)
    spark.sql(plan.commit[-1][1])
    for done in [folder + NOTED, *([folder] if plan.mode == RENAME else [])]:
        purge_location(spark, f"{job.helper}_done", done)


def _stage(spark: SparkSession, plan: JobPlan, run: Run) -> int:
    """Write the rewritten rows to the plan's own folder and check them."""
    job = plan.job
    if spark.catalog.tableExists(job.stage):
        _discard(spark, plan)
    # Files that others have written since the table was last read count too.
    spark.catalog.refreshTable(job.table)
    require_partition(spark, job.table, plan.spec)
    old = partition_location(spark, job.table, plan.spec)
    noted = plan.folder + NOTED
    try:
        manifest.note_files(spark, old, noted)
        _require_each_row_once(spark, plan)
        for statement in plan.staging:
            spark.sql(statement)
        # Counted from the files that were written, not by evaluating again.
        rows = _checked_count(spark, plan, spark.table(job.stage))
        _set_stage_property(spark, job.stage, REPLACED_PROPERTY, old)
        _set_stage_property(spark, job.stage, RULES_PROPERTY, plan.mark)
        _set_stage_property(spark, job.stage, STATE_PROPERTY, CHECKED)
    except Exception:
        drop_table(spark, job.stage)
        for folder in (plan.folder, noted):
            purge_location(spark, job.helper, folder)
        raise
    return rows


def stage_only(spark: SparkSession, job: UpdateJob, mode: str | None = None) -> str:
    """Stage and check a job without committing it; the next run does, if nothing has changed.

    Gives the name of the stage, for a look at the rows before they are used.
    """
    plan = plan_job(spark, job, mode)
    _stage(spark, plan, Run(spark.sparkContext.applicationId, job.title))
    return job.stage


def _discard(spark: SparkSession, plan: JobPlan) -> None:
    """Drop a stage whose rows are not needed, with its folders."""
    folder = _folder(spark, plan.job)
    drop_table(spark, plan.job.stage)
    for each in (folder, folder + NOTED):
        purge_location(spark, plan.job.helper, each)


def _folder(spark: SparkSession, job: UpdateJob) -> str:
    """Where the staged rows lie."""
    return table_location(spark, job.stage).removesuffix(NOTED)


def _replaced(spark: SparkSession, job: UpdateJob) -> str:
    """Where the rows lay that the stage was made from."""
    return _stage_property(spark, job.stage, REPLACED_PROPERTY)


def _switched(spark: SparkSession, plan: JobPlan, folder: str) -> bool:
    """Whether the partition is the staged folder, whose last part no other folder has."""
    last = "/" + folder.rsplit("/", 1)[-1]
    return partition_location(spark, plan.job.table, plan.spec).rstrip("/").endswith(last)


def _begun(spark: SparkSession, plan: JobPlan) -> bool:
    """Whether the commit of a checked stage has begun, so that the stage counts."""
    if plan.mode == RENAME:
        return partition_exists(spark, plan.job.table, _aside(plan))
    if not partition_exists(spark, plan.job.table, plan.spec):
        return True
    return _switched(spark, plan, _folder(spark, plan.job))


def _stage_state(spark: SparkSession, stage: str) -> str | None:
    """How far an earlier run got with this stage, or None if it must be redone."""
    if not spark.catalog.tableExists(stage):
        return None
    return _stage_property(spark, stage, STATE_PROPERTY)


def _stage_property(spark: SparkSession, stage: str, key: str) -> str | None:
    rows = spark.sql(f"SHOW TBLPROPERTIES {stage}").collect()
    return {row.key: row.value for row in rows}.get(key)


def _set_stage_property(spark: SparkSession, stage: str, key: str, value: str) -> None:
    spark.sql(f"ALTER TABLE {stage} SET TBLPROPERTIES ('{key}' = '{value}')")


def _commit_by_switch(
    spark: SparkSession, plan: JobPlan, run: Run, folder: str, old: str
) -> None:
    """Point the partition at the stage's files, which may stem from an earlier run."""
    job = plan.job
    target = f"ALTER TABLE {job.table} PARTITION ({plan.spec.sql}) SET LOCATION "
    if not _switched(spark, plan, folder):
        spark.sql(f"{target}'{folder}'")
    if manifest.changes(spark, old, folder + NOTED).gone:
        # Somebody replaced the partition meanwhile; theirs is the later change.
        spark.sql(f"{target}'{old}'")
        raise ConcurrentChangeError(f"{job.title}: the partition was replaced meanwhile")
    _carry_late_rows(spark, plan, old, folder + NOTED)
    run.message = f"{job.title}: {INSERTED}"


def _carry_late_rows(spark: SparkSession, plan: JobPlan, old: str, noted: str) -> None:
    """Append the rows of files that came to the old folder after it was read.

    They are added as they are, as if they had been appended after the update.
    """
    job = plan.job
    while late := manifest.changes(spark, old, noted).late:
        if _stage_property(spark, job.stage, LATE_PROPERTY):
            raise UnfinishedJobError(
                f"{job.title}: interrupted while late rows were appended; see whether those of "
                f"{', '.join(late)} in {old} are in the table, and add their names to {noted}"
            )
        _set_stage_property(spark, job.stage, LATE_PROPERTY, str(len(late)))
        shadow = f"{job.stage}_late_{uuid.uuid4().hex[:8]}"
        spark.sql(f"CREATE TABLE {shadow} LIKE {job.table} LOCATION '{noted}'")
        spark.sql(f"ALTER TABLE {shadow} ADD PARTITION ({plan.spec.sql}) LOCATION '{old}'")
        names = ", ".join("'" + name.replace("'", "\\'") + "'" for name in late)
        columns = ", ".join(f"`{c}`" for c in plan.kept)
        spark.sql(
            f"INSERT INTO {job.table} PARTITION ({plan.spec.sql}) SELECT {columns} FROM {shadow} "
            f"WHERE _metadata.file_name IN ({names})"
        )
        drop_table(spark, shadow)
        files = manifest.list_files(spark, old)
        files.where(files["name"].isin(list(late))).write.mode("append").parquet(noted)
        _set_stage_property(spark, job.stage, LATE_PROPERTY, "")


def _commit_by_rename(
    spark: SparkSession, plan: JobPlan, run: Run, state: str | None, folder: str
) -> None:
    job, aside = plan.job, _aside(plan)
    (_, rename), (_, insert), _, _ = plan.commit
    if state != APPENDED and not (
        partition_exists(spark, job.table, aside) and _appended_unnoted(spark, plan, aside)
    ):
        spark.sql(rename)
        run.message = f"{job.title}: {RENAMED}"
        moved = partition_location(spark, job.table, aside)
        if manifest.changes(spark, moved, folder + NOTED).gone:
            _restore(spark, plan, aside)
            raise ConcurrentChangeError(f"{job.title}: the partition was replaced meanwhile")
        try:
            with (
                session_setting(spark, "hive.exec.dynamic.partition", "true"),
                session_setting(spark, "hive.exec.dynamic.partition.mode", "nonstrict"),
            ):
                spark.sql(insert)
        except Exception:
            # A failed insert commits no files, so nothing has moved yet.
            _restore(spark, plan, aside)
            raise
    _set_stage_property(spark, job.stage, STATE_PROPERTY, APPENDED)
    if partition_exists(spark, job.table, aside):
        moved = partition_location(spark, job.table, aside)
        _carry_late_rows(spark, plan, moved, folder + NOTED)
    run.message = f"{job.title}: {INSERTED}"


def _appended_unnoted(spark: SparkSession, plan: JobPlan, aside: PartitionSpec) -> bool:
    """After a lost driver: whether the stage's rows are in the table already.

    If none are, the old partition is brought back. Anything else is reported.
    """
    job = plan.job
    if plan.moves_rows:
        # Moved rows may already sit in other partitions, among theirs.
        raise ConflictingRulesError(
            f"{job.title}: interrupted while rows moved; compare {job.stage} "
            f"with the table and bring {aside.sql} back by hand"
        )
    spark.catalog.refreshTable(job.table)
    now = read_partition(spark, job.table, plan.spec.predicate)
    found = fingerprint(now, plan.kept)
    if found[0] and found == fingerprint(spark.table(job.stage), plan.kept):
        return True
    if found[0]:
        raise UnfinishedJobError(
            f"{job.title}: interrupted while the rows were appended, and others are there too; "
            f"compare {job.stage} with the table and bring {aside.sql} back by hand"
        )
    _restore(spark, plan, aside)
    return False


def _restore(spark: SparkSession, plan: JobPlan, aside: PartitionSpec) -> None:
    """Bring the old partition back from its recovery name, with rows appended meanwhile."""
    table, spec = plan.job.table, plan.spec
    if partition_exists(spark, table, spec):
        spark.catalog.refreshTable(table)
        columns = ", ".join(f"`{c}`" for c in plan.kept)
        if not read_partition(spark, table, spec.predicate).isEmpty():
            spark.sql(
                f"INSERT INTO {table} PARTITION ({aside.sql}) "
                f"SELECT {columns} FROM {table} WHERE {spec.predicate}"
            )
        drop_partition_if_exists(spark, table, spec)
    rename_partition(spark, table, aside, spec)
