"""Table maintenance: stage, overwrite, rename, swap, refresh."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.errors import SchemaMismatchError, UnfinishedJobError, WrongPartitionError

STAGE_FORMAT = "orc"
# Files of these formats need no table to be read, so a partition can be pointed
# at a folder of them.
SELF_DESCRIBING = ("parquet", "orc")
# Folder below the table's own that path listings skip.
REWRITTEN = "_rewritten"
# Suffixes of the tables that take part in swaps and refreshes.
BACKUP_SUFFIX = "_temp"
ASIDE_SUFFIX = "_temp2"
INCOMING = "_incoming_"
RETIRED = "_retired_"
# Property of a table that is to be renamed: a mark, the number of tables that
# bear it, and the new name.
JOURNAL = "millrace.rename_to"
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
ANSI = "spark.sql.ansi.enabled"
# Fixed value: how a catalog names the partition of NULL.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


# One ``column = value``: the column, and a quoted literal or a bare token.
LEVEL = re.compile(r"\s*`?(\w+)`?\s*=\s*(?:'((?:[^'\\]|\\.)*)'|([^\s'\"=<>(),]+))\s*", re.DOTALL)
BETWEEN_LEVELS = re.compile(r",|and(?=[\s`])", re.IGNORECASE)


@dataclass(frozen=True)
class PartitionSpec:
    """A partition by its values, ``column = value`` for each of its levels.

    One that names only the first of a table's partition columns stands for all
    partitions below it.
    """

    column: str
    value: str
    further: tuple[tuple[str, str], ...] = ()

    @classmethod
    def parse(cls, text: str) -> PartitionSpec:
        """Reads ``column = 'literal'`` or ``column = token``, and nothing beside it.

        Several levels have a comma or AND between them. A quote or backslash
        inside a literal follows a backslash.
        """
        levels, at = [], 0
        while True:
            match = LEVEL.match(text, at)
            if match is None:
                raise WrongPartitionError(f"not columns and their values: {text!r}")
            value = match[3] if match[2] is None else re.sub(r"\\(.)", r"\1", match[2])
            levels.append((match[1], value))
            if match.end() == len(text):
                return cls.of(levels)
            between = BETWEEN_LEVELS.match(text, match.end())
            if between is None:
                raise WrongPartitionError(f"not columns and their values: {text!r}")
            at = between.end()

    @classmethod
    def of(cls, levels: Sequence[tuple[str, str]]) -> PartitionSpec:
        names = [column.lower() for column, _ in levels]
        if len(set(names)) < len(names):
            raise WrongPartitionError(f"a partition column is named twice: {', '.join(names)}")
        return cls(*levels[0], tuple(levels[1:]))

    @property
    def levels(self) -> list[tuple[str, str]]:
        return [(self.column, self.value), *self.further]

    @property
    def columns(self) -> list[str]:
        """Names of the columns, in lower case."""
        return [column.lower() for column, _ in self.levels]

    @property
    def sql(self) -> str:
        """Text inside PARTITION (...)."""
        return ", ".join(
            f"`{c}`={'null' if v == NULL_PARTITION else _literal(v)}" for c, v in self.levels
        )

    @property
    def predicate(self) -> str:
        return self.predicate_of("")

    def predicate_of(self, prefix: str) -> str:
        """Condition on the columns of a table, named with this prefix."""
        return " AND ".join(
            f"{prefix}`{c}`" + (" IS NULL" if v == NULL_PARTITION else f"={_literal(v)}")
            for c, v in self.levels
        )

    def replaced(self, other: PartitionSpec) -> PartitionSpec:
        """These levels with the values of ``other`` where it names the column."""
        values = {column.lower(): value for column, value in other.levels}
        return PartitionSpec.of([(c, values.get(c.lower(), v)) for c, v in self.levels])


def _literal(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


@contextmanager
def session_setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Set a session option for one write and put the old value back."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def append_by_position(df: DataFrame, table: str) -> None:
    """Append rows by column position; the table's column names are not looked at."""
    df.write.mode("append").insertInto(table)


def stage_table(
    df: DataFrame, table: str, *, fmt: str = STAGE_FORMAT, files: int | None = None
) -> None:
    """Materialise a plan as a table.

    The plan's own partitioning decides the number of files; ``files`` forces a
    number at the price of a shuffle.
    """
    out = df if files is None else df.repartition(files)
    out.write.format(fmt).mode("overwrite").saveAsTable(table)


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def truncate_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"TRUNCATE TABLE {table}")


def rename_partition(
    spark: SparkSession, table: str, old: PartitionSpec, new: PartitionSpec
) -> None:
    """Rename a partition, or one after the other all that ``old`` stands for."""
    if is_whole(spark, table, old):
        pairs = [(old, old.replaced(new))]
    else:
        require_partition_column(spark, table, old)
        pairs = [(below, below.replaced(new)) for below in partitions_below(spark, table, old)]
    taken = [after.sql for _, after in pairs if partition_exists(spark, table, after)]
    if taken:
        raise WrongPartitionError(f"{table} already has {'; '.join(taken)}")
    for before, after in pairs:
        spark.sql(
            f"ALTER TABLE {table} PARTITION ({before.sql}) RENAME TO PARTITION ({after.sql})"
        )


def drop_partition(spark: SparkSession, table: str, spec: PartitionSpec) -> None:
    """Drop a partition, or all that a specification of the first columns stands for."""
    if is_whole(spark, table, spec):
        spark.sql(f"ALTER TABLE {table} DROP PARTITION ({spec.sql})")
        return
    require_partition_column(spark, table, spec)
    found = partitions_below(spark, table, spec)
    if not found:
        raise WrongPartitionError(f"{table} has no partition {spec.sql}")
    parts = ", ".join(f"PARTITION ({below.sql})" for below in found)
    spark.sql(f"ALTER TABLE {table} DROP {parts}")


def drop_partition_if_exists(spark: SparkSession, table: str, spec: PartitionSpec) -> None:
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec.sql})")


def partition_exists(spark: SparkSession, table: str, spec: PartitionSpec) -> bool:
    return bool(spark.sql(f"SHOW PARTITIONS {table} PARTITION ({spec.sql})").collect())


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    """Names below the description's heading for them; asking runs no job."""
    names = [row.col_name for row in spark.sql(f"DESCRIBE TABLE {table}").collect()]
    heading = "# Partition Information"
    if heading not in names:
        return []
    # The heading is followed by one for the names.
    return names[names.index(heading) + 2 :]


def require_partition_column(spark: SparkSession, table: str, spec: PartitionSpec) -> None:
    """Refuse a partition that does not name the table's partition columns, from the first on."""
    columns = [c.lower() for c in partition_columns(spark, table)]
    if sorted(spec.columns) != sorted(columns[: len(spec.columns)]):
        raise WrongPartitionError(
            f"{table} is partitioned by {', '.join(columns) or 'nothing'}, "
            f"not by {', '.join(spec.columns)}"
        )


def is_whole(spark: SparkSession, table: str, spec: PartitionSpec) -> bool:
    """Whether the partition has a value for each of the table's partition columns."""
    return len(spec.levels) == len(partition_columns(spark, table))


def partitions_below(spark: SparkSession, table: str, spec: PartitionSpec) -> list[PartitionSpec]:
    """The table's partitions that a specification stands for, itself if it names all columns."""
    shown = spark.sql(f"SHOW PARTITIONS {table} PARTITION ({spec.sql})").collect()
    return [_named(row.partition) for row in shown]


def require_partition(spark: SparkSession, table: str, spec: PartitionSpec) -> None:
    if not partition_exists(spark, table, spec):
        raise WrongPartitionError(f"{table} has no partition {spec.sql}")


def new_folder(spark: SparkSession, table: str, label: str) -> str:
    """A folder for rewritten rows; none is used twice, so a lost writer spoils nothing."""
    return f"{table_location(spark, table)}/{REWRITTEN}/{label}-{uuid.uuid4().hex}"


def _described(spark: SparkSession, statement: str, name: str) -> str | None:
    # Collecting a catalog command as it is runs no job.
    for row in spark.sql(statement).collect():
        if row.col_name == name:
            return row.data_type
    return None


def table_provider(spark: SparkSession, table: str) -> str:
    return (_described(spark, f"DESCRIBE TABLE EXTENDED {table}", "Provider") or "").lower()


def table_location(spark: SparkSession, table: str) -> str:
    return _described(spark, f"DESCRIBE TABLE EXTENDED {table}", "Location")


def partition_location(spark: SparkSession, table: str, spec: PartitionSpec) -> str:
    return _described(
        spark, f"DESCRIBE TABLE EXTENDED {table} PARTITION ({spec.sql})", "Location"
    )


def purge_statements(helper: str, location: str) -> list[str]:
    """Delete a folder no table uses any more, by SQL alone.

    A helper table adopts the folder as a partition and drops it with its files.
    """
    return [
        f"CREATE TABLE {helper} (x int, p string) USING parquet PARTITIONED BY (p)",
        f"ALTER TABLE {helper} ADD PARTITION (p='0') LOCATION '{location}'",
        f"ALTER TABLE {helper} DROP PARTITION (p='0')",
        f"DROP TABLE {helper}",
    ]


def purge_location(spark: SparkSession, helper: str, location: str) -> None:
    drop_table(spark, helper)
    for statement in purge_statements(helper, location):
        spark.sql(statement)


def rename_table(spark: SparkSession, old: str, new: str) -> None:
    """Rename a table, and see to it that its partitions follow its files.

    A metastore moves partition locations along with the table. The in-memory
    catalog leaves them behind, where another table's files may come to lie.
    """
    root = table_location(spark, old)
    places = {}
    if spark.conf.get("spark.sql.catalogImplementation") == "in-memory":
        places = _partition_places(spark, old)
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")
    for spec, place in places.items():
        if place.startswith(root + "/"):
            place = table_location(spark, new) + place.removeprefix(root)
        spark.sql(f"ALTER TABLE {new} PARTITION ({spec}) SET LOCATION '{place}'")


def _partition_places(spark: SparkSession, table: str) -> dict[str, str]:
    """Location of every partition, by its PARTITION (...) text."""
    if _described(spark, f"DESCRIBE TABLE EXTENDED {table}", "# Partition Information") is None:
        return {}
    names = [r.partition for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    specs = [_named(name).sql for name in names]
    return {
        spec: _described(
            spark, f"DESCRIBE TABLE EXTENDED {table} PARTITION ({spec})", "Location"
        )
        for spec in specs
    }


def _named(name: str) -> PartitionSpec:
    """The partition that a catalog names ``a=x/b=y``."""
    levels = [part.partition("=")[::2] for part in name.split("/")]
    return PartitionSpec.of([(unquote(column), unquote(value)) for column, value in levels])


def mark_renames(spark: SparkSession, moves: dict[str, str]) -> None:
    """Note on each table the name it shall have, so that any later call can see to it."""
    mark = uuid.uuid4().hex
    for old, new in moves.items():
        _set_property(spark, old, JOURNAL, f"{mark} {len(moves)} {new}")


def rename_all(spark: SparkSession, moves: dict[str, str], aside: str) -> None:
    """Give tables new names, which may be one another's.

    Every table is first marked with the name it shall have. A failure undoes
    what is done; a lost driver leaves the marks, and :func:`finish_renames`
    carries out the rest. ``aside`` is a name to hold one table meanwhile.
    """
    mark_renames(spark, moves)
    done: list[tuple[str, str]] = []
    try:
        _carry_out(spark, moves, aside, done)
    except Exception:
        for old, new in reversed(done):
            rename_table(spark, new, old)
        for old in moves:
            _unset_property(spark, old, JOURNAL)
        raise
    for new in moves.values():
        _unset_property(spark, new, JOURNAL)


def _carry_out(
    spark: SparkSession, moves: dict[str, str], aside: str, done: list[tuple[str, str]]
) -> None:
    """Rename what has not its name yet, whatever has been done before."""
    left = {old: new for old, new in moves.items() if old != new}
    while left:
        free = [old for old, new in left.items() if not spark.catalog.tableExists(new)]
        if free:
            old = free[0]
            new = left.pop(old)
        elif aside in left:
            raise UnfinishedJobError(f"{left[aside]} is taken; {aside} shall have that name")
        else:
            # Only a ring is left: one table steps aside.
            old, new = next(iter(left)), aside
            left[aside] = left.pop(old)
        rename_table(spark, old, new)
        done.append((old, new))


def finish_renames(spark: SparkSession, table: str) -> bool:
    """Carry out renames of a table and its helpers that a lost driver has left.

    True if there were any. Marks on some of the tables only mean that no
    rename had begun or that all had ended; they are taken off.
    """
    marks: dict[str, dict[str, str]] = {}
    sizes: dict[str, int] = {}
    for name in [table, *_helpers(spark, table)]:
        value = _property(spark, name, JOURNAL) if spark.catalog.tableExists(name) else None
        if value:
            mark, size, new = value.split(" ", 2)
            marks.setdefault(mark, {})[name] = new
            sizes[mark] = int(size)
    found = False
    for mark, moves in marks.items():
        if len(moves) == sizes[mark]:
            found = found or any(old != new for old, new in moves.items())
            _carry_out(spark, moves, table + ASIDE_SUFFIX, [])
            moves = {new: new for new in moves.values()}
        for name in moves:
            _unset_property(spark, name, JOURNAL)
    return found


def _helpers(spark: SparkSession, table: str) -> list[str]:
    """Tables named like those that swaps and refreshes of a table use."""
    database, _, short = table.rpartition(".")
    place = f" IN {database}" if database else ""
    rows = spark.sql(f"SHOW TABLES{place} LIKE '{short.strip('`')}_*'").collect()
    known = re.compile(
        re.escape(short.strip("`").lower())
        + f"({BACKUP_SUFFIX}|{ASIDE_SUFFIX}|({INCOMING}|{RETIRED})[0-9a-f]{{8}})"
    )
    prefix = f"{database}." if database else ""
    return [prefix + r.tableName for r in rows if not r.isTemporary and known.fullmatch(r.tableName)]


def _property(spark: SparkSession, table: str, key: str) -> str | None:
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    return {row.key: row.value for row in rows}.get(key)


def _set_property(spark: SparkSession, table: str, key: str, value: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{key}' = '{value}')")


def _unset_property(spark: SparkSession, table: str, key: str) -> None:
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{key}')")


def swap_tables(spark: SparkSession, table: str) -> None:
    """Exchange ``t`` and ``t_temp``; doing it twice restores the start.

    A call that finds renames a lost driver has left finishes them and does no
    more: it is the other call run again.
    """
    if finish_renames(spark, table):
        return
    backup = table + BACKUP_SUFFIX
    for name in (table, backup):
        spark.table(name)  # both must exist before either is marked
    rename_all(spark, {table: backup, backup: table}, table + ASIDE_SUFFIX)


def refresh_by_swap(spark: SparkSession, table: str, df: DataFrame) -> None:
    """Replace all rows of ``t`` and keep the previous ones in ``t_temp``.

    ``df`` is inserted by position into a fresh table, so it may read ``t`` and
    ``t_temp``: the old backup goes only after the new rows are complete. What a
    lost driver has left of an earlier refresh is finished first: its renames
    are carried out, or its rows dropped if these had not begun. One refresh of
    a table runs at a time.
    """
    finish_renames(spark, table)
    for name in _helpers(spark, table):
        if re.search(f"({INCOMING}|{RETIRED})[0-9a-f]+$", name):
            drop_table(spark, name)
    backup = table + BACKUP_SUFFIX
    _require_same_types(df, spark.table(table))
    if spark.catalog.tableExists(backup):
        _require_same_types(spark.table(backup), spark.table(table))
    incoming = f"{table}{INCOMING}{uuid.uuid4().hex[:8]}"
    retired = f"{table}{RETIRED}{uuid.uuid4().hex[:8]}"
    try:
        spark.sql(f"CREATE TABLE {incoming} LIKE {table}")
        append_by_position(df, incoming)
        moves = {table: backup, incoming: table}
        if spark.catalog.tableExists(backup):
            moves[backup] = retired
        rename_all(spark, moves, table + ASIDE_SUFFIX)
    except Exception:
        drop_table(spark, incoming)
        raise
    drop_table(spark, retired)


def _require_same_types(df: DataFrame, table: DataFrame) -> None:
    got = [f.dataType for f in df.schema.fields]
    want = [f.dataType for f in table.schema.fields]
    if got != want:
        raise SchemaMismatchError(
            f"expected columns of types {[t.simpleString() for t in want]}, "
            f"got {[t.simpleString() for t in got]}"
        )


def overwrite_partition(
    spark: SparkSession, table: str, df: DataFrame, spec: PartitionSpec
) -> None:
    """Replace exactly one partition, creating it if absent.

    ``df`` has the table's columns by position, without the partition columns
    the specification names, and may read the table. If it names only the first
    ones, the rows carry the others and replace all partitions below it: those
    without new rows are dropped. The rows are cast to the table's types and
    written completely before anything changes; values that do not fit fail
    there. Then each partition is pointed at its new files, in one step for
    readers, whatever the table's format.
    """
    require_partition_column(spark, table, spec)
    if set(spec.columns) & {c.lower() for c in df.columns}:
        raise SchemaMismatchError(
            f"rows must not carry the partition column {' or '.join(spec.columns)}"
        )
    fields = [f for f in spark.table(table).schema.fields if f.name.lower() not in spec.columns]
    if len(df.columns) != len(fields):
        raise SchemaMismatchError(f"expected {len(fields)} columns, got {len(df.columns)}")
    plain = df.toDF(*[f"c{k}" for k in range(len(fields))])
    shadow = f"{table}_shadow_{uuid.uuid4().hex[:8]}"
    view = f"rows_{uuid.uuid4().hex}"
    folder = new_folder(spark, table, "overwrite")
    order = partition_columns(spark, table)
    # A table like the target, at folders of its own, writes any format with
    # the target's options; dropping it leaves the files.
    try:
        with (
            session_setting(spark, ANSI, "true"),
            session_setting(spark, OVERWRITE_MODE, "static"),
            session_setting(spark, "hive.exec.dynamic.partition.mode", "nonstrict"),
        ):
            typed = plain.select(
                *[F.col(f"c{k}").cast(f.dataType).alias(f.name) for k, f in enumerate(fields)]
            )
            spark.sql(f"CREATE TABLE {shadow} LIKE {table} LOCATION '{folder}'")
            into = [f"`{c}`" + _value_in(spec, c) for c in order]
            typed.createOrReplaceTempView(view)
            if len(spec.levels) == len(order):
                # Also there if no rows are.
                spark.sql(f"ALTER TABLE {shadow} ADD PARTITION ({spec.sql})")
            spark.sql(
                f"INSERT OVERWRITE TABLE {shadow} PARTITION ({', '.join(into)}) SELECT * FROM {view}"
            )
        written = {
            below.sql: (below, partition_location(spark, shadow, below))
            for below in partitions_below(spark, shadow, spec)
        }
    except Exception:
        drop_table(spark, shadow)
        purge_location(spark, shadow, folder)
        raise
    finally:
        spark.catalog.dropTempView(view)
    drop_table(spark, shadow)
    gone = [p for p in partitions_below(spark, table, spec) if p.sql not in written]
    for below, place in written.values():
        _point_at(spark, table, below, place, shadow)
    for below in gone:
        drop_partition(spark, table, below)


def _value_in(spec: PartitionSpec, column: str) -> str:
    """``='value'`` of a column that a specification names, else nothing."""
    for name, value in spec.levels:
        if name.lower() == column.lower():
            return "=null" if value == NULL_PARTITION else f"={_literal(value)}"
    return ""


def _point_at(
    spark: SparkSession, table: str, spec: PartitionSpec, folder: str, helper: str
) -> None:
    """Let the partition be the files of ``folder``, and delete what it was before."""
    if not partition_exists(spark, table, spec):
        spark.sql(f"ALTER TABLE {table} ADD PARTITION ({spec.sql}) LOCATION '{folder}'")
        return
    old = partition_location(spark, table, spec)
    spark.sql(f"ALTER TABLE {table} PARTITION ({spec.sql}) SET LOCATION '{folder}'")
    purge_location(spark, helper, old)
