"""Warehouse tables (S8-S13) as parts of parquet files that a published record names.

Every load writes a new part: ``<location>/tables/<table>/part=<id>`` (facts also by ``load_date``). A table is the parts
that the newest record of ``<location>/_published`` names, so nothing is changed in place. ``transaction`` groups
the loads of a run: inside it the run reads its own parts; its record is published at the end, all tables
at once, or not at all if a step or a check fails. ``snapshot`` reads the record once: a report over it sees one state
whatever runs publish meanwhile. Reading writes nothing and lists only the parts it needs.

The parts are partitions of catalog tables (``<table>_parts``; bucketed ones carry their bucket count in the
name), each session's own: a new process attaches what the record names. Parts left by a killed run are in no
record; ``vacuum`` deletes them.

A run replaces exactly its own ``load_date`` of the fact, also by no rows; the fact is never laid out by ``time_key``,
because a midnight loan shares its day with the next run. ``fact_load_days`` keeps, per run date, the loans of
each day (a run without facts has one row without a day): the calendar and the daily counts come from it, and it
tells which run dates a range of days can lie in.

``fact_group_nodes`` and ``fact_title_nodes`` hold the loans per subject group and per title of every dyadic interval of
days (``circulation.operators.dyadic``). A run makes the nodes of its own days anew, or changes those that other runs share by
the difference, and publishes them with its facts: any range is a sum over a few nodes, without a scan of facts.
"""

from __future__ import annotations

import logging
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from circulation import schemas
from circulation.functions.dates import DateLike, as_date
from circulation.operators.dyadic import UNDATED, Node, cover, day_number, holding, node_order, node_sums, spread
from circulation.session import materialise
from circulation.sinks.record import RETAIN, ConcurrentRunError, Part, Record, RecordStore

__all__ = ["BUCKET_KEYS", "CANONICAL", "ConcurrentRunError", "LOAD_DATE", "LOAD_DAYS", "Snapshot", "Warehouse"]

log = logging.getLogger(__name__)

# Extra storage column of fact_loans; the declared six columns come first.
LOAD_DATE = "load_date"
PART = "part"
# Canonical inventory rows of the latest month, written once by the monthly job and read by
# every daily job instead of re-ranking the whole month per day. Not bucketed: the daily fact join
# shuffles both sides, so that adaptive execution can split a book that holds many of the loans.
CANONICAL = "staging_canonical_inventory"
CANONICAL_SCHEMA = T.StructType(
    [T.StructField(n, t, True) for n, t in [("bibnum", T.LongType()), ("title", T.StringType()),
                                              ("publisher", T.StringType()), ("author", T.StringType()),
                                              ("subjects", T.StringType())]]
)
# Loans per day of every run date: a few rows per run, so the table is rewritten whole with each.
LOAD_DAYS = "fact_load_days"
LOAD_DAYS_SCHEMA = T.StructType([T.StructField("day", T.DateType(), True), T.StructField("loans", T.LongType(), True),
                                 T.StructField(LOAD_DATE, T.DateType(), True)])
EXTRA_SCHEMAS = {CANONICAL: CANONICAL_SCHEMA, LOAD_DAYS: LOAD_DAYS_SCHEMA}
# Roll-ups: the rows of a node. A loan's title is looked up as it is stored (books are insert-only, so it stays); a book not
# known then is kept by its number and looked up when it is read.
NODES = {"fact_group_nodes": "subject_group_id string, loans long", "fact_title_nodes": "title string, bibnumber long, loans long"}
# Codec of every part's files; parts of one table may differ in it.
COMPRESSION = "zstd"
# Loans whose nodes one task makes and sorts.
LOANS_PER_TASK = 500_000
EXTRA_TABLES = tuple(EXTRA_SCHEMAS)
# Tables with partition columns before the part: (name, SQL type).
PARTITIONED = {"fact_loans": ((LOAD_DATE, "DATE"),)}

_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")

# Tables bucketed on the key they are joined on, so later joins read them without a shuffle:
# the marts join the bridge on the group and dim_books on the book, after counting per group or book.
BUCKET_KEYS = {
    "bridge_subject": "subject_group_id",
    "dim_books": "bibnum",
}


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


class Snapshot:
    """The tables as one record names them."""

    def __init__(self, wh: Warehouse, record: Record):
        self.wh, self.record = wh, record

    def scan(self, table: str) -> DataFrame:
        return self.wh._read(self.record, table)

    def load_days(self) -> DataFrame:
        """(day, loans, load_date) of the whole fact. Run dates that came without a summary are counted here, not stored."""
        stored = self.scan(LOAD_DAYS)
        found = [p.values[LOAD_DATE] for p in self.record.tables.get("fact_loans", []) if not p.counted]
        known = {r[LOAD_DATE].isoformat() for r in stored.select(LOAD_DATE).distinct().collect()} if found else set()
        missing = [d for d in found if d not in known]
        if not missing:
            return stored
        rows = self.scan("fact_loans").where(F.col(LOAD_DATE).isin([as_date(d) for d in missing]))
        return stored.unionByName(_days_of(rows))

    def _nodes(self, lo: DateLike | None, hi: DateLike | None) -> list[Node] | None:
        """The nodes of a range that hold loans; None if some facts are in no node."""
        if not all(p.rolled for p in self.record.tables.get("fact_loans", [])):
            return None
        held = [tuple(int(x) for x in key.split("/")) for key in self.record.nodes]
        days = [node for level, node in held if level == 0]
        if not days:
            return [n for n in held if n == UNDATED and lo is None and hi is None]
        first = max(min(days), day_number(as_date(lo))) if lo is not None else min(days)
        last = min(max(days), day_number(as_date(hi))) if hi is not None else max(days)
        wanted = set(cover(first, last)) | ({UNDATED} if lo is None and hi is None else set())
        return sorted(wanted & set(held))

    def _read_nodes(self, table: str, nodes: list[Node]) -> DataFrame:
        """The rows of some nodes, with the node they belong to: a few folders, named one by one."""
        schema = T.StructType.fromDDL(f"{NODES[table]}, level int, node int")
        if not nodes:
            return self.wh.spark.createDataFrame([], schema)
        writes: dict[str, list[Node]] = {}
        for level, n in nodes:
            writes.setdefault(self.record.nodes[f"{level}/{n}"], []).append((level, n))
        # A write holds the nodes that its run changed, sorted by node: the filter on them skips row groups. Which of its
        # nodes are still its own is told by its folder (of a few writes, each is read on its own).
        if len(writes) <= 4:
            of = [self.wh.spark.read.schema(schema).parquet(f"{self.wh.location}/tables/{table}/{PART}={part}").where(_in_nodes(own))
                  for part, own in writes.items()]
            return reduce(DataFrame.unionByName, of)
        place, kept = F.regexp_extract(F.input_file_name(), f"/{PART}=([^/]+)/", 1), F.lit(False)
        for part, own in writes.items():
            kept = kept | (_in_nodes(own) & (F.col("_write") == part))
        paths = [f"{self.wh.location}/tables/{table}/{PART}={part}" for part in writes]
        rows = self.wh.spark.read.schema(schema).parquet(*paths).where(_in_nodes(nodes))
        return rows.withColumn("_write", place).where(kept).drop("_write")

    def group_counts(self, lo: DateLike | None = None, hi: DateLike | None = None) -> DataFrame | None:
        """(subject_group_id, _n): the loans of a range per subject group, from the nodes; None if facts lack theirs."""
        nodes = self._nodes(lo, hi)
        if nodes is None:
            return None
        return self._read_nodes("fact_group_nodes", nodes).groupBy("subject_group_id").agg(F.sum("loans").alias("_n"))

    def title_counts(self, lo: DateLike | None = None, hi: DateLike | None = None) -> tuple[DataFrame, int, int] | None:
        """(title, loans, level, node), each title once a node, the number of nodes, and the most rows that the writes with
        them hold; None if facts lack theirs."""
        nodes = self._nodes(lo, hi)
        if nodes is None:
            return None
        rows = self._read_nodes("fact_title_nodes", nodes)
        if self.record.unknown_books:
            books = self.scan("dim_books").select(F.col("bibnum").alias("bibnumber"), F.col("title").alias("late"))
            rows = rows.join(books, "bibnumber", "left").withColumn("title", F.coalesce("title", "late"))
            rows = rows.groupBy("title", "level", "node").agg(F.sum("loans").alias("loans"))
        most = sum(self.record.node_rows.get(part, 0) for part in {self.record.nodes[f"{level}/{n}"] for level, n in nodes})
        return rows.select("title", "loans", "level", "node"), len(nodes), most

    def row_count(self, table: str) -> int:
        """The rows counted as they were written; a scan only for parts found without a count."""
        parts = self.record.tables.get(table, [])
        if any(p.rows is None for p in parts):
            return self.scan(table).count()
        return sum(p.rows for p in parts)

    def counts(self, tables: list[str] | None = None) -> DataFrame:
        """(table, rows) of the tables, each scanned, in one job."""
        parts = [self.scan(t).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("table"), "rows")
                 for t in tables or [*schemas.TABLES, *EXTRA_TABLES]]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


def _in_nodes(nodes: list[Node]) -> Column:
    levels = sorted({level for level, _ in nodes})
    return reduce(Column.__or__, [(F.col("level") == x) & F.col("node").isin([n for level, n in nodes if level == x]) for x in levels])


def _days_of(fact: DataFrame) -> DataFrame:
    return fact.groupBy(F.col("time_key").cast("date").alias("day"), LOAD_DATE).agg(F.count(F.lit(1)).alias("loans")).select(
        "day", "loans", LOAD_DATE)


def _tasks(loans: int, cores: int) -> int:
    """Tasks that make the nodes of some loans, so that one can sort its nodes in memory; few loans keep no more cores busy."""
    return max(1, -(-loans // LOANS_PER_TASK), min(cores, -(-loans // 50_000)))


class Warehouse:
    """``buckets`` sets the bucket count of the tables in ``BUCKET_KEYS`` (default: the session's
    shuffle partitions). Keep it at least ``spark.sql.shuffle.partitions``: when the other join
    side shuffles anyway, the planner keeps a bucketed layout only if it has as many partitions.
    Without a ``location`` the tables lie in the database's own folder."""

    def __init__(self, spark: SparkSession, database: str, location: str | None = None, buckets: int | None = None):
        if not _NAME.match(database):
            raise ValueError(f"bad database name {database!r}")
        self.spark = spark
        self.database = database
        at = f" LOCATION '{location.rstrip('/')}'" if location is not None else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{at}")
        self.location = location.rstrip("/") if location is not None else spark.catalog.getDatabase(database).locationUri.rstrip("/")
        self.store = RecordStore(spark, self.location)
        self._attached: dict[str, set[str]] = {}  # catalog table -> parts that its catalog knows
        self._open: Record | None = None
        self._doomed: list[str] = []  # folders to delete once published
        self._made: list[str] = []
        found = self._latest()
        if buckets is not None and found.buckets and found.buckets != buckets:
            raise ValueError(f"warehouse at {self.location} is bucketed {found.buckets} ways, not {buckets}")
        self._buckets = found.buckets or buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    @property
    def buckets(self) -> int:
        """The bucket count is part of the stored data: files written with one count must not be read as another (a
        bucketed join would silently miss rows), so a record keeps it."""
        record = self._open or self._latest()
        return record.buckets or self._buckets

    # --- records ---------------------------------------------------------------------------

    def _latest(self) -> Record:
        return self.store.latest() or self._found()

    def _found(self) -> Record:
        """A location without a record: the plain folders there are adopted as parts, in place."""
        record = Record()
        for table in [*schemas.TABLES, *EXTRA_TABLES]:
            names = self.store.names(f"{self.location}/{table}")
            if table in PARTITIONED:
                days = [n for n in names if n.startswith(f"{LOAD_DATE}=")]
                record.tables[table] = [Part(f"found-{n[len(LOAD_DATE) + 1:]}", f"{table}/{n}", None, {LOAD_DATE: n[len(LOAD_DATE) + 1:]}) for n in days]
            elif any(n.endswith(".parquet") for n in names) and table not in BUCKET_KEYS:
                record.tables[table] = [Part("found", table)]
        record.tables = {t: parts for t, parts in record.tables.items() if parts}
        return record

    def snapshot(self) -> Snapshot:
        """What is published now (inside a transaction: what the transaction holds)."""
        return Snapshot(self, self._open or self._latest())

    @contextmanager
    def transaction(self) -> Iterator[Warehouse]:
        """Loads inside become visible together when it ends; none does if it fails or another run was first."""
        if self._open is not None:
            yield self
            return
        before = self._latest()
        before.buckets = before.buckets or self._buckets
        self._open, self._doomed, self._made = before.copy(), [], []
        try:
            yield self
            after = self._open
        except BaseException:
            for path in self._made:
                self.store.delete(f"{self.location}/{path}")
            raise
        finally:
            self._open = None
        if after.to_json() == before.to_json() and after.number:
            return
        after.number = before.number + 1
        kept = {p.path for parts in after.tables.values() for p in parts}
        gone = [p.path for parts in before.tables.values() for p in parts if p.path not in kept and p.path not in self._doomed]
        old = [path for number, path in after.trash if number <= after.number - RETAIN]
        after.trash = [x for x in after.trash if x[1] not in old] + [(after.number, path) for path in gone]
        try:
            self.store.publish(after)
        except ConcurrentRunError:
            for path in self._made:
                self.store.delete(f"{self.location}/{path}")
            raise
        for path in {*self._doomed, *old} - kept:
            self.store.delete(f"{self.location}/{path}")

    @property
    def frontier(self) -> dict[str, str]:
        """The last run date of each job."""
        return dict((self._open or self._latest()).frontier)

    def reach(self, job: str, run_date: DateLike) -> None:
        with self.transaction():
            self._open.frontier[job] = max(as_date(run_date).isoformat(), self._open.frontier.get(job, ""))

    # --- tables --------------------------------------------------------------------------

    def name(self, table: str, buckets: int | None = None) -> str:
        if not _NAME.match(table):
            raise ValueError(f"bad table name {table!r}")
        return f"`{self.database}`.`{self._stem(table, buckets)}`"

    def _stem(self, table: str, buckets: int | None) -> str:
        return f"{table}_parts_b{buckets or self.buckets}" if table in BUCKET_KEYS else f"{table}_parts"

    def schema_of(self, table: str) -> T.StructType:
        base = EXTRA_SCHEMAS.get(table) or schemas.TABLES[table]
        if table in PARTITIONED:
            return T.StructType(base.fields + [T.StructField(LOAD_DATE, T.DateType(), True)])
        return base

    def _data_schema(self, table: str) -> T.StructType:
        keys = {k for k, _ in PARTITIONED.get(table, ())}
        return T.StructType([f for f in self.schema_of(table).fields if f.name not in keys])

    def _attach(self, table: str, buckets: int) -> str:
        """The session's catalog table over the parts."""
        name = self.name(table, buckets)
        if name not in self._attached:
            keys = [*PARTITIONED.get(table, ()), (PART, "STRING")]
            columns = ", ".join([_ddl(self._data_schema(table)), *[f"`{k}` {kind}" for k, kind in keys]])
            layout = f"PARTITIONED BY ({', '.join(k for k, _ in keys)})"
            if table in BUCKET_KEYS:
                layout += f" CLUSTERED BY ({BUCKET_KEYS[table]}) INTO {buckets} BUCKETS"
            folder = f"{self.location}/tables/{self._stem(table, buckets)}"
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
                           f"OPTIONS (compression '{COMPRESSION}') {layout} LOCATION '{folder}'")
            self._attached[name] = set()
        return name

    def _spec(self, part: Part) -> str:
        keys = "".join(f"{k} = DATE'{v}', " for k, v in part.values.items())
        return f"PARTITION ({keys}{PART} = '{part.part}')"

    # S13
    def scan(self, table: str) -> DataFrame:
        return self.snapshot().scan(table)

    def _read(self, record: Record, table: str) -> DataFrame:
        name = self._attach(table, record.buckets or self._buckets)
        parts = record.tables.get(table, [])
        fresh = [p for p in parts if p.path not in self._attached[name]]
        if fresh:
            specs = " ".join(f"{self._spec(p)} LOCATION '{self.location}/{p.path}'" for p in fresh)
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {specs}")
            self._attached[name] |= {p.path for p in fresh}
        chosen = F.col(PART).isin(sorted({p.part for p in parts})) if parts else F.lit(False)
        columns = self.schema_of(table).fieldNames()
        return self.spark.table(name).where(chosen).select(*columns)

    # S8
    def create(self, table: str) -> None:
        """The table exists from now on, with the rows it has."""
        self.schema_of(table)
        with self.transaction():
            self._open.tables.setdefault(table, [])

    def create_all(self) -> None:
        with self.transaction():
            for table in [*schemas.TABLES, *EXTRA_TABLES]:
                self.create(table)

    def _write(self, table: str, df: DataFrame, values: dict[str, str] | None = None, order: str | None = None,
               files: int | None = None) -> Part | None:
        """A new part with the rows of ``df``, counted as they are written; None (and no part) if there are none."""
        record = self._open
        name = self._attach(table, record.buckets)
        part = f"{record.number + 1:06d}-{uuid.uuid4().hex[:12]}"
        made = Part(part, f"tables/{self._stem(table, record.buckets)}/" + "".join(f"{k}={v}/" for k, v in (values or {}).items())
                    + f"{PART}={part}", 0, values or {})
        columns = self._data_schema(table).fieldNames()
        shaped = df.select(*columns)
        if table in BUCKET_KEYS:
            # Same hash as the bucket id: each task writes one bucket, one file per load.
            shaped = shaped.repartition(record.buckets, F.col(BUCKET_KEYS[table]))
        elif files:
            shaped = shaped.coalesce(files)
        if order:
            shaped = shaped.sortWithinPartitions(order)  # row-group statistics prune ranges
        obs, view = Observation(f"load_{table}"), f"load_{uuid.uuid4().hex}"
        shaped.observe(obs, F.count(F.lit(1)).alias("rows")).createOrReplaceTempView(view)
        try:
            self.spark.sql(f"INSERT INTO {name} {self._spec(made)} SELECT {', '.join(columns)} FROM {view}")
        finally:
            self.spark.catalog.dropTempView(view)
        self._made.append(made.path)
        made.rows = int(obs.get["rows"])
        self._attached[name].add(made.path)
        if not made.rows:
            self._doomed.append(made.path)
            return None
        return made

    def _insert(self, table: str, df: DataFrame, overwrite: bool) -> int:
        with self.transaction():
            part = self._write(table, df)
            kept = [] if overwrite else self._open.tables.get(table, [])
            self._open.tables[table] = kept + ([part] if part else [])
            rows = part.rows if part else 0
            log.info("%s: %d rows %s, %d in the table", table, rows, "loaded" if overwrite else "appended", self.row_count(table))
            return rows

    # The rows may come from the table itself, as its old part stays until the record moves on.
    def replace(self, table: str, df: DataFrame, keep_if_empty: bool = False) -> int:
        """``keep_if_empty``: no rows leave the table as it is. Returns the rows written."""
        with self.transaction():
            before = self._open.tables.get(table, [])
            rows = self._insert(table, df, overwrite=True)
            if keep_if_empty and not rows:
                self._open.tables[table] = before
            return rows

    # S10
    def append(self, table: str, df: DataFrame) -> int:
        return self._insert(table, df, overwrite=False)

    def replace_run(self, run_date: DateLike, facts: DataFrame) -> int:
        """Make ``facts`` the whole of one run date's facts; returns how many the run date now has."""
        day = as_date(run_date).isoformat()
        with self.transaction():
            stored = self.snapshot().load_days()
            days = stored.where(F.col(LOAD_DATE) != F.lit(as_date(run_date)))
            # Days, not loans: a few rows per run date.
            held = stored.where("loans > 0").select("day", (F.col(LOAD_DATE) == F.lit(as_date(run_date))).alias("own")).distinct().collect()
            others = [p for p in self._open.tables.get("fact_loans", []) if p.values[LOAD_DATE] != day]
            part = self._write("fact_loans", facts, {LOAD_DATE: day}, order="time_key")
            counted = _days_of(self._parts("fact_loans", [part])).collect() if part else [(None, 0, as_date(run_date))]
            gone = [p for p in self._open.tables.get("fact_loans", []) if p not in others and p.rolled]
            mine = ({r["day"] for r in held if r["own"]} if gone else set()) | ({r["day"] for r in counted} if part else set())
            self._roll(gone, part, mine, {r["day"] for r in held if not r["own"]})
            self._open.tables["fact_loans"] = others + ([part] if part else [])
            new = self.spark.createDataFrame(counted, LOAD_DAYS_SCHEMA)
            # A few rows per run date: one file.
            summary = self._write(LOAD_DAYS, days.unionByName(new), order=LOAD_DATE, files=1)
            self._open.tables[LOAD_DAYS] = [summary]
            rows = part.rows if part else 0
        log.info("fact_loans: %d rows under run date %s", rows, day)
        return rows

    def _parts(self, table: str, parts: list[Part]) -> DataFrame:
        return self._read(Record(buckets=self._open.buckets, tables={table: parts}), table)

    def _changes(self, table: str, parts: list[Part], sign: int) -> DataFrame:
        """The loans of some parts of the fact per day and key of a node table, counted with a sign (of titles, a row per book)."""
        key = "subject_group_id" if table == "fact_group_nodes" else "bibnumber"
        facts = self._parts("fact_loans", parts).select(F.col("time_key").cast("date").alias("day"), key)
        counts = facts.groupBy("day", key).agg((F.count(F.lit(1)) * sign).alias("loans"))
        if table == "fact_group_nodes":
            return counts
        books = self.scan("dim_books").select(F.col("bibnum").alias("bibnumber"), "title", F.lit(True).alias("known"))
        # A row per book, not per title: what adds them up shuffles them by its own keys.
        named = counts.join(books, "bibnumber", "left").withColumn("bibnumber", F.when(F.col("known").isNull(), F.col("bibnumber")))
        return named.select("day", "title", "bibnumber", "loans")

    def _roll(self, gone: list[Part], new: Part | None, mine: set, others: set) -> None:
        """Make the nodes of the days of a run date (``mine``) those of its new facts and of the other runs' days.

        A node without a day of ``others`` is that of the new facts alone. The rest, a few a level unless runs share many days,
        change by the difference between the new facts and those that go."""
        if new is not None:
            new.rolled = new.counted = True
        if not gone and new is None:
            return
        view, record, nodes = Snapshot(self, self._open), self._open, holding(mine)
        kept = set(holding(others))
        shared = [n for n in nodes if n in kept and f"{n[0]}/{n[1]}" in record.nodes]
        tasks = _tasks(new.rows, self.spark.sparkContext.defaultParallelism) if new else 1
        part = f"{record.number + 1:06d}-{uuid.uuid4().hex[:12]}"
        for table in NODES:
            keys = [f.name for f in T.StructType.fromDDL(NODES[table]).fields if f.name != "loans"]
            rows = []
            if new:
                alone = node_sums(self._changes(table, [new], 1), keys, "loans", tasks)
                rows.append(alone.where(~_in_nodes(shared)) if shared else alone)
            if shared:
                change = [self._changes(table, parts, sign) for parts, sign in ((gone, -1), ([new] if new else [], 1)) if parts]
                both = [view._read_nodes(table, shared), *[spread(c, shared).select(*keys, "loans", "level", "node") for c in change]]
                sums = reduce(DataFrame.unionByName, both).groupBy("level", "node", *keys).agg(F.sum("loans").alias("loans"))
                rows.append(sums.where("loans != 0").select(*keys, "loans", "level", "node"))
            changed = reduce(DataFrame.unionByName, rows) if rows else view._read_nodes(table, [])
            # By node, the greatest counts first: a filter on nodes and a threshold on counts skip pages of every file.
            dealt = changed.sortWithinPartitions(node_order("loans"))
            self._made.append(f"tables/{table}/{PART}={part}")
            held = Observation(f"nodes_{uuid.uuid4().hex}")
            dealt.select(*keys, "loans", "level", "node").observe(held, F.count(F.lit(1)).alias("rows")).write.parquet(
                f"{self.location}/tables/{table}/{PART}={part}", compression=COMPRESSION)
            record.node_rows[part] = int(held.get["rows"])
        if not record.unknown_books:
            titles = self.spark.read.schema(f"{NODES['fact_title_nodes']}, level int, node int").parquet(f"{self.location}/tables/fact_title_nodes/{PART}={part}")
            record.unknown_books = not titles.where("bibnumber IS NOT NULL").isEmpty()
        schema = T.StructType.fromDDL(f"{NODES['fact_group_nodes']}, level int, node int")
        stored = self.spark.read.schema(schema).parquet(f"{self.location}/tables/fact_group_nodes/{PART}={part}")
        # Additions leave no node empty; after a correction those that still have rows are looked up.
        filled = {(r["level"], r["node"]) for r in stored.select("level", "node").distinct().collect()} if gone else set(nodes)
        before = {record.nodes.pop(f"{level}/{n}", None) for level, n in nodes} - {None}
        record.nodes |= {f"{level}/{n}": part for level, n in nodes if (level, n) in filled}
        held = set(record.nodes.values())
        record.node_rows = {x: n for x, n in record.node_rows.items() if x in held}
        record.trash += [(record.number + 1, f"tables/{t}/{PART}={x}") for x in sorted(before - held) for t in NODES]

    def load_days(self) -> DataFrame:
        return self.snapshot().load_days()

    def compact(self, table: str) -> int:
        """Rewrite a table into one part (one file per bucket): appends add a part each time.

        Through a copy: read from its own buckets, the planner would leave out the shuffle that gives one file each."""
        if table in PARTITIONED:
            raise ValueError(f"{table} is written once per load_date; nothing to compact")
        return self.replace(table, materialise(self.scan(table), f"compact-{table}"))

    def rebucket(self, buckets: int) -> None:
        """Write the bucketed tables anew with another bucket count and publish both at once."""
        with self.transaction():
            old = {t: materialise(self.scan(t), f"rebucket-{t}") for t in BUCKET_KEYS}
            self._open.buckets = buckets
            for t, df in old.items():
                if t in self._open.tables:
                    self.replace(t, df)
        self._buckets = buckets

    # S12
    def row_count(self, table: str) -> int:
        return self.snapshot().row_count(table)

    def counts(self, tables: list[str] | None = None) -> DataFrame:
        return self.snapshot().counts(tables)

    def tables(self) -> list[str]:
        """The warehouse tables that exist now."""
        held = self.snapshot().record.tables
        return [t for t in [*schemas.TABLES, *EXTRA_TABLES] if t in held]

    def truncate(self, table: str) -> None:
        """Delete every row; the table stays."""
        self.drop(table)
        self.create(table)

    # The files go once no record names them.
    def drop(self, table: str) -> None:
        self.schema_of(table)
        with self.transaction():
            self._doomed += [p.path for p in self._open.tables.pop(table, [])]
            if table == "dim_books":  # titles of nodes would no longer be those of the books
                for p in self._open.tables.get("fact_loans", []):
                    p.rolled = False
            if table in ("fact_loans", "dim_books"):
                self._doomed += [f"tables/{t}/{PART}={part}" for part in set(self._open.nodes.values()) for t in NODES]
                self._open.nodes, self._open.unknown_books = {}, False
            if table == "fact_loans":
                self._doomed += [p.path for p in self._open.tables.get(LOAD_DAYS, [])]
                self._open.tables[LOAD_DAYS] = []
            name = self.name(table, self._open.buckets)
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            self._attached.pop(name, None)

    def drop_all(self) -> None:
        with self.transaction():
            for table in [*schemas.TABLES, *EXTRA_TABLES]:
                self.drop(table)

    def vacuum(self) -> int:
        """Delete the parts that neither the newest record nor its trash names: what killed runs left. Not to be
        called while a run is on. Returns how many folders went."""
        record = self._latest()
        named = {p.path for parts in record.tables.values() for p in parts} | {path for _, path in record.trash}
        named |= {f"tables/{t}/{PART}={part}" for part in record.nodes.values() for t in NODES}
        gone = 0
        for stem in self.store.names(f"{self.location}/tables"):
            for first in self.store.names(f"{self.location}/tables/{stem}"):
                inner = [first] if first.startswith(f"{PART}=") else [
                    f"{first}/{n}" for n in self.store.names(f"{self.location}/tables/{stem}/{first}")]
                for folder in inner:
                    path = f"tables/{stem}/{folder}"
                    if f"{PART}=" in folder and path not in named:
                        self.store.delete(f"{self.location}/{path}")
                        gone += 1
        return gone
