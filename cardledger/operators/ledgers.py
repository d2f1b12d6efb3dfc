"""Ledgers as plain catalog tables: write new files, count them, then show them in one statement.

Spark refuses to overwrite a table it reads, and plain files have no MERGE.  So every change
writes its rows into folders of its own, ``batch=<unique name>`` below the table's folder, and
counts them while it writes.  Readers see views.  Below a view stands a partitioned table:

* *append* adds the batch's partitions to that table in one statement;
* *replace* declares a table beside it, with the new partitions and those that stay, and one
  ``ALTER VIEW`` turns the readers over.  There is no moment at which a row is shown twice or
  not at all, whatever statement a run dies before.

A booking has a name that its staged batch gives it, and the folders carry it: a repeated run
sees which tables hold it already, leaves those as they are and ends the change.  While one is
unfinished, no other booking begins.

Master and balances are dealt into buckets by the key that the feeds look up, one sorted file
each (``CLUSTERED BY ... SORTED BY``), so joins by that key move and sort the feed only; an update
rewrites the buckets it touches.  The number of buckets is set when a store is created.  The
other tables are partitioned by their own keys (month) and by batch.  Tables are external:
replaced files stay until ``expire`` deletes what no table shows.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LEDGERS = ("l_anag", "l_balance", "l_transaction", "l_booked")
BATCH = "batch"
ADDED = "added.columns"

BUCKET = "bucket"
#: The key by which a table is dealt into buckets: the one that feeds look it up by.
DEALT = {
    "l_anag": ("product_company", "account_number"),
    "l_balance": ("product_company", "customer_number"),
}
#: Buckets of a new store; one for every few hundred thousand rows keeps a bucket in one task's memory.
BUCKETS = 64
#: A partition below this is merged with others of its keys by a rewrite.
SMALL_BYTES = 64 << 20


class LedgerMismatch(Exception):
    """The written rows are not the rows that were expected; the tables are as they were."""


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a row, as Spark itself deals rows into the files of a clustered table."""
    return F.pmod(F.hash(*keys), F.lit(buckets))


def booking_mark(source: str) -> str:
    """The part of a batch name by which a repeated run knows its own files."""
    return f"-book{hashlib.md5(source.encode()).hexdigest()[:16]}-"


def _literal(value) -> str:
    if value is None:
        return "NULL"
    return str(value) if isinstance(value, int) else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


class LedgerStore:
    """The tables below one shared folder, in a catalog database named after it."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt
        self.database = "ledgers_" + hashlib.md5(self.root.encode()).hexdigest()[:12]
        self._buckets: int | None = None

    @classmethod
    def create(
        cls,
        spark: SparkSession,
        root: str,
        schemas: dict[str, StructType],
        fmt: str = "parquet",
        partition_by: dict[str, Sequence[str]] | None = None,
        buckets: int = BUCKETS,
    ) -> LedgerStore:
        """A new store with empty tables; fails when the catalog already holds one of this folder."""
        store = cls(spark, root, fmt)
        store.run(f"CREATE DATABASE {store.database} WITH DBPROPERTIES ('buckets' = '{buckets}')")
        for name, schema in schemas.items():
            store.create_table(name, schema, (partition_by or {}).get(name, ()))
        return store

    def run(self, statement: str) -> DataFrame:
        """One catalog statement."""
        return self.spark.sql(statement)

    @property
    def buckets(self) -> int:
        if self._buckets is None:
            rows = self.run(f"DESCRIBE DATABASE EXTENDED {self.database}").collect()
            text = next(r[1] for r in rows if r[0] == "Properties")
            self._buckets = int(re.search(r"buckets,\s*(\d+)", text)[1])
        return self._buckets

    def bucket(self, table: str) -> Column:
        return bucket_of(DEALT[_base(table)], self.buckets)

    # ---- declaring ------------------------------------------------------------

    def create_table(self, table: str, schema: StructType, keys: Sequence[str] = ()) -> None:
        """A table without rows and the view that shows it; partition keys stand last."""
        keys = (BUCKET,) if _base(table) in DEALT else tuple(keys)
        columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name not in keys]
        columns += [f"`{k}` {schema[k].dataType.simpleString() if k in schema.names else 'int'}" for k in keys]
        below = self._declare(table, columns, keys, f"{self.root}/{table}")
        shown = [*(f.name for f in schema.fields), *(k for k in keys if k not in schema.names), BATCH]
        self.run(f"CREATE VIEW {self.name(table)} AS {self._selection(below, shown)}")

    def _declare(self, table: str, columns: Sequence[str], keys: Sequence[str], location: str) -> str:
        """A table without partitions; returns its name."""
        below = f"{table}__{uuid.uuid4().hex[:12]}"
        levels = ", ".join(f"`{key}`" for key in (*keys, BATCH))
        dealt = ""
        if _base(table) in DEALT:
            names = ", ".join(f"`{k}`" for k in DEALT[_base(table)])
            dealt = f" CLUSTERED BY ({names}) SORTED BY ({names}) INTO {self.buckets} BUCKETS"
        self.run(
            f"CREATE TABLE {self.name(below)} ({', '.join(columns)}, `{BATCH}` string) USING {self.fmt} "
            f"PARTITIONED BY ({levels}){dealt} LOCATION '{location}'"
        )
        return below

    def _selection(self, below: str, columns: Sequence[str]) -> str:
        return f"SELECT {', '.join(f'`{c}`' for c in columns)} FROM {self.name(below)}"

    def below(self, table: str) -> str:
        """The name of the table that a view shows."""
        rows = self.run(f"DESCRIBE TABLE EXTENDED {self.name(table)}").collect()
        text = next(r[1] for r in rows if r[0] == "View Text")
        return re.search(r"FROM \w+\.`([^`]+)`", text)[1]

    def beside(self, table: str) -> str:
        """A table like the one that ``table`` shows, without partitions."""
        like = self.below(table)
        rows = self.run(f"SHOW CREATE TABLE {self.name(like)}").first()[0]
        fresh = f"{table}__{uuid.uuid4().hex[:12]}"
        self.run(re.sub(r"^CREATE TABLE \S+", f"CREATE TABLE {self.name(fresh)}", rows, count=1))
        return fresh

    # ---- reading ---------------------------------------------------------------

    def name(self, table: str) -> str:
        return f"{self.database}.`{table}`"

    def has(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def read(self, table: str, tag: str | None = None) -> DataFrame:
        return self.rows_with_places(table, tag).drop(BATCH, BUCKET)

    def rows_with_places(self, table: str, tag: str | None = None) -> DataFrame:
        """A table with its bucket and batch columns, or the copy of it in a snapshot."""
        shown = table if tag is None else _copy_name(table, tag)
        if not self.has(shown):
            raise KeyError(f"no table {table}" + (f" in snapshot {tag}" if tag else ""))
        return self.spark.table(self.name(shown))

    def rows(self, table: str, tag: str | None = None) -> int:
        """Counted from the files of the table; needs their footers only."""
        return self.read(table, tag).count()

    def keys(self, table: str) -> list[str]:
        """Partition keys before the batch."""
        rows = [r[0] for r in self.run(f"DESCRIBE TABLE {self.name(self.below(table))}").collect()]
        named = rows[rows.index("# Partition Information") + 2 :]
        return named[: named.index(BATCH)]  # the last level; column defaults may follow

    def paths(self, table: str) -> list[str]:
        """The partitions of a table: control rows, one per bucket, or a few per run and month."""
        return self._partitions(self.below(table)) if self.has(table) else []

    def _partitions(self, below: str) -> list[str]:
        return sorted(r[0] for r in self.run(f"SHOW PARTITIONS {self.name(below)}").collect())

    def batches(self, table: str) -> list[str]:
        return sorted({_batch(path) for path in self.paths(table)})

    def booked(self, source: str) -> bool:
        """Whether the ledgers hold this batch, so that none is booked twice."""
        return not self.read("l_booked").filter(F.col("source") == source).isEmpty()

    def unfinished(self) -> set[str]:
        """Marks of bookings that master or balances hold and the list of booked batches does not."""
        found = {m[0] for t in DEALT for b in self.batches(t) if (m := re.search(r"-book[0-9a-f]{16}-", b))}
        if not found:
            return set()
        mark = F.concat(F.lit("-book"), F.substring(F.md5(F.col("source").cast("binary")), 1, 16), F.lit("-"))
        ended = self.read("l_booked").select(mark.alias("mark")).filter(F.col("mark").isin(sorted(found))).distinct()
        return found - {r["mark"] for r in ended.collect()}

    # ---- writing and maintenance -------------------------------------------------

    def begin(self, run_ts: str, source: str, booking: bool = False) -> Change:
        """A change; a booking has a mark of its own and waits until an unfinished one is repeated."""
        change = Change(self, run_ts, source, booking)
        if booking and (others := self.unfinished() - {change.mark}):
            raise LedgerMismatch(f"another booking has not ended, repeat it first: {', '.join(sorted(others))}")
        return change

    def snapshot(self, tag: str, run_ts: str, tables: Sequence[str] = LEDGERS) -> None:
        """M1: a dated copy of the ledgers, counted; refused when one of the three is empty."""
        counts = {t: self.rows(t) for t in tables}
        empty = [t for t, n in counts.items() if not n and t != "l_booked"]
        if empty:
            raise LedgerMismatch("no snapshot of empty tables: " + ", ".join(empty))
        change = self.begin(run_ts, f"snapshot {tag}")
        for table in tables:
            copy = _copy_name(table, tag)
            if self.has(copy):
                raise LedgerMismatch(f"snapshot {tag} exists")
            self.create_table(copy, self.read(table).schema, self.keys(table))
            change.replace(copy, self.read(table), expect_rows=counts[table])
        change.commit()

    def restore(self, tag: str, run_ts: str) -> None:
        """M2, M3: the ledgers become what the copy holds, all written and counted before the first switch (Q16).

        Batches that were booked after the snapshot are not booked any more.  A run that died
        is repeated: every table is either as it was or as the copy.
        """
        saved = [t for t in LEDGERS if self.has(_copy_name(t, tag))]
        if not saved:
            raise KeyError(f"no snapshot {tag}")
        change = self.begin(run_ts, f"restore {tag}")
        for table in saved:
            change.replace(table, self.read(table, tag), expect_rows=self.rows(table, tag), as_given=True)
        change.commit()

    def sizes(self, table: str) -> dict[str, tuple[int, int]]:
        """Bytes and files of every folder below the table's, by its path from there; contents are not read."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{self.root}/{table}")
        folder = F.regexp_extract("path", rf"/({BATCH}=.*)/[^/]+$", 1)
        found = files.groupBy(folder.alias("folder")).agg(F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files"))
        return {r["folder"]: (r["bytes"], r["files"]) for r in found.collect()}

    def rewrite(self, tables: Sequence[str], run_ts: str, small_bytes: int = SMALL_BYTES) -> None:
        """M4: partitions of the same keys that are small are merged into one; large ones keep their files.

        A bucket is one file already, so dealt tables need no rewrite.
        """
        change = self.begin(run_ts, "rewrite")
        for table in tables:
            if _base(table) in DEALT:
                continue
            sizes = self.sizes(table) if self.paths(table) else {}
            groups: dict[str, list[str]] = {}
            for path in self.paths(table):
                key, batch = path.rpartition("/")[0], path.rpartition("/")[2]
                size, files = sizes.get("/".join(p for p in (batch, key) if p), (0, 0))
                if size < small_bytes:
                    groups.setdefault(key, []).append(path)
            merged = [path for paths in groups.values() if len(paths) > 1 for path in paths]
            if merged:
                change.merge(table, merged)
        change.commit()

    def migrate_column(self, table: str, name: str, value, after: str, run_ts: str) -> None:
        """M5 on a stored table: no file changes.  Old files lack the column and show ``value``; the view orders it."""
        shown = self.rows_with_places(table).columns
        if after not in shown:
            raise ValueError(f"no column {after}")
        below = self.below(table)
        kind = "int" if isinstance(value, int) else "string"
        if name not in self.spark.table(self.name(below)).columns:
            self.run(f"ALTER TABLE {self.name(below)} ADD COLUMNS (`{name}` {kind} DEFAULT {_literal(value)})")
            self.run(f"ALTER TABLE {self.name(below)} SET TBLPROPERTIES ('{ADDED}' = '{' '.join([*self.added_columns(table), name])}')")
        at = shown.index(after) + 1
        order = [*shown[:at], name, *shown[at:]]
        self.run(f"ALTER VIEW {self.name(table)} AS {self._selection(below, order)}")

    def added_columns(self, table: str) -> list[str]:
        """Columns of migrations, which appended rows need not have."""
        found = self.run(f"SHOW TBLPROPERTIES {self.name(self.below(table))}").collect()
        return next((r["value"].split() for r in found if r["key"] == ADDED), [])

    def reset(self, table: str, run_ts: str) -> None:
        """An empty staged table; its rows stay in the history table."""
        change = self.begin(run_ts, f"reset {table}")
        change.clear(table)
        change.commit()

    def expired_folders(self, table: str) -> list[str]:
        """Batches below the table's folder that no table shows: what a clean-up may delete."""
        tables = [t.name for t in self.spark.catalog.listTables(self.database) if "__" in t.name]
        shown = {_batch(p) for t in tables for p in self._partitions(t)}
        try:
            found = {folder.split("/")[0].removeprefix(f"{BATCH}=") for folder in self.sizes(table)}
        except Exception as error:  # nothing was ever written below the table's folder
            if "PATH_NOT_FOUND" in str(error):
                return []
            raise
        return sorted(found - shown - {""})

    def expire(self, table: str, before_run: str) -> list[str]:
        """Deletes the unshown batches of runs before ``before_run`` (a run timestamp); returns their names.

        Runs that have not ended are unshown too: name a run older than any that still works.
        """
        gone = [b for b in self.expired_folders(table) if b.split("-")[0] < before_run]
        context = self.spark.sparkContext
        for batch in gone:
            folder = context._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{table}/{BATCH}={batch}")
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
        return gone


class Change:
    """New files of one run; ``commit`` shows all of them."""

    def __init__(self, store: LedgerStore, run_ts: str, source: str, booking: bool = False):
        self.store, self.run_ts, self.source = store, run_ts, source
        self.mark = booking_mark(source) if booking else "-"
        self.batch = f"{re.sub(r'[^0-9A-Za-z]', '', run_ts)}{self.mark}{uuid.uuid4().hex[:16]}"
        self.booking = booking
        self.added: dict[str, list[tuple[dict, str]]] = {}  # table -> (partition, folder)
        self.kept: dict[str, list[str]] = {}  # replaced table -> partitions that stay
        self.columns: dict[str, list[str]] = {}  # replaced table -> columns, where they change
        self.written: dict[str, int] = {}
        self.replaced_rows: dict[str, int] = {}
        self.seen: dict[str, tuple[str, list[str]]] = {}  # replaced table -> the table below, its partitions
        self.counted: dict[str, int] = {}

    def ended(self, table: str) -> bool:
        """Whether an earlier attempt of this booking has changed the table."""
        return self.booking and any(self.mark in path for path in self.store.paths(table))

    def _look(self, table: str) -> list[str]:
        """The partitions of a table that this change replaces, as they are before it reads them."""
        if table not in self.seen:
            below = self.store.below(table)
            self.seen[table] = below, self.store._partitions(below)
        return self.seen[table][1]

    def _write(
        self, table: str, rows: DataFrame, keys: Sequence[str], metrics: Mapping[str, Column] | None = None, placed: bool = False
    ) -> tuple[DataFrame, list[tuple[dict, str]], dict]:
        """The rows as they lie in their new folders, the partitions these make, and what was counted on the way.

        Counting stands behind the last shuffle, so a repeated task counts once.
        """
        store, base = self.store, _base(table)
        # The batch is the upper folder level, so that a batch is one folder.
        folder = f"{store.root}/{table}/{BATCH}={self.batch}"
        seen = Observation()
        found = {"n": F.count(F.lit(1))} | dict(metrics or {})
        if base in DEALT:
            names = DEALT[base]
            dealt = rows if placed else rows.repartition(store.buckets, *names)
            dealt = dealt.withColumn(BUCKET, bucket_of(names, store.buckets))
            dealt = dealt.observe(seen, *[c.alias(k) for k, c in found.items()])
            # Files of buckets are written by way of a table; it goes, the files stay.
            clustered = ", ".join(f"`{k}`" for k in names)
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema.fields)
            way = f"way_{uuid.uuid4().hex[:12]}"
            store.run(
                f"CREATE TABLE {store.name(way)} ({columns}) USING {store.fmt} PARTITIONED BY (`{BUCKET}`) "
                f"CLUSTERED BY ({clustered}) SORTED BY ({clustered}) INTO {store.buckets} BUCKETS LOCATION '{folder}'"
            )
            dealt.write.insertInto(store.name(way))
            places = [({BUCKET: int(p.split("=")[1])}, f"{folder}/{p}") for p in store._partitions(way)]
            store.run(f"DROP TABLE {store.name(way)}")
            back = store.spark.read.schema(dealt.schema).format(store.fmt)
            return (back.load(folder) if places else store.spark.createDataFrame([], dealt.schema)), places, seen.get
        if keys:
            # Months (six digits or a word) and routes: plain folder names, and few of them in one run.
            found["places"] = F.collect_set(F.struct(*keys))
        watched = rows.observe(seen, *[c.alias(k) for k, c in found.items()])
        writer = watched.write.mode("errorifexists").format(store.fmt)
        (writer.partitionBy(*keys) if keys else writer).save(folder)
        back = store.spark.read.schema(rows.schema).format(store.fmt).load(folder)
        if not keys:
            return back, [({}, folder)], seen.get
        places = [row.asDict() for row in sorted(seen.get["places"])]
        return back, [(p, "/".join([folder, *(f"{k}={p[k]}" for k in keys)])) for p in places], seen.get

    def append(self, table: str, rows: DataFrame) -> DataFrame:
        """K1, K4, K5: add rows by name; returns them, as read back from the new files where they have files of their own.

        Columns that the table got by a migration and the rows do not have are NULL.
        """
        stored = self.store.read(table).schema
        extra = set(rows.columns) - set(stored.names)
        types = {f.name: f.dataType for f in stored}
        if extra or any(types[f.name] != f.dataType for f in rows.schema):
            raise LedgerMismatch(f"columns of {table} differ from the appended ones")
        missing = [f for f in stored if f.name not in rows.columns]
        added = self.store.added_columns(table) if missing else []
        required = [f.name for f in missing if f.name not in added]
        if required:
            raise LedgerMismatch(f"columns of {table} differ from the appended ones: {', '.join(required)}")
        if self.ended(table) and _base(table) not in DEALT:
            back = self.store.rows_with_places(table).filter(F.contains(BATCH, F.lit(self.mark))).drop(BATCH)
            self.written[table] = 0  # they are counted with the table
            return back
        full = rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}) if missing else rows
        full = full.select(*stored.names)
        if _base(table) in DEALT:
            return self._append_dealt(table, full)
        back, places, counted = self._write(table, full, self.store.keys(table))
        self.written[table] = counted["n"]
        self.added[table] = places if counted["n"] else []
        return back

    def _append_dealt(self, table: str, rows: DataFrame) -> DataFrame:
        """The touched buckets are written anew with their old and the new rows; returns the rows as given."""
        if self.ended(table):
            # Its rows are there: before this booking the table had fewer by them.
            self.counted[table] = self.store.rows(table) - rows.count()
            return rows
        old = self._look(table)
        both, before = rows, 0
        if old:
            touched = sorted(r[0] for r in rows.select(self.store.bucket(table)).distinct().collect())
            stays = self.store.rows_with_places(table).filter(F.col(BUCKET).isin(touched)).drop(BATCH, BUCKET)
            before = stays.count()
            both = stays.unionByName(rows)
        _, places, counted = self._write(table, both, (BUCKET,))
        self._turn(table, places, counted["n"], {p[BUCKET] for p, _ in places})
        self.replaced_rows[table] = before
        return rows

    def _turn(self, table: str, places: list[tuple[dict, str]], count: int, buckets: Iterable[int] | None) -> None:
        old = self._look(table)
        self.kept[table] = []
        if buckets is not None:
            levels = {f"{BUCKET}={b}" for b in buckets}
            self.kept[table] = [p for p in old if not levels & set(p.split("/"))]
        self.written[table], self.added[table] = count, places if count else []

    def replace(
        self,
        table: str,
        rows: DataFrame,
        expect_rows: int | None = None,
        buckets: Iterable[int] | None = None,
        placed: bool = False,
        as_given: bool = False,
    ) -> DataFrame:
        """K3, L1-L4: new rows of a table, or of some of its buckets; a wrong number of rows stops the run.

        ``placed`` says that the rows lie as the table's buckets do, as those of a join by its key.
        With ``as_given`` the table gets the columns of the rows, where they differ.
        """
        self._look(table)
        keys = self.store.keys(table) if self.store.has(table) else []
        back, places, counted = self._write(table, rows, keys, placed=placed)
        count = counted["n"]
        if expect_rows is not None and count != expect_rows:
            raise LedgerMismatch(f"{table}: {count} rows written, {expect_rows} expected")
        if buckets is not None:
            self.replaced_rows[table] = count if expect_rows is None else expect_rows
        self._turn(table, places, count, buckets)
        if as_given and rows.columns != self.store.read(table).columns:
            self.columns[table] = rows.columns
        return back.drop(BUCKET)

    def merge(self, table: str, paths: Sequence[str]) -> None:
        """M4: the rows of some partitions in one new partition for each of their keys."""
        old, keys = self._look(table), self.store.keys(table)
        chosen = {tuple(path.split("/")) for path in paths}
        wanted = " OR ".join("(" + " AND ".join(_level(level, "<=>") for level in path) + ")" for path in sorted(chosen))
        rows = self.store.rows_with_places(table).filter(wanted).drop(BATCH)
        expected = rows.count()
        _, places, counted = self._write(table, rows.hint("rebalance", *keys) if keys else rows.hint("rebalance"), keys)
        if counted["n"] != expected:
            raise LedgerMismatch(f"{table}: {counted['n']} rows written, {expected} expected")
        self._turn(table, places, counted["n"], None)
        self.kept[table] = [p for p in old if p not in set(paths)]
        self.replaced_rows[table] = expected

    def point(self, table: str, of: str) -> None:
        """Let ``table`` show only what this change appended to ``of``."""
        self._look(table)
        self.kept[table], self.added[table], self.written[table] = [], list(self.added[of]), self.written[of]

    def clear(self, table: str) -> None:
        self._look(table)
        self.kept[table], self.added[table], self.written[table] = [], [], 0

    def routed(
        self,
        accepted_table: str,
        rejected_table: str,
        rows: DataFrame,
        accepted_columns: Sequence[str],
        rejected_columns: Sequence[str],
    ) -> tuple[DataFrame, int, DataFrame, int]:
        """K3, K4: write both routes in one job and one pass over the join.

        The route is a folder level: the accepted table shows only this run's
        accepted folder, the rejected table gets this run's rejected folder
        added.  Returns both routes with all columns, and their numbers of rows;
        the tables show the named columns.  A repeated booking keeps the routes of
        its first attempt, for the master may hold its changes.
        """
        schema = rows.drop("route").schema
        for table, columns in ((accepted_table, accepted_columns), (rejected_table, rejected_columns)):
            if not self.store.has(table):
                self.store.create_table(table, StructType([schema[name] for name in columns]))
        routes = ("accepted", "rejected")
        before = f"{accepted_table}_routes"
        if self.store.has(before) and self.ended(before):
            mine = self.store.rows_with_places(before).filter(F.contains(BATCH, F.lit(self.mark))).drop(BATCH)
            counts = {r["route"]: r["count"] for r in mine.groupBy("route").count().collect()}
            back = mine.select(*rows.columns)
            folders = {}
            for path in self.store.paths(before):
                route, batch = path.split("/")
                if self.mark in batch:
                    folders[route.split("=")[1]] = f"{self.store.root}/{before}/{batch}/{route}"
        else:
            if not self.store.has(before):
                self.store.create_table(before, rows.schema, ["route"])
            metrics = {route: F.count_if(F.col("route") == route) for route in routes}
            back, places, counts = self._write(before, rows, ["route"], metrics)
            folders = {place["route"]: folder for place, folder in places}
            # Shown first: a later attempt finds the routes as soon as any other table may have changed.
            self.added = {before: places if counts["n"] else []} | self.added
        for table, route in ((accepted_table, "accepted"), (rejected_table, "rejected")):
            self.added[table] = [({}, folders[route])] if counts.get(route) else []
            self.written[table] = counts.get(route, 0)
        self._look(accepted_table)
        self.kept[accepted_table] = []

        def part(route: str) -> tuple[DataFrame, int]:
            return back.filter(F.col("route") == route).drop("route"), counts.get(route, 0)

        return *part("accepted"), *part("rejected")

    def count_before(self, table: str) -> int:
        """The rows that the table has, less those of an earlier attempt of this booking."""
        if table not in self.counted:
            rows = self.store.rows_with_places(table)
            if self.ended(table) and _base(table) not in DEALT:
                rows = rows.filter(~F.contains(BATCH, F.lit(self.mark)))
            self.counted[table] = rows.count()
        return self.counted[table]

    def count_after(self, table: str) -> int:
        """The rows that the table will have: those it keeps and those written."""
        if table in self.kept and table not in self.replaced_rows:
            return self.written[table]
        if self.ended(table):
            return self.store.rows(table)
        return self.count_before(table) - self.replaced_rows.get(table, 0) + self.written.get(table, 0)

    # ---- showing -----------------------------------------------------------------

    def commit(self) -> None:
        """Catalog statements only; before the first one, what is replaced must be as it was seen."""
        store = self.store
        for table, (below, old) in self.seen.items():
            if store.below(table) != below or store._partitions(below) != old:
                raise LedgerMismatch(f"{table} was changed by another run")
        for table, places in self.added.items():
            if self.ended(table):
                continue
            if table in self.kept:
                self._show(table, places)
            elif places:
                store.run(f"ALTER TABLE {store.name(store.below(table))} ADD {self._specs(places)}")
        for table in self.kept.keys() - self.added.keys():
            self._show(table, [])

    def _specs(self, places: Iterable[tuple[dict, str]]) -> str:
        return " ".join(
            "PARTITION ("
            + ", ".join(f"`{k}` = {_literal(v)}" for k, v in [*place.items(), (BATCH, self.batch)])
            + f") LOCATION '{folder}'"
            for place, folder in places
        )

    def _show(self, table: str, places: list[tuple[dict, str]]) -> None:
        """A table beside the present one with what stays and what is new; one statement turns the view."""
        store, (below, _) = self.store, self.seen[table]
        shown = store.rows_with_places(table).columns
        columns = self.columns.get(table)
        if columns:  # a migration came after the snapshot
            places_last = [c for c in shown if c in (BUCKET, BATCH)]
            fresh, shown = store.beside(table), [*columns, *places_last]
        else:
            fresh = store.beside(table)
        if places:
            store.run(f"ALTER TABLE {store.name(fresh)} ADD {self._specs(places)}")
        stays = [f"PARTITION ({_spec(path)}) LOCATION '{self._place(table, below, path)}'" for path in self.kept[table]]
        for start in range(0, len(stays), 500):
            store.run(f"ALTER TABLE {store.name(fresh)} ADD {' '.join(stays[start : start + 500])}")
        store.run(f"ALTER VIEW {store.name(table)} AS {store._selection(fresh, shown)}")
        store.run(f"DROP TABLE {store.name(below)}")

    def _place(self, table: str, below: str, path: str) -> str:
        """Where a partition lies; that of a bucket follows from its name."""
        if _base(table) in DEALT:
            bucket, batch = path.split("/")
            return f"{self.store.root}/{table}/{batch}/{bucket}"
        rows = self.store.run(f"DESCRIBE TABLE EXTENDED {self.store.name(below)} PARTITION ({_spec(path)})").collect()
        return next(r[1] for r in reversed(rows) if r[0] == "Location" and f"{BATCH}=" in r[1])


def _copy_name(table: str, tag: str) -> str:
    return f"{table}_on_{tag}"


def _base(table: str) -> str:
    """The ledger that a snapshot's table is a copy of, or the table itself."""
    return table.split("_on_")[0]


def _batch(path: str) -> str:
    return path.rsplit(f"{BATCH}=", 1)[1]


def _level(level: str, sign: str = "=") -> str:
    key, value = level.split("=", 1)
    return f"`{key}` {sign} {_literal(value)}"


def _spec(path: str) -> str:
    """A partition as SHOW PARTITIONS names it, for use in a statement."""
    return ", ".join(_level(level) for level in path.split("/"))


def add_column(rows: DataFrame, name: str, value, after: str) -> DataFrame:
    """M5: a constant column at a given place; any table, any name."""
    columns: list = []
    for existing in rows.columns:
        columns.append(F.col(existing))
        if existing == after:
            columns.append(F.lit(value).alias(name))
    if len(columns) == len(rows.columns):
        raise ValueError(f"no column {after}")
    return rows.select(*columns)
