"""The five feeds end to end: read a file, book it, clear the staged table.

Each stage is one function over a ``LedgerStore``.  ``read_*`` stages a file
that no earlier run loaded and returns whether there is something to book;
``book_*`` routes the staged rows, writes routes, files and ledgers, and
returns the control totals; ``clear`` empties the staged table.  Only control
rows (counts, one header, file names) reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cardledger.operators import accounts, balances, decode, outputs, pivots, routing
from cardledger.operators.control import enrolment_counts, ledger_check, reconcile_points
from cardledger.operators.ledgers import BATCH, BUCKET, BUCKETS, Change, LedgerMismatch, LedgerStore
from cardledger.schemas import (
    BALANCE,
    BOOKED_BATCHES,
    LOADED_FILES,
    MASTER,
    REJECTED_LINES,
    STAGED_ENROLMENT,
    STAGED_MAINTENANCE,
    STAGED_MOVEMENT,
    STAGED_POINTS,
    TRANSACTION,
    conform,
)
from cardledger.session import tune
from cardledger.sources import lines as text
from cardledger.sources.listing import name_timestamp, oldest_file, waiting_files
from cardledger.sources.staging import load_decoded_folder

TABLES = {
    "l_anag": MASTER,
    "l_balance": BALANCE,
    "l_transaction": StructType([*TRANSACTION.fields, StructField("transaction_month", StringType())]),
    "l_booked": BOOKED_BATCHES,
    "loaded_files": LOADED_FILES,
    "rejected_lines": REJECTED_LINES,
    **{f"{role}_enrolment": STAGED_ENROLMENT for role in "ep"},
    **{f"{role}_points": STAGED_POINTS for role in "ep"},
    **{f"{role}_maintenance": STAGED_MAINTENANCE for role in "ep"},
    **{f"{role}_{feed}": STAGED_MOVEMENT for role in "ep" for feed in ("partner", "saveback")},
}

# Nearly all rows belong to one product company, so the month alone is the level
# by which readers can skip files; a run appends to the few months of its feed.
TRANSACTION_PARTITIONS = ("transaction_month",)
KEYS = {"l_transaction": TRANSACTION_PARTITIONS}


@dataclass
class InputFile:
    """One waiting file and the timestamp in its name."""

    path: str
    name: str
    timestamp: str
    prefix_length: int


@dataclass
class Booking:
    """What a run did: control totals and the folders it wrote for delivery.

    Documents wait until the ledgers are committed; they are made from the written routes.
    """

    totals: dict = field(default_factory=dict)
    documents: list[str] = field(default_factory=list)
    waiting: list[Callable[[], None]] = field(default_factory=list)


def create_store(spark, root: str, fmt: str = "parquet", buckets: int = BUCKETS) -> LedgerStore:
    """An empty store; master and balances in so many buckets, at least as many as a join has partitions."""
    return LedgerStore.create(tune(spark), root, TABLES, fmt, KEYS, buckets)


def next_file(
    store: LedgerStore, feed: str, folder: str, prefix: str, timestamp_length: int
) -> InputFile | None:
    """The oldest file by name that the load log does not hold, None when none waits.

    Files stay where they are; the log takes the place of a folder for done files.
    """
    done = store.read("loaded_files").filter(F.col("feed") == feed).select("input_filename")
    waiting = waiting_files(store.spark, folder, prefix).join(done, "input_filename", "left_anti")
    found = oldest_file(waiting, len(prefix), timestamp_length).first()
    if found is None:
        return None
    return InputFile(found["path"], found["input_filename"], found["input_filename_timestamp"], len(prefix))


# ---- reading ---------------------------------------------------------------


def _loaded_before(store: LedgerStore, feed: str, column: str, value: str) -> bool:
    log = store.read("loaded_files")
    return not log.filter((F.col("feed") == feed) & (F.col(column) == value)).isEmpty()


def _one_row(change: Change, schema: StructType, *values) -> DataFrame:
    """A control row of constants."""
    columns = [F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(schema.fields, values, strict=True)]
    return change.store.spark.range(1, numPartitions=1).select(*columns)


def _log_load(change: Change, feed: str, source: InputFile, batch: str | None) -> None:
    change.append("loaded_files", _one_row(change, LOADED_FILES, feed, source.name, batch, change.run_ts))


def _skip(store: LedgerStore, feed: str, source: InputFile, run_ts: str) -> bool:
    """A file with nothing to stage, or a known batch under another name, is done all the same (Q14)."""
    change = store.begin(run_ts, f"skip {feed}")
    _log_load(change, feed, source, None)
    change.commit()
    return False


def _stage(
    store: LedgerStore,
    feed: str,
    source: InputFile,
    rows: DataFrame,
    run_ts: str,
    batch: str | None = None,
    bad_lines: DataFrame | None = None,
) -> bool:
    """K1, K2: one write serves history (``p_``) and the staged table (``e_``); an empty file stages nothing.

    The load log gets one row: file name and, for feeds that have one, the
    batch timestamp of the header.
    """
    change = store.begin(run_ts, f"read {feed}")
    change.append(f"p_{feed}", rows)
    change.point(f"e_{feed}", of=f"p_{feed}")
    found = change.count_after(f"e_{feed}") > 0
    if not found:
        change = store.begin(run_ts, f"read {feed}")
    _log_load(change, feed, source, batch if found else None)
    if bad_lines is not None:
        change.append(
            "rejected_lines",
            conform(bad_lines.withColumn("elaboration_ts", F.lit(run_ts)), REJECTED_LINES),
        )
    change.commit()
    return found


def _lines(store: LedgerStore, source: InputFile, latin1: bool) -> DataFrame:
    return text.scan_lines(store.spark, source.path, latin1).withColumn(
        "input_filename_timestamp",
        name_timestamp(F.col("input_filename"), source.prefix_length, len(source.timestamp)),
    )


def read_enrolment(store: LedgerStore, source: InputFile, run_ts: str) -> bool:
    """Enrolment file: header first, else nothing is staged; a known name or batch id is a repeated file (Q14)."""
    if _loaded_before(store, "enrolment", "input_filename", source.name):
        return False
    lines = text.single_backslashes(_lines(store, source, latin1=True))
    header = decode.enrolment_headers(lines).first()  # of the one file: its first line or nothing
    if header is None or _loaded_before(store, "enrolment", "internallog_ts", header["batch_id"]):
        return _skip(store, "enrolment", source, run_ts)
    pivoted = pivots.pivot_enrolment(decode.enrolment_details(lines))
    rows = pivoted.withColumns(
        {"input_filename_timestamp": F.lit(source.timestamp), "internallog_ts": F.lit(header["batch_id"])}
    )
    return _stage(store, "enrolment", source, pivots.staged_enrolment(rows, run_ts), run_ts, header["batch_id"])


def read_points(store: LedgerStore, source: InputFile, run_ts: str, causal: str = decode.POINTS_CAUSAL) -> bool:
    """Points file: transactions under the header's batch timestamp; empty when the file has no header."""
    if _loaded_before(store, "points", "input_filename", source.name):
        return False
    lines = text.single_backslashes(_lines(store, source, latin1=True))
    header = decode.first_headers(decode.points_headers(lines), "internallog_ts").first()
    batch = header["internallog_ts"] if header else ""
    if batch and _loaded_before(store, "points", "internallog_ts", batch):
        return _skip(store, "points", source, run_ts)
    rows = decode.points_transactions(lines).withColumn("internallog_ts", F.lit(batch))
    return _stage(store, "points", source, decode.staged_points(rows, run_ts, causal), run_ts, batch or None)


def read_maintenance(store: LedgerStore, source: InputFile, run_ts: str) -> bool:
    """Maintenance file; an empty one stages nothing (Q29)."""
    if _loaded_before(store, "maintenance", "input_filename", source.name):
        return False
    details = decode.maintenance_details(_lines(store, source, latin1=True))
    rows = pivots.pivot_maintenance(details).withColumn("input_filename_timestamp", F.lit(source.timestamp))
    return _stage(store, "maintenance", source, pivots.staged_maintenance(rows, run_ts), run_ts)


def _read_movements(store: LedgerStore, feed: str, source: InputFile, run_ts: str) -> bool:
    if _loaded_before(store, feed, "input_filename", source.name):
        return False
    split = text.split_lines(text.scan_lines(store.spark, source.path, latin1=False))
    rows = text.with_run_columns(
        text.well_formed(split), source.prefix_length, len(source.timestamp), run_ts
    )
    return _stage(store, feed, source, conform(rows, STAGED_MOVEMENT), run_ts, bad_lines=text.malformed(split))


def read_waiting(
    store: LedgerStore, feed: str, folder: str, prefix: str, timestamp_length: int, run_ts: str
) -> list[str]:
    """Every waiting file of a delimited feed, staged as one batch by one plan; returns the names.

    The load log is met by the listing, so no content of a known file is read.  Names reach
    the driver, since a scan is told its paths; each staged row keeps its file's name and
    timestamp, and the log gets a row per file.
    """
    if feed not in ("partner", "saveback"):
        raise ValueError(f"files of {feed} are read one by one")
    done = store.read("loaded_files").filter(F.col("feed") == feed).select("input_filename")
    waiting = waiting_files(store.spark, folder, prefix).join(done, "input_filename", "left_anti")
    found = waiting.select("input_filename", "path").orderBy("input_filename").collect()
    if not found:
        return []
    split = text.split_lines(text.scan_lines(store.spark, [r["path"] for r in found], latin1=False))
    rows = text.with_run_columns(text.well_formed(split), len(prefix), timestamp_length, run_ts)
    change = store.begin(run_ts, f"read {feed}")
    change.append(f"p_{feed}", conform(rows, STAGED_MOVEMENT))
    change.point(f"e_{feed}", of=f"p_{feed}")
    log = waiting.withColumns({"feed": F.lit(feed), "internallog_ts": F.lit(None).cast("string"), "elaboration_ts": F.lit(run_ts)})
    change.append("loaded_files", conform(log, LOADED_FILES))
    bad = text.malformed(split).withColumn("elaboration_ts", F.lit(run_ts))
    change.append("rejected_lines", conform(bad, REJECTED_LINES))
    change.commit()
    return [r["input_filename"] for r in found]


def read_partner(store: LedgerStore, source: InputFile, run_ts: str) -> bool:
    return _read_movements(store, "partner", source, run_ts)


def read_saveback(store: LedgerStore, source: InputFile, run_ts: str) -> bool:
    return _read_movements(store, "saveback", source, run_ts)


def check_file(store: LedgerStore, feed: str, source: InputFile) -> DataFrame:
    """What does not add up in a file, without staging it.

    Enrolment: stated against read lines.  Points: accounts whose stated total
    is not the sum of their transactions.  Maintenance: lines per foreign
    company.  The others: lines with a wrong field count.
    """
    lines = _lines(store, source, latin1=feed not in ("partner", "saveback"))
    if feed == "enrolment":
        lines = text.single_backslashes(lines)
        return enrolment_counts(lines)
    if feed == "points":
        lines = text.single_backslashes(lines)
        return reconcile_points(lines).filter(F.col("difference") != 0)
    if feed == "maintenance":
        foreign = pivots.wrong_company_lines(decode.maintenance_details(lines))
        return foreign.groupBy("key_company").agg(F.count(F.lit(1)).alias("lines"))
    return text.malformed(text.split_lines(lines)).select("line", "reason")


def load_decoded(store: LedgerStore, feed: str, path: str, run_ts: str) -> int:
    """A folder of already decoded lines becomes the staged table; returns its rows.

    Lines that are no row of the table go to ``rejected_lines`` with the reason.
    """
    change = store.begin(run_ts, f"load {feed}")
    rows, wrong = load_decoded_folder(store.spark, path, TABLES[f"e_{feed}"])
    change.replace(f"e_{feed}", rows)
    change.append("rejected_lines", conform(wrong.withColumn("elaboration_ts", F.lit(run_ts)), REJECTED_LINES))
    change.commit()
    return store.rows(f"e_{feed}")


def restage(store: LedgerStore, feed: str, batch: str, run_ts: str) -> int:
    """A batch of the history is staged again, for booking after a restore; returns its rows."""
    change = store.begin(run_ts, f"restage {feed}")
    change.batch = batch
    change.replace(f"e_{feed}", store.rows_with_places(f"p_{feed}").filter(F.col(BATCH) == batch).drop(BATCH))
    change.commit()
    return store.rows(f"e_{feed}")


# ---- booking ---------------------------------------------------------------


def _open_change(store: LedgerStore, feed: str, run_ts: str) -> Change | None:
    """A change for the staged batch; None when nothing is staged, an error when it was booked before."""
    batch = store.batches(f"e_{feed}")
    if not batch:
        return None
    source = f"book {feed} {batch[0]}"
    if store.booked(source):
        raise LedgerMismatch(f"the staged batch {batch[0]} is booked already")
    return store.begin(run_ts, source, booking=True)


def _document(booking: Booking, rows: DataFrame, folder: str, name: str, ordered: bool = False) -> None:
    path = f"{folder.rstrip('/')}/{name}"

    def write() -> None:
        if ordered:
            outputs.write_sorted_document(rows, path)
        else:
            booking.totals["delimiters_replaced"] = outputs.write_document(rows, path)
        booking.documents.append(path)

    booking.waiting.append(write)


def _touched(store: LedgerStore, table: str, rows: DataFrame) -> list[int]:
    """The buckets of a table that rows with its key fall into: at most as many numbers as it has buckets."""
    return sorted(r[BUCKET] for r in rows.select(store.bucket(table).alias(BUCKET)).distinct().collect())


def _rewritten(
    change: Change, table: str, buckets: list[int], update: Callable[[DataFrame], DataFrame], placed: bool = False
) -> None:
    """Rewrite the touched buckets of a table; all others keep their files."""
    old = change.store.rows_with_places(table).filter(F.col(BUCKET).isin(buckets)).drop(BATCH, BUCKET)
    change.replace(table, update(old), expect_rows=old.count(), buckets=buckets, placed=placed)


def _book_movements(
    change: Change, rows: DataFrame, booking: Booking, programme: str | None, from_partner: bool
) -> DataFrame:
    """Both balances in one new version, the movements appended to the ledger.

    Returns the movements in file and ledger units.
    """
    # One row per customer.  Once it is filled its true size is known, and a small
    # delta spares the balances a shuffle; a lost copy is computed again.
    delta = balances.balance_delta(rows, from_partner).persist()
    booking.totals["customers_moved"] = delta.count()
    matched = Observation()
    touched = _touched(change.store, "l_balance", delta)
    _rewritten(change, "l_balance", touched, lambda old: balances.balance_update(old, delta, matched), placed=True)
    delta.unpersist()
    booking.totals["movements_without_balance"] = booking.totals["rows_accepted"] - matched.get["movements"]
    booked = outputs.with_partner_units(rows) if from_partner else rows
    ledger = outputs.ledger_rows(booked, programme).withColumn(
        "transaction_month", outputs.transaction_month(F.col("transaction_date"))
    )
    # Rebalancing keeps files large and cuts a month that holds most rows.
    change.append("l_transaction", ledger.hint("rebalance", *TRANSACTION_PARTITIONS))
    return booked


def _finish(change: Change, booking: Booking, feed: str, ledger: str, read: int, added: int) -> Booking:
    booking.totals |= {"feed": feed, "rows_read": read}
    booking.totals |= ledger_check(change.count_before(ledger), added, change.count_after(ledger))
    if read != booking.totals["rows_accepted"] + booking.totals["rows_rejected"]:
        raise LedgerMismatch(f"{feed}: rows were lost or multiplied, is an account twice in the master? {booking.totals}")
    if not booking.totals["ledger_agrees"]:
        raise LedgerMismatch(f"{ledger}: {booking.totals}")
    change.append("l_booked", _one_row(change, BOOKED_BATCHES, feed, change.source, change.run_ts))
    change.commit()
    for write in booking.waiting:
        write()
    return booking


def _routed(change: Change, feed: str, routed: DataFrame, booking: Booking, extra: tuple[str, ...] = ()):
    """Both routes of a feed: ``i_`` has the staged columns, its rejects the reason besides."""
    staged = TABLES[f"e_{feed}"].names
    rows, n_rows, rejects, n_rejects = change.routed(
        f"i_{feed}", f"i_{feed}_rejected", routed, [*staged, *extra], [*staged, "reason"]
    )
    booking.totals |= {"rows_accepted": n_rows, "rows_rejected": n_rejects}
    return rows, n_rows, rejects


def book_points(store: LedgerStore, folder: str, run_ts: str, file_prefix: str = "TRANSACTION_") -> Booking | None:
    change = _open_change(store, "points", run_ts)
    if change is None:
        return None
    booking = Booking()
    staged = store.read("e_points")
    routed = routing.route_points(staged, store.read("l_anag"), stored=True)
    rows, accepted, _ = _routed(change, "points", routed, booking)
    if accepted:
        moved = balances.movements(rows)
        _book_movements(change, moved, booking, None, from_partner=False)
        document = outputs.transaction_file(moved)
        _document(booking, document, folder, outputs.run_file_name(file_prefix, run_ts))
    return _finish(change, booking, "points", "l_transaction", store.rows("e_points"), accepted)


def book_partner(store: LedgerStore, folder: str, run_ts: str, file_prefix: str = "TRANSACTION_") -> Booking | None:
    """Partner movements; the response file answers every row, accepted or not."""
    change = _open_change(store, "partner", run_ts)
    if change is None:
        return None
    booking = Booking()
    staged = store.read("e_partner")
    routed = routing.route_partner(staged, store.read("l_anag"), stored=True)
    rows, accepted, rejects = _routed(change, "partner", routed, booking)
    response = routing.partner_response(rows.unionByName(rejects))
    name = staged.agg(F.min(outputs.response_file_name(F.col("input_filename"))).alias("name")).first()["name"]
    _document(booking, outputs.response_file(response), folder, name, ordered=True)
    if accepted:
        moved = balances.movements(rows)
        booked = _book_movements(change, moved, booking, outputs.PARTNER_PROGRAMME, from_partner=True)
        document = outputs.transaction_file(booked)
        _document(booking, document, folder, outputs.run_file_name(file_prefix, run_ts))
    return _finish(change, booking, "partner", "l_transaction", store.rows("e_partner"), accepted)


def _ledger_months(store: LedgerStore, staged: DataFrame) -> DataFrame:
    """The part of the transaction ledger that can hold repeats of the staged rows.

    A repeat carries the same transaction date; the semi join lets Spark prune the
    ledger's month partitions by those of the feed.
    """
    month = outputs.transaction_month(F.col("transaction_date")).alias("transaction_month")
    return store.read("l_transaction").join(staged.select(month).distinct(), "transaction_month", "left_semi")


def book_saveback(store: LedgerStore, folder: str, run_ts: str) -> Booking | None:
    """Movements sent back by the loyalty partner; balances and ledger, no file."""
    change = _open_change(store, "saveback", run_ts)
    if change is None:
        return None
    booking = Booking()
    staged = store.read("e_saveback")
    routed = routing.route_saveback(staged, store.read("l_anag"), _ledger_months(store, staged))
    rows, accepted, _ = _routed(change, "saveback", routed, booking)
    if accepted:
        moved = balances.movements(rows)
        _book_movements(change, moved, booking, outputs.SAVEBACK_PROGRAMME, from_partner=False)
    return _finish(change, booking, "saveback", "l_transaction", store.rows("e_saveback"), accepted)


def book_enrolment(store: LedgerStore, folder: str, run_ts: str, file_prefix: str = "ACTION_") -> Booking | None:
    """New accounts: action file, a balance row per new customer, rows appended to the master."""
    change = _open_change(store, "enrolment", run_ts)
    if change is None:
        return None
    booking = Booking()
    staged = store.read("e_enrolment")
    routed = routing.route_enrolment(staged, store.read("l_anag"))
    rows, accepted, _ = _routed(change, "enrolment", routed, booking)
    added = 0
    if accepted:
        new = rows.select(*MASTER.names).distinct()
        registered = change.append("l_anag", new)
        added = new.count()
        opened = balances.open_balances(registered, store.read("l_balance"), run_ts)
        change.append("l_balance", conform(opened, BALANCE))
        document = accounts.enrolment_actions(registered)
        _document(booking, document, folder, outputs.run_file_name(file_prefix, run_ts))
    return _finish(change, booking, "enrolment", "l_anag", store.rows("e_enrolment"), added)


def book_maintenance(store: LedgerStore, folder: str, run_ts: str, file_prefix: str = "ACTION_") -> Booking | None:
    """Status changes: action file, and for closed cards balances to 0 and accounts off.

    Balances and master are rewritten only when a card closes.
    """
    change = _open_change(store, "maintenance", run_ts)
    if change is None:
        return None
    booking = Booking()
    staged = store.read("e_maintenance")
    routed = routing.route_maintenance(staged, store.read("l_anag"), stored=True)
    rows, accepted, _ = _routed(
        change, "maintenance", routed, booking, ("customer_name_an", "customer_surname_an", "taxid_number")
    )
    booking.totals["customers_closed"] = 0
    if accepted:
        acting = accounts.with_actions(rows.drop("reason").distinct()).persist()
        document = accounts.maintenance_actions(acting)
        _document(booking, document, folder, outputs.run_file_name(file_prefix, run_ts))
        closing = accounts.closing_customers(acting).persist()
        booking.totals["customers_closed"] = closing.count()
        if booking.totals["customers_closed"]:
            # Closing also turns every missing balance into 0 (Q20), so their buckets are touched too.
            missing = store.rows_with_places("l_balance").filter("balance_extrabonus IS NULL OR balance_virtualcredit IS NULL")
            without = {r[BUCKET] for r in missing.select(BUCKET).distinct().collect()}
            touched = sorted({*_touched(store, "l_balance", closing), *without})
            _rewritten(change, "l_balance", touched, lambda old: balances.balance_close(old, closing), placed=True)
            # The master lies by account: the buckets are those of the closing customers' accounts.
            theirs = store.rows_with_places("l_anag").join(closing.select(*accounts.CUSTOMER), accounts.CUSTOMER, "left_semi")
            buckets = sorted(r[BUCKET] for r in theirs.select(BUCKET).distinct().collect())
            _rewritten(change, "l_anag", buckets, lambda old: accounts.account_disable(old, closing))
        closing.unpersist()
        acting.unpersist()
    return _finish(change, booking, "maintenance", "l_anag", store.rows("e_maintenance"), 0)


def clear(store: LedgerStore, feed: str, run_ts: str) -> None:
    """The staged table is empty after a run; the loaded-file log keeps the file from coming back."""
    store.reset(f"e_{feed}", run_ts)


READ = {
    "enrolment": read_enrolment,
    "points": read_points,
    "maintenance": read_maintenance,
    "partner": read_partner,
    "saveback": read_saveback,
}
BOOK = {
    "enrolment": book_enrolment,
    "points": book_points,
    "maintenance": book_maintenance,
    "partner": book_partner,
    "saveback": book_saveback,
}


def run(store: LedgerStore, feed: str, source: InputFile | None, folder: str, run_ts: str) -> Booking | None:
    """All stages of a feed; None when there was nothing new to read."""
    if source is None or not READ[feed](store, source, run_ts):
        return None
    booking = BOOK[feed](store, folder, run_ts)
    clear(store, feed, run_ts)
    return booking
