"""One query per operator of the inventory, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardledger import functions as cf
from cardledger.operators import accounts, balances, control, decode, outputs, pivots, routing
from cardledger.operators.ledgers import LEDGERS, LedgerStore, add_column
from cardledger.plans import feeds
from cardledger.plans.feeds import KEYS, TABLES, TRANSACTION_PARTITIONS
from cardledger.plans.stand_ins import view
from cardledger.schemas import MOVEMENT_FIELDS, TRANSACTION
from cardledger.session import scratch_folder, tune
from cardledger.sources import lines as text
from cardledger.sources.listing import oldest_file
from cardledger.sources.listing import staged_file_name as file_of_staged
from cardledger.sources.staging import stage_if_new as fresh_rows

RUN_TS = "20240202101500"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(tune(spark), sf_dir)

    QUERIES[function.__name__] = run
    return function


# ---- sources ---------------------------------------------------------------


@query
def pending_files(spark, sf_dir):
    files = view(spark, sf_dir, "fx_feed").select("input_filename").distinct()
    return oldest_file(files, prefix_length=len("FEED_"), timestamp_length=1)


def _named_files(lines, folder: str) -> None:
    """Writes (value, file): one text file of that name each, a folder as partners fill it."""
    spark = lines.sparkSession
    parts = f"{folder}-parts"
    lines.repartition("file").write.partitionBy("file").text(parts)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path(folder))
    for level in files.listStatus(path(parts)):
        name = level.getPath().getName()
        if name.startswith("file="):
            part = next(f.getPath() for f in files.listStatus(level.getPath()) if f.getPath().getName().startswith("part-"))
            files.rename(part, path(f"{folder}/{name.removeprefix('file=')}"))


@query
def waiting_batch(spark, sf_dir):
    """Five files in a folder, two of them in the load log: what is staged of the others, and the log."""
    folder = scratch_folder(spark, "waiting")
    rows = view(spark, sf_dir, "fx_movement").filter(F.col("input_filename") < "FEED_5.csv")
    line = outputs.joined_fields([F.col(name) for name in MOVEMENT_FIELDS])
    _named_files(rows.select(line.alias("value"), F.col("input_filename").alias("file")), folder)
    store = _store(spark, "waiting-store")
    known = view(spark, sf_dir, "fx_loaded").select(
        F.lit("partner").alias("feed"), "input_filename", F.lit(None).cast("string").alias("internallog_ts"), F.lit(RUN_TS).alias("elaboration_ts")
    )
    _append(store, "loaded_files", known)
    feeds.read_waiting(store, "partner", folder, "FEED_", 1, RUN_TS)
    sides = [
        store.read(table).select(F.lit(table).alias("table_name"), *[c for c in columns if c in store.read(table).columns])
        for table, columns in (
            ("e_partner", ("transaction_id", "value", "input_filename", "input_filename_timestamp")),
            ("rejected_lines", ("line", "input_filename")),
            ("loaded_files", ("input_filename",)),
        )
    ]
    return sides[0].unionByName(sides[1], True).unionByName(sides[2], True)


@query
def delimited_scan(spark, sf_dir):
    folder = scratch_folder(spark, "delimited")
    feed = view(spark, sf_dir, "fx_movement")
    outputs.raw_lines(feed.select(*MOVEMENT_FIELDS)).write.text(folder)
    split = text.split_lines(text.scan_lines(spark, folder, latin1=False))
    rows = text.with_run_columns(text.well_formed(split), len("part-"), 5, RUN_TS)
    # The rejects with their reason beside the rows: every line of the file is in the result.
    # A part's name is Spark's own choice, so only its fixed beginning is compared.
    named = rows.withColumn("input_filename", F.substring("input_filename", 1, len("part-")))
    named = named.withColumn("input_filename_timestamp", F.length("input_filename_timestamp"))
    return named.unionByName(text.malformed(split).select("line", "reason"), allowMissingColumns=True)


@query
def fixed_width_scan(spark, sf_dir):
    folder = scratch_folder(spark, "fixed")
    latin1 = F.encode("line", "ISO-8859-1").cast("string").alias("value")
    view(spark, sf_dir, "fx_fixed").select(latin1).write.option("lineSep", "\r\n").text(folder)
    return text.single_backslashes(text.scan_lines(spark, folder)).select("line")


@query
def staged_file_name(spark, sf_dir):
    return file_of_staged(view(spark, sf_dir, "fx_feed"))


@query
def stage_if_new(spark, sf_dir):
    rows = fresh_rows(
        view(spark, sf_dir, "fx_movement"),
        view(spark, sf_dir, "fx_loaded_log"),
        ("input_filename", "internallog_ts"),
    )
    return rows.select("transaction_id", "input_filename", "internallog_ts", "value")


# ---- decoding --------------------------------------------------------------


@query
def decode_points(spark, sf_dir):
    lines = view(spark, sf_dir, "fx_points_line")
    rows = decode.with_header_value(decode.points_transactions(lines), decode.points_headers(lines), order="line_no")
    return decode.staged_points(rows, RUN_TS)


@query
def decode_point_totals(spark, sf_dir):
    totals = decode.points_account_totals(view(spark, sf_dir, "fx_points_line"))
    return totals.select(
        "input_filename",
        "product_company",
        "programme",
        "account_number",
        "effective_date",
        "expiry_date",
        "cycle_end_date",
        "award_cycle_date",
        "expiry_flag",
        "points",
    )


@query
def decode_enrolment(spark, sf_dir):
    lines = view(spark, sf_dir, "fx_enrolment_line")
    return decode.enrolment_details(lines, "line_no", batch_as="header_batch_id")


@query
def enrolment_counts(spark, sf_dir):
    return control.enrolment_counts(view(spark, sf_dir, "fx_enrolment_line"), "line_no")


@query
def decode_maintenance(spark, sf_dir):
    return decode.maintenance_details(view(spark, sf_dir, "fx_maintenance_line"))


# ---- scalar functions ------------------------------------------------------


@query
def overpunch_decode(spark, sf_dir):
    raw = F.col("raw")
    return view(spark, sf_dir, "fx_overpunch").select(
        "o_orderkey",
        cf.overpunch_sign(raw).alias("sign"),
        cf.overpunch_digits(raw).alias("digits"),
        cf.implied_points_text(raw).alias("points_text"),
        cf.implied_points(raw).alias("points"),
        cf.posted_amount(raw).alias("amount"),
    )


@query
def century_date(spark, sf_dir):
    century = cf.century_date(F.col("century_raw"))
    return view(spark, sf_dir, "fx_date").select(
        "o_orderkey",
        century.alias("century_text"),
        cf.typed_date(century).alias("century_day"),
        cf.day_first_date(F.col("day_first_raw")).alias("day_first_text"),
    )


@query
def currency_lookup(spark, sf_dir):
    return cf.with_currency(view(spark, sf_dir, "fx_currency"), "currency_number")


@query
def name_split(spark, sf_dir):
    full = F.col("full_name")
    return view(spark, sf_dir, "fx_contact").select(
        "c_custkey", cf.given_name(full).alias("customer_name"), cf.surname(full).alias("customer_surname")
    )


@query
def email_repair(spark, sf_dir):
    return view(spark, sf_dir, "fx_contact").select("c_custkey", cf.repaired_email(F.col("email_raw")).alias("email"))


@query
def transaction_key(spark, sf_dir):
    parts = [F.col("appcode"), F.col("transaction_id"), F.col("transaction_date")]
    return view(spark, sf_dir, "fx_feed").select(
        "transaction_id",
        cf.transaction_key(*parts, F.col("input_filename_timestamp")).alias("ledger_id"),
        cf.transaction_key(*parts).alias("movement_id"),
    )


@query
def partner_units(spark, sf_dir):
    rows = outputs.with_partner_units(view(spark, sf_dir, "fx_movement"))
    return rows.select("transaction_id", "transaction_type", "transaction_value", "value")


# ---- pivots ----------------------------------------------------------------


def _attributes(spark, sf_dir):
    return (
        view(spark, sf_dir, "fx_attribute")
        .withColumnRenamed("key_id", "key_of_function")
        .withColumn("issuer_batch_id", F.lit("20240101120000"))
    )


@query
def pivot_enrolment(spark, sf_dir):
    return pivots.pivot_enrolment(_attributes(spark, sf_dir), "line_no")


@query
def programme_events(spark, sf_dir):
    return pivots.programme_events(_attributes(spark, sf_dir), "line_no")


@query
def programme_errors(spark, sf_dir):
    return pivots.programme_errors(_attributes(spark, sf_dir)).select(
        "line_no", "function_id", "key_of_function", "value"
    )


def _maintenance(spark, sf_dir):
    return view(spark, sf_dir, "fx_eav").withColumnRenamed("alias", "alias_id")


@query
def pivot_maintenance(spark, sf_dir):
    return pivots.pivot_maintenance(_maintenance(spark, sf_dir), "line_no")


# ---- routing ---------------------------------------------------------------


@query
def route_points(spark, sf_dir):
    routed = routing.route_points(view(spark, sf_dir, "fx_feed"), view(spark, sf_dir, "fx_master"))
    return routed.select(
        "transaction_id", "product_company", "account_number", "master_customer_number", "route", "reason"
    )


@query
def route_maintenance(spark, sf_dir):
    pivoted = pivots.pivot_maintenance(_maintenance(spark, sf_dir), "line_no")
    staged = pivots.staged_maintenance(
        pivoted.withColumns(
            {"input_filename": F.lit("MAINT_20240105101112.txt"), "input_filename_timestamp": F.lit("20240105101112")}
        ),
        RUN_TS,
    )
    return routing.route_maintenance(staged, view(spark, sf_dir, "fx_anag")).drop(
        "keytype", "customer_status", "account_status", "internallog_ts"
    )


@query
def route_enrolment(spark, sf_dir):
    return routing.route_enrolment(view(spark, sf_dir, "fx_enrolled"), view(spark, sf_dir, "fx_master"))


def _saveback(spark, sf_dir):
    return routing.route_saveback(
        view(spark, sf_dir, "fx_feed"),
        view(spark, sf_dir, "fx_master"),
        view(spark, sf_dir, "fx_ledger"),
        mark_resent=True,
    )


@query
def route_saveback(spark, sf_dir):
    return _saveback(spark, sf_dir).select(
        "transaction_id", "product_company", "customer_number", "sent_before", "route", "reason"
    )


def _partner(spark, sf_dir):
    feed = view(spark, sf_dir, "fx_partner").withColumn("customer_number", F.col("account_number"))
    return routing.route_partner(feed.drop("account_number"), view(spark, sf_dir, "fx_master"))


@query
def partner_response(spark, sf_dir):
    return outputs.response_file(routing.partner_response(_partner(spark, sf_dir)))


@query
def response_file_name(spark, sf_dir):
    return view(spark, sf_dir, "fx_feed").select(
        outputs.response_file_name(F.col("input_filename")).alias("response_filename")
    ).distinct()


@query
def reject_union(spark, sf_dir):
    points = routing.route_points(view(spark, sf_dir, "fx_feed"), view(spark, sf_dir, "fx_master"))
    sides = {"points": points, "partner": _partner(spark, sf_dir), "saveback": _saveback(spark, sf_dir)}
    named = [
        rows.select(F.lit(feed).alias("feed"), "transaction_id", "route", "reason") for feed, rows in sides.items()
    ]
    return routing.reject_union(*named).drop("route")


@query
def distinct_rows(spark, sf_dir):
    return view(spark, sf_dir, "fx_transition").drop("line_no").distinct()


# ---- balances and ledgers --------------------------------------------------


@query
def signed_points(spark, sf_dir):
    return balances.signed_points(view(spark, sf_dir, "fx_feed"))


@query
def balance_delta(spark, sf_dir):
    return balances.balance_delta(view(spark, sf_dir, "fx_feed"), from_partner=True)


@query
def balance_update(spark, sf_dir):
    routed = routing.route_points(view(spark, sf_dir, "fx_feed").drop("customer_number"), view(spark, sf_dir, "fx_master"))
    moved = balances.movements(routing.accepted(routed))
    return balances.balance_update(view(spark, sf_dir, "fx_balance"), balances.balance_delta(moved))


@query
def card_actions(spark, sf_dir):
    acting = accounts.with_actions(view(spark, sf_dir, "fx_transition"))
    return accounts.in_action_file(acting).select(
        "account_number", "line_no", "action_rule", *accounts.ACTION_COLUMNS, "plastic_type"
    )


@query
def maintenance_actions(spark, sf_dir):
    pivoted = pivots.pivot_maintenance(_maintenance(spark, sf_dir), "line_no")
    staged = pivots.staged_maintenance(
        pivoted.withColumns({"input_filename": F.lit("M"), "input_filename_timestamp": F.lit("20240105101112")}), RUN_TS
    )
    routed = routing.accepted(routing.route_maintenance(staged, view(spark, sf_dir, "fx_anag")))
    return accounts.maintenance_actions(accounts.with_actions(routed.distinct()))


def _closing(spark, sf_dir):
    transitions = view(spark, sf_dir, "fx_transition").withColumn("product_company", F.lit(pivots.MAINTENANCE_COMPANY))
    keys = {"product_company": "product_company", "account_number": "account_number"}
    matched = routing.match_master(transitions, view(spark, sf_dir, "fx_master"), keys, ["customer_number"])
    known = matched.filter(F.col("account_number_an").isNotNull()).withColumn(
        "customer_number", F.col("customer_number_an")
    )
    return accounts.closing_customers(accounts.with_actions(known), "line_no")


@query
def balance_close(spark, sf_dir):
    return balances.balance_close(view(spark, sf_dir, "fx_balance"), _closing(spark, sf_dir))


@query
def balance_zero_all(spark, sf_dir):
    return balances.balance_zero_all(view(spark, sf_dir, "fx_balance"), "balance_extrabonus")


@query
def account_disable(spark, sf_dir):
    return accounts.account_disable(view(spark, sf_dir, "fx_anag"), _closing(spark, sf_dir)).select(
        "product_company",
        "customer_number",
        "account_number",
        "is_customer_number_active",
        "is_account_number_active",
        "customer_status",
        "account_status",
        "elaboration_ts",
    )


@query
def enrolment_actions(spark, sf_dir):
    return accounts.enrolment_actions(view(spark, sf_dir, "fx_anag"))


@query
def open_balances(spark, sf_dir):
    routed = routing.route_enrolment(view(spark, sf_dir, "fx_enrolled"), view(spark, sf_dir, "fx_master"))
    new = routing.accepted(routed).withColumn("customer_company", F.col("product_company"))
    return balances.open_balances(new, view(spark, sf_dir, "fx_balance"), RUN_TS)


def _ledger_rows(rows):
    return outputs.ledger_rows(balances.movements(rows)).withColumn(
        "transaction_month", outputs.transaction_month(F.col("transaction_date"))
    )


def _booked_history(spark, sf_dir):
    history = view(spark, sf_dir, "fx_movement").filter(F.col("transaction_id").cast("bigint") % 3 == 0)
    return _ledger_rows(history.drop("account_number"))


def _for_ledger(rows):
    return rows.hint("rebalance", *TRANSACTION_PARTITIONS)


def _accepted_points(spark, sf_dir):
    routed = routing.route_points(view(spark, sf_dir, "fx_movement"), view(spark, sf_dir, "fx_master"))
    return routing.accepted(routed).drop("account_number", "route", "reason")


def _store(spark, label: str, **more) -> LedgerStore:
    # As many buckets as joins have partitions, so that neither side of a join by key is dealt anew.
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return LedgerStore.create(spark, scratch_folder(spark, label), TABLES | more, partition_by=KEYS, buckets=buckets)


def _append(store, table, rows):
    change = store.begin(RUN_TS, f"append {table}")
    change.append(table, rows)
    change.commit()


def _appended_ledger(spark, sf_dir) -> LedgerStore:
    store = _store(spark, "append")
    for rows in (_booked_history(spark, sf_dir), _ledger_rows(_accepted_points(spark, sf_dir))):
        _append(store, "l_transaction", _for_ledger(rows))
    return store


@query
def ledger_append(spark, sf_dir):
    return _appended_ledger(spark, sf_dir).read("l_transaction").select(*TRANSACTION.names)


# ---- output lines and control ---------------------------------------------


@query
def partner_lines(spark, sf_dir):
    folder = scratch_folder(spark, "partner_lines")
    moved = balances.movements(view(spark, sf_dir, "fx_movement").drop("account_number"))
    outputs.write_document(outputs.transaction_file(moved), folder)
    return spark.read.text(folder).withColumnRenamed("value", "line")


@query
def points_reconcile(spark, sf_dir):
    return control.reconcile_points(view(spark, sf_dir, "fx_points_record"), "line_no")


@query
def feed_control(spark, sf_dir):
    feed = view(spark, sf_dir, "fx_movement")
    store = _store(spark, "control")
    _append(store, "l_transaction", _for_ledger(_booked_history(spark, sf_dir)))
    before = store.rows("l_transaction")
    change = store.begin(RUN_TS, "control")
    shown = [c for c in feed.columns if c != "account_number"]
    rows, _, rejects, _ = change.routed(
        "i_control", "i_control_rejected", routing.route_points(feed, view(spark, sf_dir, "fx_master")), shown, [*shown, "reason"]
    )
    # One join, written once; everything below reads the two routes.
    routed = rows.withColumn("route", F.lit(routing.ACCEPTED)).unionByName(rejects.withColumn("route", F.lit(routing.REJECTED)))
    moved = balances.movements(rows.drop("account_number", "reason"))
    change.append("l_transaction", _for_ledger(_ledger_rows(rows.drop("account_number", "reason"))))
    change.commit()
    other = pivots.wrong_company_lines(decode.maintenance_details(view(spark, sf_dir, "fx_maintenance_line")))

    def counted(rows, name):
        return rows.agg(F.count(F.lit(1)).alias(name))

    singles = [
        control.route_counts(routed),
        control.unbalanced_movements(balances.balance_delta(moved), view(spark, sf_dir, "fx_balance")),
        spark.range(1).select(F.lit(before).cast("bigint").alias("ledger_before")),
        counted(store.read("l_transaction"), "ledger_after"),
        counted(other, "maintenance_lines_of_other_company"),
        moved.agg(
            F.coalesce(F.sum(outputs.values_with_delimiter(outputs.transaction_file(moved))), F.lit(0)).alias(
                "delimiters_replaced"
            )
        ),
    ]
    rows = [one.unpivot([], one.columns, "measure", "n") for one in singles]
    result = rows[0]
    for more in rows[1:]:
        result = result.unionByName(more)
    return result


# ---- whole feeds -------------------------------------------------------------

# Files are folders of parts here; the four letters that all part names begin with stand for the timestamp.
FILE_TS = "part"


def _fed(spark, sf_dir, feed: str, lines, history=None, **write) -> LedgerStore:
    """A store with master and balances after a run of ``feed`` over the lines, written as a file first."""
    store = _store(spark, f"feed-{feed}")
    balance = (
        view(spark, sf_dir, "fx_balance")
        .withColumns({"customer_company": F.col("product_company"), "elaboration_ts": F.lit(RUN_TS)})
        .select(*TABLES["l_balance"].names)
    )
    change = store.begin(RUN_TS, "fill")
    change.append("l_anag", view(spark, sf_dir, "fx_anag"))
    change.append("l_balance", balance)
    if history is not None:
        change.append("l_transaction", _for_ledger(history))
    change.commit()
    folder = scratch_folder(spark, f"in-{feed}")
    lines.write.options(**write).text(folder)
    source = feeds.InputFile(folder, f"{feed}.txt", FILE_TS, 0)
    feeds.run(store, feed, source, scratch_folder(spark, f"out-{feed}"), RUN_TS)
    return store


FED_COLUMNS = (
    "product_company",
    "customer_number",
    "transaction_id",
    "transaction_date",
    "loyalty_program_cod",
    "transaction_value",
    "value",
    "balance_extrabonus",
    "balance_virtualcredit",
    "line",
    "reason",
)


ACCOUNT_COLUMNS = (
    "product_company",
    "customer_number",
    "account_number",
    "account_status",
    "balance_extrabonus",
    "balance_virtualcredit",
    "reason",
)


def _fed_rows(store: LedgerStore, feed: str, columns=FED_COLUMNS, ledger="l_transaction"):
    """What the run left: balances, ledger, both routes, rejected lines; and no staged rows."""
    sides = []
    for table in ("l_balance", ledger, f"i_{feed}", f"i_{feed}_rejected", "rejected_lines", f"e_{feed}"):
        rows = store.read(table)
        shown = [
            (F.col(c).cast("string") if c in rows.columns else F.lit(None).cast("string")).alias(c) for c in columns
        ]
        sides.append(rows.select(F.lit(table.replace(feed, "feed")).alias("table_name"), *shown))
    return reduce(DataFrame.unionByName, sides)


@query
def feed_points(spark, sf_dir):
    header = view(spark, sf_dir, "fx_points_line").filter("line_no = -1 AND input_filename = 'POINTS_0.txt'").select("line")
    lines = header.unionByName(view(spark, sf_dir, "fx_fixed").select("line"))
    latin1 = lines.select(F.encode("line", "ISO-8859-1").cast("string").alias("value"))
    return _fed_rows(_fed(spark, sf_dir, "points", latin1, lineSep="\r\n"), "points")


def _movement_lines(rows):
    return outputs.raw_lines(rows.select(*MOVEMENT_FIELDS))


@query
def feed_partner(spark, sf_dir):
    rows = view(spark, sf_dir, "fx_partner").withColumn("customer_number", F.col("account_number"))
    return _fed_rows(_fed(spark, sf_dir, "partner", _movement_lines(rows)), "partner")


@query
def feed_saveback(spark, sf_dir):
    rows = view(spark, sf_dir, "fx_movement")
    booked = rows.filter(F.col("transaction_id").cast("bigint") % 3 == 0).drop("account_number")
    history = _ledger_rows(booked.withColumn("input_filename_timestamp", F.lit(FILE_TS)))
    return _fed_rows(_fed(spark, sf_dir, "saveback", _movement_lines(rows), history), "saveback")


def _one_file(lines):
    """A partner's file is one file: attributes of an account are gathered within it."""
    return lines.repartition(1).sortWithinPartitions("line_no").select(F.encode("line", "ISO-8859-1").cast("string").alias("value"))


@query
def feed_enrolment(spark, sf_dir):
    lines = view(spark, sf_dir, "fx_enrolment_line").filter("input_filename <> 'ENROL_9.txt'")
    # One header: the others become lines that no account has.
    lines = lines.filter("line_no >= 0 OR input_filename = 'ENROL_0.txt'")
    store = _fed(spark, sf_dir, "enrolment", _one_file(lines), lineSep="\r\n")
    return _fed_rows(store, "enrolment", ACCOUNT_COLUMNS, "l_anag")


@query
def feed_maintenance(spark, sf_dir):
    store = _fed(spark, sf_dir, "maintenance", _one_file(view(spark, sf_dir, "fx_maintenance_line")))
    return _fed_rows(store, "maintenance", ACCOUNT_COLUMNS, "l_anag")


@query
def decoded_load(spark, sf_dir):
    store = _store(spark, "decoded")
    folder = scratch_folder(spark, "decoded-lines")
    rows = view(spark, sf_dir, "fx_movement").select(*TABLES["e_partner"].names)
    outputs.raw_lines(rows).write.text(folder)
    feeds.load_decoded(store, "partner", folder, RUN_TS)
    wrong = store.read("rejected_lines").select("line", "reason")
    return store.read("e_partner").unionByName(wrong, allowMissingColumns=True)


# ---- table maintenance -----------------------------------------------------


@query
def feed_reset(spark, sf_dir):
    store = _store(spark, "reset")
    staged = view(spark, sf_dir, "fx_movement").select(*TABLES["e_partner"].names)
    change = store.begin(RUN_TS, "read partner")
    change.append("p_partner", staged)
    change.point("e_partner", of="p_partner")
    change.commit()
    store.reset("e_partner", RUN_TS)
    sides = [store.read(t).select(F.lit(t).alias("table_name"), "*") for t in ("e_partner", "p_partner")]
    return sides[0].unionByName(sides[1])


def _filled_store(spark, sf_dir, label) -> LedgerStore:
    store = _store(spark, label)
    balance = (
        view(spark, sf_dir, "fx_balance")
        .withColumns({"customer_company": F.col("product_company"), "elaboration_ts": F.lit(RUN_TS)})
        .select(*TABLES["l_balance"].names)
    )
    change = store.begin(RUN_TS, "fill")
    change.append("l_anag", view(spark, sf_dir, "fx_anag"))
    change.append("l_balance", balance)
    movements = _ledger_rows(view(spark, sf_dir, "fx_movement").drop("account_number"))
    change.append("l_transaction", _for_ledger(movements))
    change.commit()
    return store


def _damaged(store: LedgerStore) -> None:
    """Real changes to all three ledgers: balances to 0, half of the master gone, a month's movements twice."""
    change = store.begin(RUN_TS, "damage")
    change.replace("l_balance", balances.balance_zero_all(store.read("l_balance"), "balance_extrabonus"))
    change.replace("l_anag", store.read("l_anag").filter(F.col("account_number").cast("bigint") % 2 == 0))
    change.append("l_transaction", store.read("l_transaction"))
    change.commit()


def _ledger_sides(store: LedgerStore, tag: str | None = None):
    """The three ledgers side by side, so that every row counts."""
    sides = [store.read(t, tag).select(F.lit(t).alias("table_name"), "*") for t in LEDGERS[:3]]
    shown = [
        side.select(
            "table_name",
            *[F.col(c).cast("string") for c in SNAPSHOT_COLUMNS if c in side.columns],
        )
        for side in sides
    ]
    return shown[0].unionByName(shown[1], True).unionByName(shown[2], True)


SNAPSHOT_COLUMNS = (
    "product_company",
    "customer_number",
    "account_number",
    "account_status",
    "balance_extrabonus",
    "balance_virtualcredit",
    "transaction_id",
    "transaction_date",
    "value",
)


@query
def ledger_snapshot(spark, sf_dir):
    store = _filled_store(spark, sf_dir, "snapshot")
    store.snapshot("20240202", RUN_TS)
    _damaged(store)
    return _ledger_sides(store, "20240202")


@query
def ledger_restore(spark, sf_dir):
    store = _filled_store(spark, sf_dir, "restore")
    store.snapshot("20240202", RUN_TS)
    _damaged(store)
    store.restore("20240202", RUN_TS)
    return _ledger_sides(store)


@query
def table_rewrite(spark, sf_dir):
    feed = view(spark, sf_dir, "fx_feed")
    store = _store(spark, "rewrite", p_feed=feed.schema)
    plus = F.col("sign") == "+"
    _append(store, "p_feed", feed.filter(plus))
    _append(store, "p_feed", feed.filter(~plus))
    store.rewrite(["p_feed"], RUN_TS)
    return store.read("p_feed")


@query
def table_column(spark, sf_dir):
    feed = view(spark, sf_dir, "fx_feed")
    store = _store(spark, "column", p_feed=feed.schema)
    _append(store, "p_feed", feed)
    store.migrate_column("p_feed", "transaction_value", 0, "transaction_date", RUN_TS)
    return store.read("p_feed")


QUERIES["add_column"] = lambda spark, sf_dir: add_column(
    view(tune(spark), sf_dir, "fx_feed"), "transaction_value", 0, "transaction_date"
)
