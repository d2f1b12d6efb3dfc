"""Operators on small hand-made rows: routing, pivots, balances, actions, decisions on odd cases."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cardledger.operators import accounts, balances, control, decode, outputs, pivots, routing
from cardledger.schemas import BALANCE, ENROLMENT_ALIASES, MASTER, conform

MASTER_KEYS = "product_company string, customer_number string, account_number string, is_customer_number_active boolean"


@pytest.fixture
def master(spark):
    return spark.createDataFrame(
        [
            ("18200", "C1", "A1", True),
            ("18200", "C1", "A2", True),
            ("18200", "C2", "A3", False),
            ("18200", "C3", "A4", None),
        ],
        MASTER_KEYS,
    )


def feed(spark, rows):
    return spark.createDataFrame(
        rows, "transaction_id string, product_company string, account_number string, sign string, value string"
    )


def test_points_routes(spark, master):
    rows = feed(
        spark,
        [
            ("1", "18200", "A1", "+", "5"),
            ("2", "18200", "A9", "+", "5"),
            ("3", "18200", "A3", "+", "5"),
            ("4", "18200", "A4", "+", "5"),
            ("5", "18200", "A2", "+", "x"),
            ("6", "18210", "A1", "+", "5"),
            ("7", None, "A1", "+", "5"),
            ("8", "18200", "A1", None, "5"),
        ],
    )
    routed = routing.route_points(rows, master)
    assert {r["transaction_id"]: (r["route"], r["reason"], r["master_customer_number"]) for r in routed.collect()} == {
        "1": ("accepted", None, "C1"),
        "2": ("rejected", "unknown account", None),
        "3": ("rejected", "inactive", "C2"),
        "4": ("rejected", "unknown state", "C3"),
        "5": ("rejected", "bad amount", "C1"),
        "6": ("rejected", "unknown account", None),
        "7": ("rejected", "unknown account", None),
        "8": ("rejected", "bad amount", "C1"),
    }
    counts = control.route_counts(routed).first()
    assert (counts["rows_read"], counts["rows_accepted"], counts["rows_rejected"]) == (8, 1, 7)


def test_saveback_filters_the_ledger_by_the_feed_before_its_ids_are_shuffled(spark, master, tmp_path):
    company, customer = F.lit("18200").alias("product_company"), F.concat(F.lit("C"), F.col("id") % 3 + 1).alias("customer_number")
    booked = spark.range(20_000).select(company, customer, F.concat(F.lit("APP"), "id", F.lit("_D_T")).alias("transaction_id"))
    booked.write.parquet(str(tmp_path / "ledger"))
    rows = spark.range(19_950, 20_050).select(
        company,
        customer,
        F.lit("APP").alias("appcode"),
        F.col("id").cast("string").alias("transaction_id"),
        F.lit("D").alias("transaction_date"),
        F.lit("T").alias("input_filename_timestamp"),
        F.lit("+").alias("sign"),
        F.lit("5").alias("value"),
    )
    rows.write.parquet(str(tmp_path / "feed"))
    routed = routing.route_saveback(spark.read.parquet(str(tmp_path / "feed")), master, spark.read.parquet(str(tmp_path / "ledger")))
    assert routed.count() == 100
    assert routed.filter(F.col("reason") == routing.IN_LEDGER).count() == sum((i % 3 + 1) == 1 for i in range(19_950, 20_000))

    def nodes(plan):
        yield plan
        children = plan.children()
        for i in range(children.size()):
            yield from nodes(children.apply(i))

    planned = routed._jdf.queryExecution().sparkPlan()
    semi = [n for n in nodes(planned) if "Join" in n.nodeName() and "LeftSemi" in n.toString().splitlines()[0]]
    assert [n.nodeName() for n in semi] == ["BroadcastHashJoin"]


def test_saveback_gives_one_copy_per_movement_and_finds_repeats(spark, master):
    columns = (
        "appcode string, product_company string, customer_number string, transaction_id string, "
        "transaction_date string, input_filename_timestamp string, sign string, value string"
    )
    rows = spark.createDataFrame(
        [("SB", "18200", "C1", t, "20240101", "T2", "+", "1") for t in ("1", "2", "3")], columns
    )
    ledger = spark.createDataFrame(
        [
            ("18200", "C1", "SB1_20240101_T2", "T2"),
            ("18200", "C1", "SB2_20240101_T1", "T1"),
            ("18200", "C1", "SB2_20240101_T0", "T0"),
            ("18200", "C9", "SB3_20240101_T2", "T2"),
        ],
        "product_company string, customer_number string, transaction_id string, input_filename_timestamp string",
    )
    routed = routing.route_saveback(rows, master, ledger, mark_resent=True)
    assert "sent_before" not in routing.route_saveback(rows, master, ledger).columns
    assert sorted((r["transaction_id"], r["sent_before"], r["reason"]) for r in routed.collect()) == [
        ("1", True, "already in ledger"),
        ("2", True, None),
        ("3", False, None),
    ]


def test_a_customer_is_active_if_any_account_is(spark):
    rows = [("18200", "C1", "A1", False), ("18200", "C1", "A2", True), ("18200", "C2", "A3", None)]
    states = routing.customers_of(spark.createDataFrame(rows, MASTER_KEYS)).collect()
    assert {r["customer_number"]: r["is_customer_number_active"] for r in states} == {"C1": True, "C2": None}


def test_response_codes_add_up_and_nulls_breach_nothing(spark, master):
    columns = (
        "appcode string, product_company string, customer_number string, transaction_id string, "
        "transaction_type string, sign string, value string, causalcode string"
    )
    rows = spark.createDataFrame(
        [
            ("CHP", "18200", "A1", "ok", "VC", "+", "1", "BB"),
            ("XXX", "18200", "A1", "app", "ZZ", "+", "1", "QQ"),
            ("CHP", "18210", "A1", "company", "E", "+", "1", "DA"),
            (None, "18200", "A3", "nulls", None, "+", "1", None),
            ("CHP", "18200", "A4", "state", "VC", "+", "1", "BB"),
            ("CHP", "18200", "A2", "amount", "VC", "+", "?", "BB"),
        ],
        columns,
    )
    response = routing.partner_response(routing.route_partner(rows, master))
    found: dict[str, list] = {}
    for r in response.collect():
        found.setdefault(r["transaction_id"], []).append(r["response_code"])
        texts = routing.RESPONSE_TEXTS | {routing.BAD_AMOUNT_CODE: routing.BAD_AMOUNT_TEXT}
        assert r["response_text"] == texts[r["response_code"]]
    assert {k: sorted(v) for k, v in found.items()} == {
        "ok": ["00"],
        "app": ["00", "03", "05", "06"],
        "company": ["01", "04"],
        "nulls": ["02"],
        "state": ["02"],
        "amount": ["07"],
    }


def test_enrolment_routes_by_company_and_account(spark, master):
    rows = spark.createDataFrame(
        [
            ("18200", "C1", "A1"),
            ("18200", "C2", "A1"),
            ("18200", "C1", None),
            ("18200", "C1", None),
            ("18200", "C3", "N1"),
            ("18210", "C3", "N1"),
            ("18200", "C4", "N2"),
            ("18200", "C5", "N2"),
        ],
        "product_company string, customer_number string, account_number string",
    )
    twice = master.unionByName(master)
    found = routing.route_enrolment(rows, twice).collect()
    assert len(found) == 8
    assert {(r["product_company"], r["customer_number"], r["account_number"], r["reason"]) for r in found} == {
        ("18200", "C1", "A1", "already in master"),
        ("18200", "C2", "A1", "already in master"),
        ("18200", "C1", None, None),
        ("18200", "C3", "N1", None),
        ("18210", "C3", "N1", None),
        ("18200", "C4", "N2", "repeated account"),
        ("18200", "C5", "N2", "repeated account"),
    }


# ---- pivots ----------------------------------------------------------------


def brute_maintenance(lines):
    """Last line wins, line by line."""
    accounts_: dict[str, dict] = {}
    for _, key, alias, kind, old, new in sorted(lines):
        rule = pivots.MAINTENANCE_ALIASES.get(alias)
        if rule is None or (rule[1] is not None and rule[1] != kind):
            continue
        name, _, width, trimmed = rule
        old, new = (old or "")[:width], (new or "")[:width]
        if trimmed:
            old, new = old.strip(), new.strip()
        accounts_.setdefault(key, {})[name] = (old, new)
    return {
        key: {
            f"{name}_{side}": values.get(name, ("", ""))[i]
            for name, *_ in pivots.MAINTENANCE_ALIASES.values()
            for i, side in enumerate(("old", "new"))
        }
        for key, values in accounts_.items()
    }


def test_maintenance_pivot_against_brute_force(spark):
    rng = random.Random(7)
    aliases = [*pivots.MAINTENANCE_ALIASES, "X0000000"]
    lines = [
        (
            i,
            # One account owns a third of all lines.
            "HOT" if rng.random() < 0.34 else f"K{rng.randrange(40)}",
            rng.choice(aliases),
            rng.choice("CAD"),
            rng.choice(["AA", "", None, " x y ", "long value " * 4]),
            rng.choice(["KK", "", None, "  z", "another value " * 4]),
        )
        for i in range(1500)
    ]
    rng.shuffle(lines)
    frame = spark.createDataFrame(
        lines, "line_no bigint, key_id string, alias_id string, maint_type string, old_value string, new_value string"
    )
    found = {r["key_id"]: r.asDict() for r in pivots.pivot_maintenance(frame.repartition(5), "line_no").collect()}
    for row in found.values():
        row.pop("key_id")
    assert found == brute_maintenance(lines)


def test_enrolment_pivot_fills_the_staged_columns(spark):
    def line(order, alias, value, function="REQCARD", result="P"):
        return (order, "B1", function, result, "K1", "A", alias, value)

    lines = [
        line(1, "X1142237", "K1"),
        line(2, "X1142239", "ANNA*ROSSI"),
        line(3, "X1142239", "MARIA*BIANCHI"),
        line(4, "X1142247", "0700131"),
        line(5, "X11422UW", "m§x.it"),
        line(6, "X1142244", "Torino", result="N"),
        line(7, "X1142209", "??"),
        line(8, "X11422QZ", "18200", function="LOYADD"),
    ]
    frame = spark.createDataFrame(
        lines,
        "line_no bigint, issuer_batch_id string, function_id string, result string, key_of_function string, "
        "key_type string, alias_id string, value string",
    )
    wide = pivots.pivot_enrolment(frame, "line_no").withColumns(
        {c: F.lit(c) for c in ("input_filename", "input_filename_timestamp", "internallog_ts")}
    )
    staged = pivots.staged_enrolment(wide, "RUN")
    assert staged.columns == MASTER.names
    row = staged.first().asDict()
    expected = {name: "" for name in MASTER.names} | {
        "appcode": "CAMS",
        "account_number": "K1",
        "is_customer_number_active": True,
        "is_account_number_active": True,
        "customer_name": "MARIA",
        "customer_surname": "BIANCHI",
        "date_birth": "19700131",
        "email": "m@x.it",
        "elaboration_ts": "RUN",
        "input_filename": "input_filename",
        "input_filename_timestamp": "input_filename_timestamp",
        "internallog_ts": "internallog_ts",
    }
    assert row == expected
    assert len(ENROLMENT_ALIASES) == 21


def test_missing_birth_date_stays_visible(spark):
    frame = spark.createDataFrame(
        [(1, "B1", "REQCARD", "P", "K1", "A", "X1142237", "K1")],
        "line_no bigint, issuer_batch_id string, function_id string, result string, key_of_function string, "
        "key_type string, alias_id string, value string",
    )
    assert pivots.pivot_enrolment(frame, "line_no").first()["date_birth"] == "ER"


# ---- balances and accounts --------------------------------------------------


def balance_rows(spark, rows):
    return spark.createDataFrame(
        [("18200", "18200", c, None if e is None else Decimal(e), None if v is None else Decimal(v), "T0") for c, e, v in rows],
        BALANCE,
    )


def test_update_keeps_null_and_untouched_rows_and_loses_unknown_customers(spark):
    balance = balance_rows(spark, [("C1", 10, None), ("C2", 1, 2)])
    rows = spark.createDataFrame(
        [("18200", "C1", "E", "+", "5.5"), ("18200", "C1", "VC", "+", "7"), ("18200", "C9", "E", "+", "1")],
        "product_company string, customer_number string, transaction_type string, sign string, value string",
    )
    delta = balances.balance_delta(rows)
    assert control.unbalanced_movements(delta, balance).first()[0] == 1
    updated = balances.balance_update(balance, delta)
    assert updated.schema.simpleString() == balance.schema.simpleString()
    assert sorted((r[2], r[3], r[4], r[5]) for r in updated.collect()) == [
        ("C1", Decimal("15.500"), None, "T0"),
        ("C2", Decimal("1.000"), Decimal("2.000"), "T0"),
    ]


def test_summing_before_the_join_changes_nothing(spark, master):
    rng = random.Random(3)
    rows = spark.createDataFrame(
        [
            (
                str(i),
                "18200",
                "A1" if rng.random() < 0.4 else f"A{rng.randrange(1, 7)}",
                rng.choice("+-"),
                rng.choice(["1", "2.5", "oops", "40"]),
                rng.choice(["VC", "E", "ZZ"]),
            )
            for i in range(400)
        ],
        "transaction_id string, product_company string, account_number string, sign string, value string, "
        "transaction_type string",
    )
    accepted = routing.accepted(routing.route_points(rows, master)).withColumn(
        "customer_number", F.col("master_customer_number")
    )
    expected: dict[tuple, list] = {}
    for r in accepted.collect():
        sums = expected.setdefault((r["product_company"], r["customer_number"]), [Decimal(0), Decimal(0), 0])
        sums[2] += 1
        if r["transaction_type"] in ("VC", "E"):
            sums[("VC", "E").index(r["transaction_type"])] += Decimal(r["sign"] + r["value"])
    found = {tuple(r)[:2]: list(tuple(r)[2:]) for r in balances.balance_delta(accepted).collect()}
    assert found == expected


def transitions(spark, rows):
    return spark.createDataFrame(
        rows,
        "product_company string, customer_number string, plastic_status_old string, plastic_status_new string, "
        "elaboration_ts string",
    )


@pytest.mark.parametrize(
    ("old", "new", "rule", "actions", "plastic"),
    [
        ("AA", "KK", 1, ("I", "", "B"), "KK"),
        (None, "KK", 1, ("I", "", "B"), "KK"),
        ("AA", "GD", 2, ("D", "Z", "Z"), "OL"),
        ("KK", "CT", 2, ("D", "Z", "Z"), "KK"),
        ("ZZ", "CB", 2, ("D", "Z", "Z"), None),
        ("KK", "JD", 3, ("U", "", "B"), "KK"),
        ("AA", "DD", 3, ("U", "", "B"), "OL"),
        ("", "AA", 4, ("I", "", ""), "OL"),
        ("DD", "AA", 5, ("U", "", ""), "OL"),
    ],
)
def test_action_matrix(spark, old, new, rule, actions, plastic):
    row = accounts.with_actions(transitions(spark, [("18200", "C1", old, new, "T1")])).first()
    assert (row["action_rule"], tuple(row[c] for c in accounts.ACTION_COLUMNS), row["plastic_type"]) == (
        rule,
        actions,
        plastic,
    )


@pytest.mark.parametrize(("old", "new"), [("KK", "DD"), ("AA", "AA"), (None, "AA"), ("AA", "ZZ"), ("AA", None)])
def test_no_action(spark, old, new):
    assert accounts.with_actions(transitions(spark, [("18200", "C1", old, new, "T1")])).isEmpty()


def test_closing_is_one_action_per_customer_and_repeatable(spark):
    acting = accounts.with_actions(
        transitions(
            spark,
            [
                ("18200", "C1", "AA", "GD", "20240101000000"),
                ("18200", "C1", "ZZ", "CT", "20240102000000"),
                ("18200", "C1", "AA", "CB", "20240102000000"),
                ("18200", "C2", "AA", "KK", "20240103000000"),
            ],
        )
    )
    closing = accounts.closing_customers(acting)
    assert [tuple(r) for r in closing.collect()] == [("18200", "C1", "CB", "20240102000000")]
    balance = balance_rows(spark, [("C1", 5, 6), ("C2", 7, None)])
    closed = balances.balance_close(balance, closing)
    assert sorted((r[2], r[3], r[4]) for r in closed.collect()) == [
        ("C1", Decimal("0.000"), Decimal("0.000")),
        ("C2", Decimal("7.000"), Decimal("0.000")),
    ]
    people = spark.createDataFrame(
        [("18200", "C1", "A1", True, None), ("18200", "C1", "A2", True, True), ("18200", "C2", "A3", True, True)],
        MASTER_KEYS + ", is_account_number_active boolean",
    ).withColumns({c: F.lit("old") for c in ("customer_status", "account_status", "elaboration_ts")})
    once = accounts.account_disable(people, closing)
    assert sorted((r["account_number"], r["is_customer_number_active"], r["is_account_number_active"], r["customer_status"], r["elaboration_ts"]) for r in once.collect()) == [
        ("A1", False, False, "CB", "20240102000000"),
        ("A2", False, False, "CB", "20240102000000"),
        ("A3", True, True, "old", "old"),
    ]
    twice = accounts.account_disable(once, closing)
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_one_opening_balance_per_new_customer(spark):
    new = spark.createDataFrame(
        [("18200", "18200", "C1"), ("18200", "18200", "C1"), ("18200", "18200", "C2")],
        "customer_company string, product_company string, customer_number string",
    )
    opened = balances.open_balances(new, balance_rows(spark, [("C2", 1, 1)]), "RUN")
    assert [tuple(r) for r in opened.collect()] == [("18200", "18200", "C1", Decimal("0.000"), Decimal("0.000"), "RUN")]


# ---- control and shapes -----------------------------------------------------


def test_reconcile_shows_accounts_of_either_side(spark):
    stated = spark.createDataFrame([("P", "A1", 5), ("P", "A2", 3)], "programme string, account_number string, stated_total bigint")
    summed = spark.createDataFrame([("P", "A1", 4), ("P", "A3", 9)], "programme string, account_number string, summed_total bigint")
    result = control.points_reconcile(stated, summed, ["programme", "account_number"])
    assert sorted((r["account_number"], r["difference"]) for r in result.collect()) == [("A1", 1), ("A2", 3), ("A3", -9)]


def test_points_lines_reconcile_with_their_totals(spark):
    def total(account, raw):
        return "18" + "18200".ljust(20) + "PGM01".ljust(20) + account.ljust(23) + " " * 161 + raw.ljust(136)

    def transaction(account, raw):
        return "26" + "18200".ljust(20) + "PGM01".ljust(20) + account.ljust(23) + "R".ljust(23) + "1240101" + "0" * 14 + "àGT978" + "0" * 15 + raw + " " * 23

    lines = spark.createDataFrame(
        [
            (1, total("A1", "00000000000100à")),
            (2, transaction("A1", "00000000000700à")),
            (3, transaction("A1", "00000000000500N")),
            (4, transaction("A1", "00000000000500?")),
            (5, total("A1", "00000000000200à")),
            (6, "99 other"),
        ],
        "line_order bigint, line string",
    )
    stated = control.stated_totals(decode.points_account_totals(lines))
    summed = control.summed_points(decode.points_transactions(lines))
    row = control.points_reconcile(stated, summed, ["programme", "account_number"]).first()
    assert row[:] == ("PGM01", "A1", 20, 20, 0)


def test_conform_rejects_missing_and_mistyped_columns(spark):
    with pytest.raises(ValueError, match="balance_extrabonus: missing"):
        conform(spark.createDataFrame([("x",)], "customer_company string"), BALANCE)
    with pytest.raises(ValueError, match="instead of decimal"):
        conform(balance_rows(spark, [("C1", 1, 1)]).withColumn("balance_extrabonus", F.lit(0)), BALANCE)


def test_undated_rows_share_a_partition(spark):
    frame = spark.createDataFrame([("20240131",), ("ER0101",), (None,), ("20240230",)], "d string")
    months = [r[0] for r in frame.select(outputs.transaction_month(F.col("d"))).collect()]
    assert months == ["202401", "undated", "undated", "undated"]


# ---- skew --------------------------------------------------------------------


def test_a_hot_account_is_split_and_no_row_is_lost(spark):
    """Half of the feed belongs to one account."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        n = 40_000
        account = F.when(F.col("id") % 2 == 0, F.lit("A0")).otherwise(F.concat(F.lit("A"), F.col("id").cast("string")))
        rows = spark.range(0, n, 1, 16).select(
            F.lit("18200").alias("product_company"),
            account.alias("account_number"),
            (F.col("id") % 3).cast("string").alias("transaction_id"),
            F.lit("+").alias("sign"),
            F.pmod(F.xxhash64("id"), F.lit(10**9)).cast("string").alias("value"),
            F.lit("VC").alias("transaction_type"),
        )
        people = spark.range(0, n, 1, 4).select(
            F.lit("18200").alias("product_company"),
            F.concat(F.lit("C"), (F.col("id") % 100).cast("string")).alias("customer_number"),
            F.concat(F.lit("A"), F.col("id").cast("string")).alias("account_number"),
            (F.col("id") % 5 != 1).alias("is_customer_number_active"),
        )
        routed = routing.route_points(rows, people)
        counts = {r["route"]: r["count"] for r in routed.groupBy("route").count().collect()}
        assert counts == {"accepted": n - n // 10, "rejected": n // 10}
        routed.collect()
        plan = routed._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
        # A sum per customer follows the join, as in a run; the cut stays.
        moved = routing.accepted(routed).withColumn("customer_number", F.col("master_customer_number"))
        delta = balances.balance_delta(moved)
        total = sum(r["delta_virtualcredit"] for r in delta.collect())
        assert total == moved.agg(F.sum(F.col("value").cast("decimal(18,3)"))).first()[0]
        assert "skew=true" in delta._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
