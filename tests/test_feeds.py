"""Five feeds end to end on generated files, and the ledger tables under failure."""

from __future__ import annotations

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cardledger.operators.ledgers import LEDGERS, LedgerMismatch, LedgerStore
from cardledger.plans import feeds
from cardledger.schemas import BALANCE, MASTER, STAGED_POINTS, TRANSACTION


def padded(*pieces):
    return "".join(str(value).ljust(width) for value, width in pieces)


def write(folder, name, lines, ending="\n", encoding="utf-8"):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "wb") as file:
        file.write(ending.join([*lines, ""]).encode(encoding))


def read_lines(folder):
    parts = sorted(p for p in os.listdir(folder) if p.startswith("part-"))
    return [line for p in parts for line in open(os.path.join(folder, p), encoding="utf-8").read().splitlines()]


def enrolment_lines(accounts, batch="20240101120000"):
    header = padded(("ISSUER001", 9), ("H", 1), ("SENDER", 9), (batch, 14), ("000000009", 9), ("", 34), ("S", 41))
    details = []
    for account, customer, name in accounts:
        attributes = {
            "X1142237": account,
            "X11422W0": customer,
            "X11422QZ": "18200",
            "X11422PC": "18200",
            "X1142239": name,
            "X1142247": "0700131",
            "X11422UW": "x§mail.it",
            "X1142244": "Citt\u00e0;alta",
        }
        for alias, value in attributes.items():
            details.append(
                padded((batch, 14), ("IBR", 11), ("REQCARD", 10), ("P", 1), (account, 23), ("A", 1), (alias, 8), (value, 132))
            )
    return [header, *details]


def points_lines(rows):
    lines = [padded(("06", 2), ("18200", 20), ("PGM01", 20), ("05012024", 8))]
    for account, reference, raw in rows:
        lines.append(
            padded(
                ("26", 2), ("18200", 20), ("PGM01", 20), (account, 23), (reference, 23), ("1240103", 7),
                ("00000000001234F", 15), ("GT", 2), ("978", 3), ("0" * 15, 15), (raw, 15), ("", 16), ("1240104", 7),
            )
        )
    return lines


def maintenance_lines(rows):
    return [
        padded(("18200", 5), ("A", 1), (account, 23), ("", 60), (alias, 8), (kind, 1), (old, 500), (new, 500))
        for account, alias, kind, old, new in rows
    ]


def clone(store, root):
    """A store with the same rows below another folder."""
    copy = feeds.create_store(store.spark, str(root), buckets=4)
    change = copy.begin("R", "clone")
    for table in feeds.TABLES:
        if store.paths(table):
            change.append(table, store.read(table))
    change.commit()
    return copy


@pytest.fixture(scope="module")
def prepared(spark, tmp_path_factory):
    """A store with three enrolled accounts of two customers; tests work on copies."""
    base = tmp_path_factory.mktemp("prepared")
    accounts = [("A1", "C1", "ANNA*ROSSI"), ("A2", "C1", "ANNA*ROSSI"), ("A3", "C2", "MARIO")]
    write(str(base / "in"), "ENR_20240101120000.txt", enrolment_lines(accounts), "\r\n", "latin-1")
    store = feeds.create_store(spark, str(base / "enrolled"), buckets=4)
    source = feeds.next_file(store, "enrolment", str(base / "in"), "ENR_", 14)
    return base, store, feeds.run(store, "enrolment", source, str(base / "out"), "20240102000000")


@pytest.fixture
def store(spark, tmp_path):
    return feeds.create_store(spark, str(tmp_path / "store"), buckets=4)


@pytest.fixture
def enrolled(prepared, tmp_path):
    return clone(prepared[1], tmp_path / "enrolled"), prepared[2]


def states(store):
    """What every table shows: nothing has changed while this is the same."""
    return {t: store.paths(t) for t in feeds.TABLES}


def balances_of(store):
    return {
        r["customer_number"]: (r["balance_extrabonus"], r["balance_virtualcredit"])
        for r in store.read("l_balance").collect()
    }


def test_enrolment(enrolled, spark, tmp_path):
    store, booking = enrolled
    assert booking.totals["rows_read"] == booking.totals["rows_accepted"] == booking.totals["ledger_added"] == 3
    assert booking.totals["ledger_agrees"] and booking.totals["delimiters_replaced"] == 3
    master = store.read("l_anag")
    assert master.schema.names == MASTER.names
    rows = {r["account_number"]: r for r in master.collect()}
    assert rows["A1"]["customer_surname"] == "ROSSI" and rows["A3"]["customer_name"] == "MARIO"
    assert rows["A1"]["email"] == "x@mail.it" and rows["A1"]["customer_city"] == "Citt\u00e0;alta"
    assert rows["A1"]["internallog_ts"] == rows["A1"]["input_filename_timestamp"] == "20240101120000"
    assert balances_of(store) == {"C1": (0, 0), "C2": (0, 0)}
    lines = read_lines(booking.documents[0])
    assert len(lines) == 3 and all(line.count(";") == 28 for line in lines)
    assert any("Citt\u00e0 alta" in line and "CAMS20240102000000" in line for line in lines)
    assert store.read("e_enrolment").isEmpty() and store.rows("p_enrolment") == 3


def test_the_same_file_or_batch_is_not_loaded_twice(enrolled, prepared, spark, tmp_path):
    store, _ = enrolled
    folder = str(prepared[0] / "in")
    assert feeds.next_file(store, "enrolment", folder, "ENR_", 14) is None
    before = states(store)
    known = feeds.InputFile(f"{folder}/ENR_20240101120000.txt", "ENR_20240101120000.txt", "20240101120000", 4)
    assert feeds.run(store, "enrolment", known, str(tmp_path / "out"), "20240103000000") is None
    assert states(store) == before
    # The same batch under another name is skipped and does not wait any longer.
    folder = str(tmp_path / "in")
    write(folder, "AGAIN_20240105120000.txt", enrolment_lines([("A7", "C7", "X")]), "\r\n", "latin-1")
    again = feeds.next_file(store, "enrolment", folder, "AGAIN_", 14)
    assert feeds.run(store, "enrolment", again, str(tmp_path / "out"), "20240103000000") is None
    assert feeds.next_file(store, "enrolment", folder, "AGAIN_", 14) is None
    assert store.rows("l_anag") == 3 and store.read("e_enrolment").isEmpty()


def test_enrolling_known_accounts_rejects_them(enrolled, spark, tmp_path):
    store, _ = enrolled
    folder = str(tmp_path / "in2")
    rows = [("A1", "C1", "X"), ("A2", "C9", "W"), ("A4", "C1", "Y"), ("A5", "C3", "Z")]
    write(folder, "ENR_2.txt", enrolment_lines(rows, "20240109000000"), "\r\n")
    booking = feeds.run(store, "enrolment", feeds.next_file(store, "enrolment", folder, "ENR_", 1), str(tmp_path / "out"), "20240110000000")
    assert (booking.totals["rows_accepted"], booking.totals["rows_rejected"]) == (2, 2)
    assert sorted(balances_of(store)) == ["C1", "C2", "C3"]
    # A2 of another customer is known too: an account of two customers would book a movement twice.
    rejects = sorted(tuple(r) for r in store.read("i_enrolment_rejected").select("account_number", "reason").collect())
    assert rejects == [("A1", "already in master"), ("A2", "already in master")]
    assert store.rows("l_anag") == 5


def test_a_file_without_header_stages_nothing(store, spark, tmp_path):
    write(str(tmp_path), "ENR_1.txt", enrolment_lines([("A1", "C1", "X")])[1:], "\r\n")
    assert not feeds.read_enrolment(store, feeds.next_file(store, "enrolment", str(tmp_path), "ENR_", 1), "R")
    assert store.rows("p_enrolment") == 0 and store.rows("loaded_files") == 1


def test_a_header_on_a_later_line_is_none(store, spark, tmp_path):
    lines = enrolment_lines([("A1", "C1", "X")])
    write(str(tmp_path), "ENR_1.txt", [lines[1], lines[0], *lines[2:]], "\r\n")
    assert not feeds.read_enrolment(store, feeds.next_file(store, "enrolment", str(tmp_path), "ENR_", 1), "R")


def test_a_file_that_repeats_an_account_enrols_none_of_its_rows(store, spark, tmp_path):
    twice = [("A1", "C1", "X"), ("A2", "C2", "Y")]
    header, *details = enrolment_lines(twice)
    # The second key names the account of the first one.
    details = [d.replace("X1142237A2", "X1142237A1") for d in details]
    write(str(tmp_path), "ENR_1.txt", [header, *details], "\r\n", "latin-1")
    source = feeds.next_file(store, "enrolment", str(tmp_path), "ENR_", 1)
    totals = feeds.run(store, "enrolment", source, str(tmp_path / "out"), "R").totals
    assert (totals["rows_accepted"], totals["rows_rejected"]) == (0, 2)
    assert {r["reason"] for r in store.read("i_enrolment_rejected").collect()} == {"repeated account"}


def test_a_master_with_an_account_twice_stops_the_run(enrolled, spark, tmp_path):
    store, _ = enrolled
    change = store.begin("R", "spoil")
    change.append("l_anag", store.read("l_anag").filter("account_number = 'A1'").withColumn("customer_number", F.lit("C2")))
    change.commit()
    write(str(tmp_path / "p"), "PTS_1.txt", points_lines([("A1", "R1", "00000000001000\u00e0")]), "\r\n", "latin-1")
    before = balances_of(store)
    with pytest.raises(LedgerMismatch, match="multiplied"):
        feeds.run(store, "points", feeds.next_file(store, "points", str(tmp_path / "p"), "PTS_", 1), str(tmp_path / "out"), "R")
    assert balances_of(store) == before and not os.path.exists(tmp_path / "out")


def test_points(enrolled, spark, tmp_path):
    store, _ = enrolled
    folder = str(tmp_path / "points")
    rows = [
        ("A1", "R1", "00000000001000\u00e0"),
        ("A2", "R2", "00000000000500J"),
        ("A3", "R3", "00000000070000\u00e0"),
        ("A9", "R4", "00000000000100\u00e0"),
        ("A1", "R5", "00000000000100?"),
    ]
    write(folder, "PTS_20240105.txt", [*points_lines(rows), "99 ignored"], "\r\n", "latin-1")
    source = feeds.next_file(store, "points", folder, "PTS_", 8)
    booking = feeds.run(store, "points", source, str(tmp_path / "out"), "20240106000000")
    totals = booking.totals
    assert (totals["rows_read"], totals["rows_accepted"], totals["rows_rejected"]) == (5, 3, 2)
    assert totals["ledger_agrees"] and totals["movements_without_balance"] == 0
    assert balances_of(store) == {"C1": (0, Decimal("50.000")), "C2": (0, Decimal("7000.000"))}
    ledger = store.read("l_transaction")
    assert ledger.schema.names == [*TRANSACTION.names, "transaction_month"]
    first = ledger.filter(F.col("transaction_id").contains("R1")).first()
    assert first["transaction_id"] == "CAMSR1GT_20240103_20240105"
    assert (first["customer_number"], first["transaction_value"], first["value"]) == ("C1", Decimal("123.46"), Decimal(100))
    assert (first["transaction_month"], first["internallog_ts"]) == ("202401", "202401050000000")
    lines = read_lines(booking.documents[0])
    assert len(lines) == 3 and all(line.count(";") == 12 for line in lines)
    reasons = {r["transaction_id"]: r["reason"] for r in store.read("i_points_rejected").collect()}
    assert reasons == {"R4GT": "unknown account", "R5GT": "bad amount"}
    assert store.read("i_points").count() == 3
    assert store.read("p_points").schema == STAGED_POINTS
    assert store.read("i_points").columns == STAGED_POINTS.names
    assert store.read("i_points_rejected").columns == [*STAGED_POINTS.names, "reason"]


def test_movements_without_balance_are_counted_and_booked(enrolled, spark, tmp_path):
    store, _ = enrolled
    change = store.begin("R", "lose a balance")
    change.replace("l_balance", store.read("l_balance").filter("customer_number = 'C2'"))
    change.commit()
    rows = [("A1", "R1", "00000000001000\u00e0"), ("A2", "R2", "00000000001000\u00e0"), ("A3", "R3", "00000000000100\u00e0")]
    write(str(tmp_path / "p"), "PTS_1.txt", points_lines(rows), "\r\n", "latin-1")
    source = feeds.next_file(store, "points", str(tmp_path / "p"), "PTS_", 1)
    totals = feeds.run(store, "points", source, str(tmp_path / "out"), "R").totals
    assert (totals["rows_accepted"], totals["movements_without_balance"], totals["customers_moved"]) == (3, 2, 2)
    assert store.rows("l_transaction") == 3 and balances_of(store) == {"C2": (0, Decimal("10.000"))}


def test_partner_movements_get_an_answer(enrolled, spark, tmp_path):
    store, _ = enrolled
    folder = str(tmp_path / "partner")
    name = "PRT_20240107_VERY_LONG_NAME_OF_A_FILE.csv"
    write(
        folder,
        name,
        [
            "CHP;18200;A1;T1;20240107;VC;+;EUR;12345;Bonus;BB;L1",
            "CHP;18200;A3;T2;20240107;E;-;EUR;3;Bonus;DA;L1",
            "XXX;18200;A9;T3;20240107;ZZ;+;EUR;3;Bonus;QQ;L1",
            "CHP;18200;A1;T5;20240107;VC;+;EUR;n/a;Bonus;BB;L1",
            "CHP;18200;A1;T4;20240107;VC;+;EUR;1;Bonus; with delimiter;BB;L1",
            "short;line",
            "no delimiter",
        ],
    )
    source = feeds.next_file(store, "partner", folder, "PRT_", 8)
    booking = feeds.run(store, "partner", source, str(tmp_path / "out"), "20240108000000")
    assert (booking.totals["rows_read"], booking.totals["rows_accepted"]) == (4, 2)
    assert balances_of(store) == {"C1": (0, Decimal("12.345")), "C2": (Decimal("-3.000"), 0)}
    response, document = booking.documents
    assert os.path.basename(response) == name[:30] + "_SIAResponse.csv"
    assert [tuple(line.split(";")[i] for i in (2, 3, 11, 12)) for line in read_lines(response)] == [
        ("A1", "T1", "20240107", "00"),
        ("A1", "T5", "20240107", "07"),
        ("A3", "T2", "20240107", "00"),
        ("A9", "T3", "20240107", "01"),
        ("A9", "T3", "20240107", "03"),
        ("A9", "T3", "20240107", "05"),
        ("A9", "T3", "20240107", "06"),
    ]
    assert sorted(tuple(line.split(";")[i] for i in (2, 5, 9)) for line in read_lines(document)) == [
        ("C1", "1234", "12"),
        ("C2", "300", "300"),
    ]
    assert {r["loyalty_program_cod"] for r in store.read("l_transaction").collect()} == {"0"}
    assert store.rows("rejected_lines") == 2


def test_saveback_repeats_are_rejected(enrolled, spark, tmp_path):
    store, _ = enrolled
    folder = str(tmp_path / "sb")
    line = "SB;18200;{};{};20240107;{};+;EUR;5;Back;WB;L1"
    write(folder, "SB_20240107.csv", [line.format("C1", "T1", "VC"), line.format("C9", "T2", "E")])
    first = feeds.run(store, "saveback", feeds.next_file(store, "saveback", folder, "SB_", 8), str(tmp_path), "20240108000000")
    assert (first.totals["rows_accepted"], first.totals["rows_rejected"]) == (1, 1)
    write(str(tmp_path / "sb2"), "SB_20240107_b.csv", [line.format("C1", "T1", "VC"), line.format("C1", "T3", "VC")])
    second = feeds.run(
        store, "saveback", feeds.next_file(store, "saveback", str(tmp_path / "sb2"), "SB_", 8), str(tmp_path), "20240109000000"
    )
    assert (second.totals["rows_accepted"], second.totals["rows_rejected"]) == (1, 1)
    assert balances_of(store)["C1"] == (0, Decimal("10.000"))
    booked = store.read("l_transaction").collect()
    assert sorted(r["transaction_id"] for r in booked) == ["SBT1_20240107_20240107", "SBT3_20240107_20240107"]
    assert {(r["loyalty_program_cod"], r["transaction_value"]) for r in booked} == {("", Decimal("0.00"))}


def test_maintenance_closes_a_customer(enrolled, spark, tmp_path):
    store, _ = enrolled
    change = store.begin("T", "seed")
    seeded = store.read("l_balance").withColumns(
        {"balance_extrabonus": F.lit(Decimal(9)).cast("decimal(18,3)"), "balance_virtualcredit": F.lit(None).cast("decimal(18,3)")}
    )
    change.replace("l_balance", seeded)
    change.commit()
    folder = str(tmp_path / "maint")
    rows = [
        ("A1", "X11422C2", "C", "AA", "KK"),
        ("A1", "X11422C2", "C", "AA", "GD"),
        ("A3", "X11422C2", "A", "", "AA"),
        ("A3", "X11422PG", "C", "1", "22"),
        ("A3", "X1142289", "C", "not", "kept"),
        ("A9", "X11422C2", "A", "AA", "CB"),
    ]
    write(folder, "MNT_20240110101112.txt", maintenance_lines(rows))
    source = feeds.next_file(store, "maintenance", folder, "MNT_", 14)
    booking = feeds.run(store, "maintenance", source, str(tmp_path / "out"), "20240111000000")
    assert (booking.totals["rows_read"], booking.totals["rows_accepted"], booking.totals["customers_closed"]) == (3, 2, 1)
    assert balances_of(store) == {"C1": (0, 0), "C2": (9, 0)}
    master = {r["account_number"]: r for r in store.read("l_anag").collect()}
    assert [master[a]["is_account_number_active"] for a in ("A1", "A2", "A3")] == [False, False, True]
    assert master["A2"]["account_status"] == "GD" and master["A2"]["elaboration_ts"] == "20240111000000"
    lines = sorted(line.split(";") for line in read_lines(booking.documents[0]))
    assert [(f[2], f[3], f[7], f[8], f[25], f[26], f[27]) for f in lines] == [
        ("C1", "", "OL", "ANNA", "D", "Z", "Z"),
        ("C2", "22", "OL", "MARIO", "I", "", ""),
    ]
    assert store.read("i_maintenance_rejected").first()["account_number"] == "A9"


def test_maintenance_without_closing_rewrites_nothing(enrolled, spark, tmp_path):
    store, _ = enrolled
    before = store.paths("l_balance"), store.paths("l_anag")
    write(str(tmp_path / "m"), "MNT_1.txt", maintenance_lines([("A3", "X11422C2", "A", "", "AA")]))
    feeds.run(store, "maintenance", feeds.next_file(store, "maintenance", str(tmp_path / "m"), "MNT_", 1), str(tmp_path / "out"), "R")
    assert (store.paths("l_balance"), store.paths("l_anag")) == before


def test_empty_files_and_empty_routes(enrolled, spark, tmp_path):
    store, _ = enrolled
    write(str(tmp_path / "e"), "MNT_1.txt", [])
    assert feeds.run(store, "maintenance", feeds.next_file(store, "maintenance", str(tmp_path / "e"), "MNT_", 1), str(tmp_path), "R") is None
    assert feeds.next_file(store, "points", str(tmp_path / "e"), "NONE_", 1) is None
    write(str(tmp_path / "e"), "PTS_1.txt", points_lines([("A9", "R1", "00000000000100\u00e0")]), "\r\n", "latin-1")
    before = store.paths("l_balance"), store.paths("l_transaction")
    booking = feeds.run(store, "points", feeds.next_file(store, "points", str(tmp_path / "e"), "PTS_", 1), str(tmp_path / "none"), "R")
    assert (booking.totals["rows_accepted"], booking.totals["rows_rejected"], booking.documents) == (0, 1, [])
    assert (store.paths("l_balance"), store.paths("l_transaction")) == before


def test_a_batch_is_booked_once(enrolled, spark, tmp_path):
    store, _ = enrolled
    write(str(tmp_path / "p"), "PTS_1.txt", points_lines([("A1", "R1", "00000000001000\u00e0")]), "\r\n", "latin-1")
    assert feeds.read_points(store, feeds.next_file(store, "points", str(tmp_path / "p"), "PTS_", 1), "R1")
    feeds.book_points(store, str(tmp_path / "out"), "R1")
    with pytest.raises(LedgerMismatch, match="booked already"):
        feeds.book_points(store, str(tmp_path / "out"), "R2")
    feeds.clear(store, "points", "R2")
    assert feeds.book_points(store, str(tmp_path / "out"), "R3") is None
    assert balances_of(store)["C1"] == (0, Decimal("100.000"))


def test_checks_of_waiting_files(store, spark, tmp_path):
    folder = str(tmp_path / "c")

    def found(feed, prefix, name, lines, encoding="latin-1"):
        write(folder, name, lines, "\r\n" if feed in ("enrolment", "points") else "\n", encoding)
        source = feeds.next_file(store, feed, folder, prefix, 1)
        return sorted(tuple(r) for r in feeds.check_file(store, feed, source).collect())

    details = enrolment_lines([("A1", "C1", "X")])
    assert found("enrolment", "ENR_", "ENR_1", details) == [("ENR_1", 9, 8, False)]
    total = padded(("18", 2), ("18200", 20), ("PGM01", 20), ("A1", 23), ("", 161), ("00000000000700\u00e0", 136))
    points = points_lines([("A1", "R1", "00000000001000\u00e0"), ("A2", "R2", "00000000000000\u00e0")])
    assert found("points", "PTS_", "PTS_1", [*points, total]) == [("PGM01", "A1", 70, 100, -30)]
    rows = maintenance_lines([("A1", "X", "C", "", "")] * 3)
    assert found("maintenance", "MNT_", "MNT_1", ["18210" + rows[0][5:], *rows]) == [("18210", 1)]
    assert found("partner", "PRT_", "PRT_1", ["a;b", "x"], "utf-8") == [("a;b", "field count")]
    assert not any(states(store).values())


def test_repeats_are_looked_for_in_the_months_of_the_feed(store, spark):
    change = store.begin("R", "fill")
    rows = [("x",) * 5 + (d, None) + ("x",) * 3 + (None,) + ("x",) * 6 + (d[:6],) for d in ("20240105", "20240205", "20240305")]
    change.append("l_transaction", spark.createDataFrame(rows, store.read("l_transaction").schema))
    change.commit()
    staged = spark.createDataFrame([("20240215",), ("bad",)], "transaction_date string")
    part = feeds._ledger_months(store, staged)
    assert [r["transaction_month"] for r in part.collect()] == ["202402"]


def test_lines_of_a_decoded_folder_are_rows_or_rejects(store, spark, tmp_path):
    good = ";".join(["x"] * 15)
    write(str(tmp_path / "d"), "part-0", [good, "a;b", "alone", good])
    assert feeds.load_decoded(store, "partner", str(tmp_path / "d"), "R") == 2
    assert sorted(r["line"] for r in store.read("rejected_lines").collect()) == ["a;b", "alone"]
    typed = ";".join(["x"] * 6 + ["no number"] + ["x"] * 10)
    write(str(tmp_path / "t"), "part-0", [typed, ";".join(["x"] * 6 + ["1.50"] + ["x"] * 10)])
    assert feeds.load_decoded(store, "points", str(tmp_path / "t"), "R") == 1
    assert "unreadable value" in {r["reason"] for r in store.read("rejected_lines").collect()}


def test_an_update_keeps_the_files_of_other_buckets(enrolled, spark, tmp_path):
    store, _ = enrolled
    rows = spark.createDataFrame(
        [("18200", "18200", f"D{i}", Decimal(0), Decimal(0), "T") for i in range(40)], BALANCE
    )
    change = store.begin("R", "more")
    change.append("l_balance", rows)
    change.commit()
    before = set(store.paths("l_balance"))
    write(str(tmp_path / "p"), "PTS_1.txt", points_lines([("A1", "R1", "00000000001000\u00e0")]), "\r\n", "latin-1")
    feeds.run(store, "points", feeds.next_file(store, "points", str(tmp_path / "p"), "PTS_", 1), str(tmp_path / "out"), "R")
    after = set(store.paths("l_balance"))
    touched = {p.split("/")[0] for p in before - after}
    assert len(touched) == 1 and {p.split("/")[0] for p in after - before} == touched
    assert balances_of(store)["C1"] == (0, Decimal("100.000")) and store.rows("l_balance") == 42


def test_a_batch_can_be_booked_again_after_a_restore(enrolled, spark, tmp_path):
    store, _ = enrolled
    folder = str(tmp_path / "p")
    for name, reference in (("PTS_1.txt", "R1"), ("PTS_2.txt", "R2")):
        lines = points_lines([("A1", reference, "00000000001000\u00e0")])
        # Each file has a day of its own in its header, for a repeated day is a repeated file.
        lines[0] = lines[0].replace("05012024", f"0{name[4]}012024")
        write(folder, name, lines, "\r\n", "latin-1")
        feeds.run(store, "points", feeds.next_file(store, "points", folder, "PTS_", 1), str(tmp_path / "out"), f"T{name[4]}")
        if name == "PTS_1.txt":
            store.snapshot("20240101", "R")
    assert balances_of(store)["C1"] == (0, Decimal("200.000"))
    store.restore("20240101", "R")
    assert balances_of(store)["C1"] == (0, Decimal("100.000")) and store.rows("l_transaction") == 1
    batches = {
        b: store.rows_with_places("p_points").filter(F.col("batch") == b).first()["input_filename"]
        for b in store.batches("p_points")
    }
    again = next(b for b, name in batches.items() if name == "PTS_2.txt")
    assert feeds.restage(store, "points", again, "T3") == 1
    feeds.book_points(store, str(tmp_path / "out"), "T3")
    assert balances_of(store)["C1"] == (0, Decimal("200.000")) and store.rows("l_transaction") == 2
    with pytest.raises(LedgerMismatch, match="booked already"):
        feeds.book_points(store, str(tmp_path / "out"), "T4")


# ---- store -------------------------------------------------------------------


def one_balance(spark, n):
    return spark.createDataFrame([("18200", "18200", "C1", Decimal(n), Decimal(n), "T")], BALANCE)


def test_nothing_is_visible_before_the_commit(store, spark):
    change = store.begin("R", "first try")
    change.append("l_balance", one_balance(spark, 1))
    assert store.read("l_balance").isEmpty() and store.rows("l_balance") == 0
    # The writer dies here; its files stay unseen and can be cleaned up.
    again = store.begin("R", "second try")
    again.append("l_balance", one_balance(spark, 2))
    again.commit()
    assert [r["balance_extrabonus"] for r in store.read("l_balance").collect()] == [2]
    assert store.expired_folders("l_balance") == [change.batch]


def test_two_writers_do_not_touch_each_other(enrolled, spark):
    store, _ = enrolled
    plus = lambda n: store.read("l_balance").withColumn("balance_extrabonus", F.lit(n).cast("decimal(18,3)"))
    first, second = store.begin("R", "first"), store.begin("R", "second")
    first.replace("l_balance", plus(1))
    second.replace("l_balance", plus(2))
    first.commit()
    with pytest.raises(LedgerMismatch, match="changed by another run"):
        second.commit()
    assert balances_of(store) == {"C1": (1, 0), "C2": (1, 0)}


class Died(Exception):
    pass


def dying_before(monkeypatch, number):
    """Every ``ALTER`` statement changes what readers may see; the run dies before the one of this number."""
    run, met = LedgerStore.run, []

    def watched(store, statement):
        if statement.startswith("ALTER"):
            met.append(statement)
            if len(met) == number:
                raise Died(statement)
        return run(store, statement)

    monkeypatch.setattr(LedgerStore, "run", watched)
    return met


def test_a_booking_may_die_anywhere_and_is_ended_by_its_repetition(prepared, spark, tmp_path, monkeypatch):
    rows = [("A1", "R1", "00000000001000\u00e0"), ("A9", "R2", "00000000001000\u00e0")]
    write(str(tmp_path / "p"), "PTS_1.txt", points_lines(rows), "\r\n", "latin-1")
    for number in range(1, 20):
        store = clone(prepared[1], tmp_path / f"s{number}")
        source = feeds.next_file(store, "points", str(tmp_path / "p"), "PTS_", 1)
        assert feeds.read_points(store, source, "R1")
        with monkeypatch.context() as patch:
            met = dying_before(patch, number)
            try:
                feeds.book_points(store, str(tmp_path / "out"), "R1")
            except Died:
                # Every customer once, with the old balance or the new one.
                shown = [tuple(r) for r in store.read("l_balance").select("customer_number", "balance_virtualcredit").collect()]
                assert sorted(shown) in ([("C1", 0), ("C2", 0)], [("C1", 100), ("C2", 0)])
                assert store.rows("l_transaction") <= 1 and store.rows("i_points") <= 1
        if len(met) >= number:
            if sorted(shown)[0][1]:
                with pytest.raises(LedgerMismatch, match="repeat it first"):
                    store.begin("R", "another", booking=True)
            totals = feeds.book_points(store, str(tmp_path / "out"), "R2").totals
            assert (totals["rows_accepted"], totals["rows_rejected"], totals["movements_without_balance"]) == (1, 1, 0)
        assert balances_of(store) == {"C1": (0, Decimal("100.000")), "C2": (0, 0)}
        assert (store.rows("l_transaction"), store.rows("i_points"), store.rows("i_points_rejected")) == (1, 1, 1)
        with pytest.raises(LedgerMismatch, match="booked already"):
            feeds.book_points(store, str(tmp_path / "out"), "R3")
        assert not store.unfinished()
        if len(met) < number:
            break
    assert 5 < number < 19


def test_an_enrolment_that_died_is_ended_by_its_repetition(store, spark, tmp_path, monkeypatch):
    write(str(tmp_path / "e"), "ENR_1.txt", enrolment_lines([("A1", "C1", "X"), ("A2", "C2", "Y")]), "\r\n", "latin-1")
    assert feeds.read_enrolment(store, feeds.next_file(store, "enrolment", str(tmp_path / "e"), "ENR_", 1), "R1")
    with monkeypatch.context() as patch:
        seen = dying_before(patch, 99)
        patch.setattr(LedgerStore, "run", _dying_at_view(LedgerStore.run, "l_balance"))
        with pytest.raises(Died):
            feeds.book_enrolment(store, str(tmp_path / "out"), "R1")
    assert seen and store.rows("l_anag") == 2 and store.rows("l_balance") == 0
    totals = feeds.book_enrolment(store, str(tmp_path / "out"), "R2").totals
    assert (totals["rows_accepted"], totals["rows_rejected"], totals["ledger_added"]) == (2, 0, 2)
    assert store.rows("l_anag") == 2 and sorted(balances_of(store)) == ["C1", "C2"]


def _dying_at_view(run, table):
    def watched(store, statement):
        if statement.startswith("ALTER VIEW") and f"`{table}` AS" in statement:
            raise Died(statement)
        return run(store, statement)

    return watched


def test_joins_by_the_key_of_a_stored_table_move_and_sort_the_feed_only(spark, tmp_path):
    from cardledger.operators import balances, routing

    store = feeds.create_store(spark, str(tmp_path / "b"), buckets=4)
    change = store.begin("R", "fill")
    change.append("l_balance", one_balance(spark, 1))
    names = {"product_company": "18200", "account_number": "A1", "customer_number": "C1"}
    master = spark.range(1).select(
        *[F.lit(names.get(f.name)).cast(f.dataType).alias(f.name) if f.name in names else F.lit(None).cast(f.dataType).alias(f.name) for f in MASTER]
    )
    change.append("l_anag", master)
    change.commit()
    columns = ("product_company", "account_number", "customer_number", "sign", "value", "transaction_type")
    feed = spark.createDataFrame([("18200", "A1", "C1", "+", "1", "VC")] * 3, list(columns))
    delta = balances.balance_delta(feed)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for frame, table in (
            (balances.balance_update(store.read("l_balance"), delta), "l_balance"),
            (routing.route_points(feed, store.read("l_anag"), stored=True), "l_anag"),
        ):
            frame.collect()
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert f"{table}__" in plan and _moved(plan, f"{table}__") == []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _moved(plan: str, table: str) -> list[str]:
    """Exchange and Sort nodes between a scan of ``table`` and the join above it, in the final plan."""
    lines = plan.split("== Initial Plan ==")[0].splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and table in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    found, level = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < level:
            level = depth(line)
            node = line.lstrip(" :+-*()0123456789")
            if "Join" in node:
                return found
            found += [node] if node.startswith(("Exchange", "Sort ")) else []
    return found


def test_a_feed_takes_few_jobs(spark):
    from cardledger.plans.catalogue import QUERIES

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.sparkContext.setJobGroup("feed", "feed")
    QUERIES["feed_points"](spark, "/root/testdata/sf0.001").collect()
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("feed"))
    spark.sparkContext.setJobGroup("", "")
    assert jobs <= 45 and spark.conf.get("spark.sql.shuffle.partitions") == before


def test_expired_files_go_and_shown_ones_stay(store, spark):
    for n in (1, 2, 3):
        change = store.begin(f"2024010{n}", "s")
        change.replace("l_balance", one_balance(spark, n))
        change.commit()
    assert len(store.expired_folders("l_balance")) == 2
    assert [b.split("-")[0] for b in store.expire("l_balance", "20240102")] == ["20240101"]
    assert [b.split("-")[0] for b in store.expire("l_balance", "20240109")] == ["20240102"]
    assert [r["balance_extrabonus"] for r in store.read("l_balance").collect()] == [3]


def test_a_rewrite_keeps_large_partitions_and_a_new_column_keeps_all_files(store, spark):
    def append(day):
        change = store.begin("R", "s")
        change.append("l_transaction", one_movement(spark, store, day))
        change.commit()

    for day in ("20240105", "20240106", "20240205"):
        append(day)
    before = set(store.paths("l_transaction"))
    store.rewrite(["l_transaction"], "R", small_bytes=1)
    assert set(store.paths("l_transaction")) == before
    store.rewrite(["l_transaction"], "R")
    after = set(store.paths("l_transaction"))
    assert len(after) == 2 and {p for p in before if "202402" in p} <= after and store.rows("l_transaction") == 3
    files = set(store.read("l_transaction").inputFiles())
    store.migrate_column("l_transaction", "note", "old", "value", "R")
    assert set(store.read("l_transaction").inputFiles()) == files
    assert {r["note"] for r in store.read("l_transaction").collect()} == {"old"}
    store.rewrite(["l_transaction"], "R", small_bytes=1 << 40)
    assert {r["note"] for r in store.read("l_transaction").collect()} == {"old"}


def test_a_wrong_row_count_commits_nothing(store, spark):
    change = store.begin("R", "s")
    with pytest.raises(LedgerMismatch, match="1 rows written, 7 expected"):
        change.replace("l_balance", one_balance(spark, 1), expect_rows=7)
    assert not any(states(store).values())


def test_appends_match_by_name_and_refuse_other_columns(store, spark):
    change = store.begin("R", "s")
    change.append("l_balance", one_balance(spark, 1))
    change.commit()
    change = store.begin("R", "s")
    change.append("l_balance", one_balance(spark, 2).select(*reversed(BALANCE.names)))
    change.commit()
    assert sorted(r["balance_extrabonus"] for r in store.read("l_balance").collect()) == [1, 2]
    assert store.read("l_balance").filter("customer_number = 'C1' and elaboration_ts = 'T'").count() == 2
    with pytest.raises(LedgerMismatch, match="differ"):
        store.begin("R", "s").append("l_balance", one_balance(spark, 1).drop("elaboration_ts"))


def test_restore_after_snapshot_is_the_identity(enrolled, spark):
    store, _ = enrolled
    with pytest.raises(LedgerMismatch, match="l_transaction"):
        store.snapshot("20240101", "R")
    assert not store.has("l_anag_on_20240101")
    change = store.begin("R", "fill")
    change.append("l_transaction", one_movement(spark, store, "20240105"))
    change.commit()
    before = {t: sorted(map(str, store.read(t).collect())) for t in LEDGERS}
    store.snapshot("20240101", "R")
    change = store.begin("R", "damage")
    for t in LEDGERS:
        change.clear(t)
    change.commit()
    assert all(store.read(t).isEmpty() for t in LEDGERS)
    store.restore("20240101", "R")
    assert {t: sorted(map(str, store.read(t).collect())) for t in LEDGERS} == before
    with pytest.raises(KeyError, match="no snapshot"):
        store.restore("19990101", "R")


def one_movement(spark, store, day):
    values = ("x",) * 5 + (day, None) + ("x",) * 3 + (None,) + ("x",) * 6 + (day[:6],)
    return spark.createDataFrame([values], feeds.TABLES["l_transaction"])


def test_rewrite_and_new_column(enrolled, spark):
    store, _ = enrolled
    before = sorted(map(str, store.read("l_anag").collect()))
    store.rewrite(["l_anag", "l_balance"], "R")
    assert sorted(map(str, store.read("l_anag").collect())) == before
    assert len(store.batches("l_anag")) == 1
    store.migrate_column("l_balance", "note", "n", "customer_number", "R")
    assert store.read("l_balance").columns[2:5] == ["customer_number", "note", "balance_extrabonus"]
    with pytest.raises(ValueError, match="no column"):
        store.migrate_column("l_balance", "x", 0, "missing", "R")


def test_a_partitioned_ledger_is_appended_after_rewrite_and_migration(store, spark):
    def append(day):
        change = store.begin("R", "s")
        change.append("l_transaction", one_movement(spark, store, day))
        change.commit()

    for day in ("20240105", "20240106", "20240205"):
        append(day)
    store.rewrite(["l_transaction"], "R")
    assert len(store.paths("l_transaction")) == 2
    append("20240107")
    store.migrate_column("l_transaction", "note", "old", "value", "R")
    append("20240301")
    notes = {r["transaction_date"]: r["note"] for r in store.read("l_transaction").collect()}
    assert notes == dict.fromkeys(("20240105", "20240106", "20240205", "20240107"), "old") | {"20240301": None}
    assert {p.split("/")[0] for p in store.paths("l_transaction")} == {
        "transaction_month=202401", "transaction_month=202402", "transaction_month=202403"
    }


def test_orc_stores_and_existing_stores(spark, tmp_path):
    store = feeds.create_store(spark, str(tmp_path / "orc"), "orc")
    change = store.begin("R", "s")
    change.append("l_balance", one_balance(spark, 1))
    change.commit()
    assert LedgerStore(spark, str(tmp_path / "orc"), "orc").read("l_balance").count() == 1
    with pytest.raises(Exception, match="(?i)exist"):
        feeds.create_store(spark, str(tmp_path / "orc"), "orc")
