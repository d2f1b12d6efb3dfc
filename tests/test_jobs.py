"""The command line on a small points run."""

from __future__ import annotations

import os

from cardledger import jobs
from cardledger.operators.ledgers import LedgerStore
from tests.test_feeds import enrolment_lines, points_lines, write


def test_stages_and_maintenance(spark, tmp_path):
    store, out = str(tmp_path / "store"), str(tmp_path / "out")
    common = ["--store", store, "--run-ts", "20240201000000"]
    jobs.main(["create", *common])
    write(str(tmp_path / "in"), "ENR_1.txt", enrolment_lines([("A1", "C1", "X")]), "\r\n", "latin-1")
    write(str(tmp_path / "in"), "PTS_1.txt", points_lines([("A1", "R1", "00000000001000à")]), "\r\n", "latin-1")
    where = ["--folder", str(tmp_path / "in"), "--timestamp-length", "1", "--out", out]
    assert jobs.main(["feed", "enrolment", *common, *where, "--prefix", "ENR_"])["rows_accepted"] == 1
    checked = jobs.main(["check", "points", *common, *where, "--prefix", "PTS_"])
    assert checked["input_filename"] == "PTS_1.txt" and os.path.isdir(checked["documents"][0])
    assert jobs.main(["feed", "points", *common, *where, "--prefix", "PTS_", "--stage", "read"])["staged"]
    booked = jobs.main(["feed", "points", *common, "--out", out, "--stage", "book-and-clear"])
    assert booked["ledger_agrees"] and len(booked["documents"]) == 1
    assert os.path.isdir(booked["documents"][0])
    assert "ledger_agrees" not in jobs.main(["feed", "points", *common, "--out", out, "--stage", "book"])
    jobs.main(["snapshot", "S1", *common])
    jobs.main(["add-column", "l_balance", "note", "n", "customer_number", *common])
    jobs.main(["restore", "S1", *common])
    jobs.main(["rewrite", "l_anag", "l_transaction", *common])
    ledgers = LedgerStore(spark, store)
    assert "note" not in ledgers.read("l_balance").columns
    assert ledgers.read("l_transaction").count() == 1
    os.makedirs(tmp_path / "decoded")
    row = ["CHP", "18200", "A1", "T", "20240101", "VC", "+", "EUR", "1", "c", "BB", "f", "t", "e", "i"]
    (tmp_path / "decoded" / "part-0").write_text(";".join(row) + "\n")
    assert jobs.main(["load-decoded", "partner", str(tmp_path / "decoded"), *common])["rows"] == 1
