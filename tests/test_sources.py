"""Text sources: encodings, line ends, line order over splits, malformed lines, listings, staging."""

from __future__ import annotations

import os

import pytest

from cardledger.operators import decode, pivots
from cardledger.schemas import MOVEMENT_FIELDS, STAGED_POINTS
from cardledger.session import scratch_folder
from cardledger.sources import lines as text
from cardledger.sources.listing import oldest_file, staged_file_name, waiting_files
from cardledger.sources.staging import load_decoded_folder, stage_if_new


def put(folder, name, content: bytes):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "wb") as file:
        file.write(content)


def test_latin1_crlf_and_backslashes(spark, tmp_path):
    put(tmp_path, "F_1.txt", "26\u00e0B\r\nx\\\\y\\z\r\n".encode("latin-1"))
    found = text.single_backslashes(text.scan_lines(spark, str(tmp_path))).select("line", "input_filename").collect()
    assert sorted(map(tuple, found)) == [("26\u00e0B", "F_1.txt"), ("x\\y\\z", "F_1.txt")]


def test_last_line_wins_across_splits_of_several_files(spark, tmp_path):
    """Small splits of unequal files are packed into tasks by size; the line order must not mind."""
    for number, count in enumerate((4000, 900, 2500)):
        rows = [
            "18200A" + f"K{i % 7}".ljust(23) + " " * 60 + "X11422C2" + "C" + f"{i % 90:02d}".ljust(20)
            for i in range(count)
        ]
        body = [row[:118].ljust(598) + f"{i % 97:02d}" for i, row in enumerate(rows)]
        put(tmp_path, f"M_{number}.txt", ("\n".join(body) + "\n").encode())
    settings = {"spark.sql.files.maxPartitionBytes": "150000", "spark.sql.files.openCostInBytes": "1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        lines = text.scan_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 5
        found = pivots.pivot_maintenance(decode.maintenance_details(lines)).collect()
    finally:
        for key in settings:
            spark.conf.unset(key)
    expected = {}
    for number, count in enumerate((4000, 900, 2500)):
        for i in range(count):
            expected[f"M_{number}.txt", f"K{i % 7}"] = (f"{i % 90:02d}", f"{i % 97:02d}")
    assert {
        (r["input_filename"], r["key_id"]): (r["plastic_status_old"], r["plastic_status_new"]) for r in found
    } == expected


def test_delimited_lines(spark, tmp_path):
    good = ";".join(f"f{i}" for i in range(12))
    content = f'{good}\n"{good}"\n{good};extra\na;b\nsingle\n\n;;;;;;;;;;;\n'
    put(tmp_path, "F_20240101.csv", content.encode())
    split = text.split_lines(text.scan_lines(spark, str(tmp_path), latin1=False))
    rows = text.with_run_columns(text.well_formed(split), 2, 8, "RUN").collect()
    assert sorted(r["appcode"] for r in rows) == ["", '"f0', "f0"]
    assert {r["input_filename_timestamp"] for r in rows} == {"20240101"}
    assert rows[0].asDict().keys() >= set(MOVEMENT_FIELDS)
    assert list(rows[0].asDict())[10:] == ["causalcode", "input_filename", "input_filename_timestamp", "elaboration_ts", "internallog_ts"]
    assert sorted(r["line"] for r in text.malformed(split).collect()) == ["a;b", good + ";extra"]


def test_waiting_files_by_prefix(spark, tmp_path):
    for name in ("PRE_20240102.txt", "PRE_20240101.txt", "OTHER_1.txt"):
        put(tmp_path, name, b"x")
    files = waiting_files(spark, str(tmp_path), "PRE_")
    assert sorted(r["input_filename"] for r in files.collect()) == ["PRE_20240101.txt", "PRE_20240102.txt"]
    row = oldest_file(files, 4, 8).first()
    assert (row["input_filename"], row["input_filename_timestamp"]) == ("PRE_20240101.txt", "20240101")


def test_staged_file_name_of_nothing_is_nothing(spark):
    frame = spark.createDataFrame([("b",), ("a",)], "input_filename string")
    assert staged_file_name(frame).collect() == [("a",)]
    assert staged_file_name(frame.limit(0)).isEmpty()


def test_stage_if_new_runs_no_job_while_it_is_planned(spark):
    rows = spark.createDataFrame([(f"F{i % 50}", f"T{i % 50}", i) for i in range(500)], "input_filename string, internallog_ts string, n int")
    loaded = spark.createDataFrame([("F1", None), ("F2", "T3"), (None, "T4")], "input_filename string, internallog_ts string")
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup()
    fresh = stage_if_new(rows, loaded, ("input_filename", "internallog_ts"))
    only_names = stage_if_new(rows, loaded)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup() == jobs
    assert sorted(r["n"] for r in fresh.collect()) == [i for i in range(500) if i % 50 not in (1, 2, 3, 4)]
    assert sorted(r["n"] for r in only_names.collect()) == [i for i in range(500) if i % 50 not in (1, 2)]


def test_decoded_folder(spark, tmp_path):
    values = ["v"] * len(STAGED_POINTS)
    values[6] = "12.34"
    put(tmp_path, "part-0", (";".join(values) + "\nshort;line\n").encode())
    frame, wrong = load_decoded_folder(spark, str(tmp_path), STAGED_POINTS)
    assert frame.schema.simpleString() == STAGED_POINTS.simpleString()
    assert str(frame.first()["transaction_value"]) == "12.34" and frame.count() == 1
    assert [tuple(r)[:2] for r in wrong.collect()] == [("short;line", "field count")]


def test_header_values_reach_every_row_of_their_file(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4)], "input_filename string, n int")
    headers = spark.createDataFrame(
        [("a", "H1", 1), ("b", "H3", 9), ("b", "H2", 4)], "input_filename string, internallog_ts string, line_order int"
    )
    found = decode.with_header_value(rows, headers)
    assert sorted((r["n"], r["internallog_ts"]) for r in found.collect()) == [(1, "H1"), (2, "H1"), (3, "H2"), (4, None)]


def test_scratch_folders_lie_in_the_shared_folder_and_are_new(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert first != second and first.startswith(shared)


def test_scratch_folders_need_a_shared_folder_on_a_cluster(monkeypatch):
    class Conf:
        def __init__(self, master):
            self.master = master

        def get(self, key, default=None):
            return {"spark.master": self.master}.get(key, default)

    class Session:
        def __init__(self, master):
            self.conf = Conf(master)

    assert scratch_folder(Session("local[4]"), "x").startswith("/tmp/run-")
    with pytest.raises(ValueError, match="checkpoint.dir"):
        scratch_folder(Session("spark://host:7077"), "x")


def test_a_document_becomes_one_file_where_the_file_system_can(spark, tmp_path):
    import os

    from cardledger.operators.outputs import deliver, write_document

    rows = spark.createDataFrame([(str(i), "x;y") for i in range(9)], "a string, b string")
    one, many, none = (str(tmp_path / n) for n in ("one", "many", "none"))
    write_document(rows.coalesce(1), one)
    assert deliver(spark, one, str(tmp_path / "ONE.csv"))
    assert [r.value for r in spark.read.text(str(tmp_path / "ONE.csv")).collect()] == [f"{i};x y" for i in range(9)]
    write_document(rows.repartition(3), many)
    parts = sorted(os.listdir(many))
    assert not deliver(spark, many, str(tmp_path / "MANY.csv"))  # a local disk joins no files
    assert sorted(os.listdir(many)) == parts and not os.path.exists(tmp_path / "MANY.csv")
    write_document(rows.limit(0), none)
    assert deliver(spark, none, str(tmp_path / "NONE.csv")) and os.path.getsize(tmp_path / "NONE.csv") == 0
