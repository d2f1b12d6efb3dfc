"""Command line: one stage or all stages of a feed, and table maintenance.

    spark-submit cardledger/jobs.py feed points --store S --folder IN --prefix PTS_ --timestamp-length 8 --out OUT
    spark-submit cardledger/jobs.py feed points --store S --stage book --out OUT
    spark-submit cardledger/jobs.py snapshot 20240131 --store S

Prints the control totals as one JSON line.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cardledger.operators.ledgers import BUCKETS, LedgerStore  # noqa: E402
from cardledger.operators.outputs import deliver, write_document  # noqa: E402
from cardledger.plans import feeds  # noqa: E402
from cardledger.session import build_session, run_timestamp  # noqa: E402

# Tables that a rewrite covers when none is named.
REWRITTEN = (
    "l_anag",
    "l_balance",
    "l_transaction",
    "p_enrolment",
    "p_points",
    "p_maintenance",
    "p_saveback",
    "i_enrolment_rejected",
    "i_points_rejected",
    "i_maintenance_rejected",
    "i_saveback_rejected",
)


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, text: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=text)
        sub.add_argument("--store", required=True, help="folder of the ledgers")
        sub.add_argument("--format", default="parquet", choices=("parquet", "orc"))
        sub.add_argument("--run-ts", help="yyyyMMddHHmmss, now (UTC) by default")
        return sub

    create = command("create", "a new store with empty tables")
    create.add_argument("--buckets", type=int, default=BUCKETS, help="of master and balances; some hundred thousand rows each")
    feed = command("feed", "stages of a feed")
    feed.add_argument("--stage", default="all", choices=("all", "read", "book", "clear", "book-and-clear"))
    check = command("check", "write what does not add up in the next file, without staging it")
    for sub in (feed, check):
        sub.add_argument("feed", choices=tuple(feeds.READ))
        sub.add_argument("--folder", help="folder of the waiting files")
        sub.add_argument("--prefix", default="", help="fixed part of the file name")
        sub.add_argument("--timestamp-length", type=int, default=14)
        sub.add_argument("--out", help="folder for the output documents")
    decoded = command("load-decoded", "stage a folder of already decoded lines")
    decoded.add_argument("feed", choices=tuple(feeds.READ))
    decoded.add_argument("folder")
    for name, text in (("snapshot", "name the present state of the ledgers"), ("restore", "go back to a named state")):
        command(name, text).add_argument("tag")
    command("rewrite", "rewrite tables into one folder each").add_argument("tables", nargs="*")
    expire = command("expire", "delete the files of older runs that no table shows")
    expire.add_argument("before", help="run timestamp; runs from it on keep their files")
    expire.add_argument("tables", nargs="*")
    document = command("deliver", "join the parts of a document into one file")
    document.add_argument("folder")
    document.add_argument("file")
    column = command("add-column", "a constant column after another one")
    for name in ("table", "name", "value", "after"):
        column.add_argument(name)
    return parser.parse_args(argv)


def _next(store: LedgerStore, args: argparse.Namespace) -> feeds.InputFile | None:
    return feeds.next_file(store, args.feed, args.folder, args.prefix, args.timestamp_length)


def _check(store: LedgerStore, args: argparse.Namespace) -> dict:
    source = _next(store, args)
    if source is None:
        return {"input_filename": None}
    path = f"{args.out.rstrip('/')}/CHECK_{source.name}"
    write_document(feeds.check_file(store, args.feed, source), path)
    return {"input_filename": source.name, "documents": [path]}


def _run_feed(store: LedgerStore, args: argparse.Namespace, run_ts: str) -> dict:
    totals: dict = {"feed": args.feed, "stage": args.stage}
    if args.stage in ("all", "read"):
        source = _next(store, args)
        totals["staged"] = source is not None and feeds.READ[args.feed](store, source, run_ts)
        if not totals["staged"]:
            return totals
    if args.stage in ("all", "book", "book-and-clear"):
        booking = feeds.BOOK[args.feed](store, args.out, run_ts)
        if booking:
            totals |= booking.totals | {"documents": booking.documents}
    if args.stage in ("all", "clear", "book-and-clear"):
        feeds.clear(store, args.feed, run_ts)
    return totals


def main(argv: list[str] | None = None) -> dict:
    args = _arguments(argv)
    spark = build_session()
    run_ts = args.run_ts or run_timestamp(spark)
    result: dict = {"command": args.command, "run_ts": run_ts}
    if args.command == "create":
        feeds.create_store(spark, args.store, args.format, args.buckets)
    else:
        store = LedgerStore(spark, args.store, args.format)
        if args.command == "feed":
            result |= _run_feed(store, args, run_ts)
        elif args.command == "check":
            result |= _check(store, args)
        elif args.command == "load-decoded":
            result["rows"] = feeds.load_decoded(store, args.feed, args.folder, run_ts)
        elif args.command == "expire":
            names = args.tables or [t for t in (*feeds.TABLES, *(f"i_{f}_routes" for f in feeds.READ)) if store.has(t)]
            result["deleted"] = {t: gone for t in names if (gone := store.expire(t, args.before))}
        elif args.command == "deliver":
            result["joined"] = deliver(spark, args.folder, args.file)
        elif args.command == "snapshot":
            store.snapshot(args.tag, run_ts)
        elif args.command == "restore":
            store.restore(args.tag, run_ts)
        elif args.command == "rewrite":
            store.rewrite(args.tables or [t for t in REWRITTEN if store.has(t)], run_ts)
        else:
            value = int(args.value) if args.value.lstrip("-").isdigit() else args.value
            store.migrate_column(args.table, args.name, value, args.after, run_ts)
    print(json.dumps(result))
    return result


if __name__ == "__main__":
    main()
