"""Command line over a folder of tables: `python -m auricle COMMAND --root FOLDER …`."""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import SparkSession

from auricle import clock, schemas
from auricle.operators import aggregates
from auricle.plans import reports, retention, sync, transfer
from auricle.session import build_session
from auricle.sources.objects import list_objects
from auricle.sources.tables import read_table


SHOWN = 50


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="auricle")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, text: str):
        sub = commands.add_parser(name, help=text)
        sub.add_argument("--root", required=True, help="folder with one folder per table, or files")
        if name != "sync":
            sub.add_argument("--out", help="folder for the whole result")
        return sub

    sub = command("sync", "move the best flagged items into the review tables")
    sub.add_argument("--threshold", "-t", type=float, default=0.7)
    sub.add_argument("--limit", "-l", type=int, default=100)
    sub.add_argument("--dry-run", action="store_true", help="only count the candidates")
    sub.add_argument("--out", help="folder for the rows to add; default: ROOT/sync")
    command("stats", "rolling totals of the last 24 hours")
    sub = command("verify-batch", "coverage and issues of batches")
    sub.add_argument("--pattern", required=True)
    sub = command("verify-recent", "completeness of the last hours")
    sub.add_argument("--hours", type=int, default=24)
    command("overall", "totals, hourly rate and statuses")
    sub = command("clear-plan", "objects a bucket clear would delete")
    sub.add_argument("--confirm", action="store_true")
    sub = command("transfer-plan", "archives the next transfer cycle would take")
    sub.add_argument("--test", action="store_true", help="one archive only")
    return parser


def _show(sections, out: str | None = None) -> None:
    """Prints the beginning of each section with its row count; `out` takes the whole of it."""
    for name, frame in sections.items():
        if out:
            path = f"{out}/{name.replace(' ', '_')}"
            frame.write.mode("overwrite").parquet(path)
            frame = frame.sparkSession.read.parquet(path)
        print(f"--- {name}: {frame.count()} rows" + (f", written to {path}" if out else ""))
        frame.show(SHOWN, truncate=60)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    root = args.root.rstrip("/")
    at = clock.now()
    if args.command == "clear-plan":
        _show({"objects": retention.bucket_clear(list_objects(spark, root), args.confirm)}, args.out)
        return
    if args.command == "transfer-plan":
        listing = list_objects(spark, root)
        plan = transfer.select_sources(listing, at, test=True) if args.test else None
        _show({"archives": transfer.dry_run(listing, at) if plan is None else plan}, args.out)
        return
    names = list(schemas.TABLES)
    tables = {n: read_table(spark, f"{root}/{n}", n) for n in names}
    core = [tables[n] for n in names[:3]]
    if args.command == "stats":
        _show({"last 24 hours": aggregates.rolling_totals(core[0], at)}, args.out)
    elif args.command == "verify-batch":
        _show(reports.verify_batch(*core, args.pattern), args.out)
    elif args.command == "verify-recent":
        _show(reports.verify_recent(*core, at, args.hours), args.out)
    elif args.command == "overall":
        _show(reports.overall_stats(*core, at), args.out)
    elif args.dry_run:
        _show({"candidates": sync.dry_run(*core, args.threshold)})
    else:
        out = args.out or f"{root}/sync"
        files, review_rows, creators = sync.after_runs(
            core[0], tables["transcripts"], tables["creators"], sync.earlier_runs(spark, out)
        )
        plan = sync.plan_sync(
            files, *core[1:], review_rows, creators, at, args.threshold, args.limit
        )
        sync.write_sync(plan, out, uuid.uuid4().hex)
        _show({"sync": plan.summary})


if __name__ == "__main__":
    run(build_session(), _parser().parse_args())
