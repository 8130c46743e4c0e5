"""Command line: python -m corpusloom COMMAND. Reports are one line of JSON; a failure is a message and exit code 1."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .plans.workspace import Workspace, clean
from .schemas import CONTEXT_SEGMENTS, MAX_BATCH_BYTES, MAX_BATCH_SEGMENTS, MAX_SEGMENT_BYTES
from .sinks.files import report_line


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="corpusloom", description=__doc__)
    p.add_argument("--root", default=".", help="the workspace folder")
    p.add_argument("--master", help="Spark master, if not set by spark-submit")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, text: str) -> argparse.ArgumentParser:
        return sub.add_parser(name, help=text, description=text)

    c = command("strip-page-markers", "books without page marker lines")
    c.add_argument("--input", help="default: input/ of the workspace")
    c.add_argument("--output", help="default: work/clean, where prepare looks first")
    c.add_argument("--force", action="store_true")
    c = command("prepare", "cut the books of input/ into segments, and pack those into batches")
    c.add_argument("--keep-page-markers", action="store_true")
    c.add_argument("--max-segment-bytes", type=int, default=MAX_SEGMENT_BYTES)
    c.add_argument("--max-bytes", type=int, default=MAX_BATCH_BYTES)
    c.add_argument("--max-segments", type=int, default=MAX_BATCH_SEGMENTS)
    c.add_argument("--max-chars", type=int)
    c.add_argument("--force", action="store_true")
    c = command("request", "write the request of a batch, by default the first that is pending")
    c.add_argument("--batch")
    c.add_argument("--context-segments", type=int, default=CONTEXT_SEGMENTS)
    c.add_argument("--style-guide")
    c.add_argument("--next-command")
    c = command("merge", "check and normalise a model's output for one batch")
    c.add_argument("model_output")
    c.add_argument("--batch", required=True)
    c.add_argument("--append", action="store_true")
    c = command("append", "check draft rows and append them to the ledger")
    c.add_argument("draft")
    c.add_argument("--allow-existing", action="store_true")
    c.add_argument("--dry-run", action="store_true")
    c = command("validate", "what is done and what is wrong")
    c.add_argument("--expect-batches", nargs="*", default=[])
    c.add_argument("--expect-from")
    c.add_argument("--expect-count", type=int)
    c.add_argument("--list-pending", type=int, default=5)
    c = command("progress", "a short report")
    c.add_argument("--json", action="store_true")
    c.add_argument("--list-pending", type=int, default=10)
    c = command("checkpoint", "check that batches are complete, and rebuild the pages")
    c.add_argument("--from-batch")
    c.add_argument("--count", type=int)
    c.add_argument("--batches", nargs="*", default=[])
    c.add_argument("--list-pending", type=int, default=12)
    c.add_argument("--skip-assemble", action="store_true")
    c = command("step", "submit the output at hand and ask for the next batch")
    c.add_argument("--assemble", action="store_true")
    c.add_argument("--context-segments", type=int, default=8)
    c.add_argument("--no-print-request", action="store_true")
    c = command("assemble", "side-by-side pages")
    c.add_argument("--title", default="Parallel text")
    c.add_argument("--only-translated", action="store_true")
    c.add_argument("--show-metadata", action="store_true")
    c = command("read-epub", "archives of input/ as Markdown")
    c.add_argument("--input")
    c.add_argument("--force", action="store_true")
    c = command("build-epub", "translated archives")
    c.add_argument("--input")
    c.add_argument("--language", default="zh-CN")
    c.add_argument("--dry-run", action="store_true")
    c.add_argument("--force", action="store_true")
    return p


def run(a: argparse.Namespace, spark: SparkSession) -> int:
    w = Workspace(spark, a.root)
    if a.command == "strip-page-markers":
        report = clean(spark, a.input or f"{a.root}/input/*.{{md,txt}}", a.output or f"{a.root}/work/clean", a.force)
    elif a.command == "prepare":
        report = w.prepare(None, a.max_segment_bytes, a.keep_page_markers, a.max_bytes, a.max_segments, a.max_chars, a.force)
    elif a.command == "request":
        report = w.request(a.batch, context_segments=a.context_segments, style_path=a.style_guide, next_command=a.next_command)
        report.pop("request")
    elif a.command == "merge":
        report = w.merge(a.model_output, a.batch, a.append)
    elif a.command == "append":
        report = w.append(a.draft, a.allow_existing, a.dry_run)
    elif a.command == "validate":
        report = w.report(a.expect_batches, a.expect_from, a.expect_count, a.list_pending)
    elif a.command == "progress":
        report = w.report(list_pending=a.list_pending)
        if not a.json:
            print(w.shown(report))
            return 0
    elif a.command == "checkpoint":
        report = w.checkpoint(a.batches, a.from_batch, a.count, a.list_pending, a.skip_assemble)
    elif a.command == "step":
        report = w.step(a.assemble, a.context_segments)
        request = report.pop("request", None)
        print(report_line(report))
        if request and not a.no_print_request:
            print(request)
        return 0
    elif a.command == "assemble":
        report = w.assemble(a.title, a.only_translated, a.show_metadata)
    elif a.command == "read-epub":
        report = w.read_epubs(a.input, a.force)
    else:
        built = w.build_epubs(a.input, a.language, a.dry_run, a.force)
        report = {"ok": not any(b["error"] for b in built), "books": built}
    print(report_line(report))
    return 0 if report.get("ok") else 1


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    builder = SparkSession.builder.appName("corpusloom").config("spark.sql.session.timeZone", "UTC")
    spark = (builder.master(a.master) if a.master else builder).getOrCreate()
    try:
        return run(a, spark)
    except (ValueError, FileExistsError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
