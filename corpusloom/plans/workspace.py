"""The life of a translation: prepare, request, merge, append, report, assemble, build.

A workspace is a folder of tables in JSON Lines. Nothing is stored about progress: what is pending
is always derived from the segments and the ledger, so a step that broke off can be taken again.

    input/                 books (.md, .txt) and archives (.epub)
    work/segments.jsonl    work/batches.jsonl    work/translations.jsonl (the ledger)
    work/checkpoints/      requests and the outputs that answer them
    work/clean/            books without page markers, if they were cleaned beforehand
    output/                parallel.html, rebuilt archives

With several books, segment and batch ids carry their book in front (book:ch001-p0001), so that
they stay unique; with one book they are as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T
from ..operators import batch, context, epub, progress, render, segment, translations, validate
from ..schemas import CONTEXT_SEGMENTS, MAX_BATCH_BYTES, MAX_BATCH_SEGMENTS, MAX_SEGMENT_BYTES, SEGMENT, BATCH
from ..sinks import files
from ..sources import epub as E
from ..sources import text as S

LEDGER = "append_pos bigint, segment_id string, translation string, status string, review_note string"
LISTED = 20


def _listed(rows: DataFrame, *columns: str, n: int = LISTED) -> str:
    return ", ".join(":".join(str(v) for v in r if v is not None) for r in rows.select(*columns).limit(n).collect())


class Workspace:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.segments_path, self.batches_path, self.ledger_path = (f"{self.root}/work/{n}.jsonl" for n in ("segments", "batches", "translations"))
        # parsed tables, for as long as their files stay the same
        self._held: dict[str, tuple[tuple, DataFrame]] = {}
        self.checkpoints, self.html_path = f"{self.root}/work/checkpoints", f"{self.root}/output/parallel.html"

    # tables

    def _table(self, path: str, schema: str, optional: bool = False) -> DataFrame:
        mark, held = files.signature(self.spark, path), self._held.get(path)
        if held and held[0] == mark:
            return held[1]
        x = S.read_jsonl(self.spark, path, schema, optional=optional).persist()
        if held:
            held[1].unpersist()
        self._held[path] = (mark, x)
        if bad := x.where("error is not null").select("file", "line_number", "error").limit(LISTED).collect():
            del self._held[path]
            raise ValueError("; ".join(f"{r['file']}:{r['line_number']}: {r['error']}" for r in bad))
        return x

    def segments(self) -> DataFrame:
        """Files of other writers have no pos; there the line is the position."""
        x = self._table(self.segments_path, SEGMENT)
        return x.select("fields.*", "line_number").withColumn("pos", F.coalesce("pos", F.col("line_number").cast("long"))).withColumn("book_id", F.coalesce("book_id", F.lit(""))).drop("line_number")

    def _as_written(self, path: str, schema: str, optional: bool = False) -> DataFrame:
        """The rows of a file with the keys and the JSON that they had there, for the checks of both."""
        return self._table(path, schema, optional).select("fields.*", "keys", "line")

    def batches(self) -> DataFrame:
        return self._table(self.batches_path, BATCH).select("fields.*").withColumn("book_id", F.coalesce("book_id", F.lit("")))

    def items(self) -> DataFrame:
        """batch_id, batch_order, idx, and the segment's fields and position."""
        flat = batch.flat(self.batches())
        return flat.join(self.segments().select("id", "pos"), "id", "left")

    def ledger(self) -> DataFrame:
        x = self._table(self.ledger_path, LEDGER, optional=True)
        return x.select("fields.*", "line_number").withColumn("append_pos", F.coalesce("append_pos", F.col("line_number").cast("long"))).drop("line_number")

    # preparation

    def read_epubs(self, path: str | None = None, overwrite: bool = False) -> dict:
        """Archives of input/ as Markdown beside them."""
        blocks = E.book_blocks(E.archives(self.spark, path or f"{self.root}/input/*.epub"))
        if bad := blocks.where("error is not null").select("book_id", "error.stage", "error.message").limit(LISTED).collect():
            raise ValueError("; ".join(": ".join(map(str, r)) for r in bad))
        books = E.as_books(blocks)
        written = files.put_each(books, f"{self.root}/input", "book_id", "text", ".md", overwrite)
        counts = books.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("documents", "headings", "paragraphs"))).first().asDict()
        return {"ok": True, "books": len(written), **counts}

    def prepare(self, books: DataFrame | None = None, max_segment_bytes: int = MAX_SEGMENT_BYTES, keep_page_markers: bool = False, max_bytes: int = MAX_BATCH_BYTES, max_segments: int = MAX_BATCH_SEGMENTS, max_chars: int | None = None, overwrite: bool = False) -> dict:
        """Segments and batches of all books: those in work/clean, if clean() was run, else those in input/."""
        if books is None:
            cleaned = f"{self.root}/work/clean"
            found = S.read_books(self.spark, f"{cleaned}/*.md" if files.exists(self.spark, cleaned) else f"{self.root}/input/*.{{md,txt}}")
            books = found.withColumn("book_id", F.regexp_replace("book_id", r"\.no_pages$", ""))
        several = books.select("book_id").distinct().limit(2).count() > 1
        named = lambda c: F.concat("book_id", F.lit(":"), c) if several else F.col(c)
        segs = segment.segment(books, max_segment_bytes, not keep_page_markers).withColumn("id", named("id"))
        files.write_jsonl(segs, self.segments_path, "book_id", "pos", overwrite=overwrite)
        segs = self.segments()
        validate.enforce(validate.segments(segs))
        rows = batch.batches(batch.batch_items(batch.chapter_runs(segs), max_bytes, max_segments, max_chars, run="run"), run="run").withColumn("batch_id", named("batch_id"))
        files.write_jsonl(rows, self.batches_path, "book_id", "order", overwrite=overwrite)
        rows = self.batches()
        validate.enforce(validate.batches(rows))
        numbered = lambda x, *by: x.select("book_id", F.row_number().over(Window.partitionBy("book_id").orderBy(*by)).alias("n"), "id")
        a, b = numbered(segs, "pos"), numbered(batch.flat(rows), "batch_order", "idx").withColumnRenamed("id", "other")
        wrong = a.join(b, ["book_id", "n"], "full_outer").where("not (id <=> other)").select("book_id").distinct()
        if bad := _listed(wrong, "book_id"):
            raise ValueError(f"batches: segments missing, extra or out of order in {bad}")
        return {"ok": True, **segment.segment_stats(segs).first().asDict(), **batch.batch_stats(rows).first().asDict()}

    # progress

    def _checked(self) -> tuple[DataFrame, DataFrame]:
        """(items, ledger), after strict checks of both."""
        items, ledger = self.items(), self.ledger()
        validate.enforce(validate.batches(self._as_written(self.batches_path, BATCH)).unionByName(validate.translations(self._as_written(self.ledger_path, LEDGER, True), items)))
        return items, ledger

    def pending(self, items: DataFrame | None = None, ledger: DataFrame | None = None) -> DataFrame:
        items = self.items() if items is None else items
        ledger = self.ledger() if ledger is None else ledger
        return progress.pending_batches(items, progress.completed(ledger), ["book_id", "batch_order", "batch_id"], "idx")

    def first_pending(self, n: int = 1) -> list[dict]:
        return [r.asDict() for r in progress.first_pending(self.pending(), "book_id", "batch_order", n=n).drop("first_pos").collect()]

    def report(self, expect: list[str] = (), expect_from: str | None = None, expect_count: int | None = None, list_pending: int = 5) -> dict:
        """What is done and what is wrong; nothing is raised but misuse of the arguments."""
        if expect and (expect_from or expect_count is not None):
            raise ValueError("name batches or give a range, not both")
        if bool(expect_from) != (expect_count is not None):
            raise ValueError("a range needs its first batch and a count")
        segs, items, ledger = self.segments(), self.items(), self.ledger()
        done = progress.completed(ledger)
        issues: dict[str, list] = {}
        wrong = validate.report(segs, items, ledger, self.batches().select("batch_id"))
        # the first few of each issue: a top-k, cut in each task before the shuffle
        rank = F.row_number().over(Window.partitionBy("issue").orderBy("entity_id"))
        for r in wrong.withColumn("rank", rank).where(F.col("rank") <= LISTED).orderBy("issue", "rank").collect():
            issues.setdefault(r["issue"], []).append(r["entity_id"])
        order = items.groupBy("book_id", "batch_id").agg(F.min("batch_order").alias("batch_order"))
        expected: list[str] = list(expect)
        if expect_from:
            expected = [r["batch_id"] for r in progress.batch_range(order, expect_from, expect_count, "book_id", "batch_order").orderBy("book_id", "batch_order").collect()]
            if len(expected) < expect_count:
                issues["unknown_expected_batches"] = [expect_from]
        checkpoint = None
        if expected:
            wanted = self.spark.createDataFrame([(b,) for b in expected], "batch_id string")
            rows = progress.checkpoint(items.join(F.broadcast(wanted), "batch_id"), done).collect()
            missing = {r["batch_id"]: r["missing"] for r in rows if r["missing"]}
            if unknown := sorted(set(expected) - {r["batch_id"] for r in rows}):
                issues["unknown_expected_batches"] = unknown
            if missing:
                issues["expected_missing_by_batch"] = missing
            checkpoint = {"batches": expected, "segments": items.join(F.broadcast(wanted), "batch_id").count(), "missing": sum(map(len, missing.values()))}
        counts = progress.totals(segs, ledger).first()
        waiting = self.pending(items, ledger)
        first = [r.asDict() for r in progress.first_pending(waiting, "book_id", "batch_order", n=max(list_pending, 1)).select("batch_id", "missing_count", "first_missing_segment_id", "last_missing_segment_id", "segment_count").collect()]
        return {
            "ok": not issues,
            "segments": counts["segments"],
            "batches": order.count(),
            "translation_rows": ledger.count(),
            "translated_source_segments": counts["completed"],
            "pending_source_segments": counts["pending"],
            "next_missing_batch": first[0] if first else None,
            "pending_batches": first[: max(list_pending, 0)],
            "checkpoint": checkpoint,
            "issues": issues,
        }

    @staticmethod
    def shown(report: dict) -> str:
        """A report for people."""
        total, done = report["segments"], report["translated_source_segments"]
        span = lambda b: f"{b['first_missing_segment_id']}..{b['last_missing_segment_id']}"
        lines = [f"Progress: {done}/{total} translated ({done / total * 100 if total else 0.0:.1f}%), pending {report['pending_source_segments']}"]
        nxt = report["next_missing_batch"]
        lines.append(f"Next: {nxt['batch_id']} ({span(nxt)}, {nxt['missing_count']} missing)" if nxt else "Next: none")
        lines.append("Issues: " + (", ".join(k for k, v in report["issues"].items() if v) or "none"))
        if report["pending_batches"]:
            lines += ["Pending batches:", *(f"- {b['batch_id']}: {b['missing_count']} ({span(b)})" for b in report["pending_batches"])]
        return "\n".join(lines)

    # requests

    def requests(self, context_segments: int = CONTEXT_SEGMENTS, style_path: str | None = None, batch_id: str | None = None, next_command: str | None = None) -> DataFrame:
        """batch_id, request of every pending batch, or of one."""
        items, ledger = self._checked()
        style, origin = S.style_guide(self.spark, style_path, context.DEFAULT_STYLE)
        done = progress.completed(ledger)
        left = progress.pending_items(items, done)
        if batch_id is not None:
            left = left.where(F.col("batch_id") == batch_id)
        targets = left.groupBy("batch_id", "book_id", "chapter_id").agg(F.min("pos").alias("first_pos"))
        finished = progress.last_of(ledger.select(F.col("segment_id").alias("id"), "append_pos", "translation"), "id", "append_pos")
        before = context.previous(items, targets, finished, context_segments)
        return context.requests(targets.select("batch_id", "chapter_id"), left, before, style, origin, f"{self.checkpoints}/{{batch}}_output.jsonl", next_command)

    def request_paths(self, batch_id: str) -> tuple[str, str]:
        name = batch_id.replace(":", "_").replace("/", "_")
        return f"{self.checkpoints}/{name}_request.md", f"{self.checkpoints}/{name}_output.jsonl"

    def request(self, batch_id: str | None = None, **options) -> dict:
        """Writes the request of a batch (the first that is pending)."""
        if batch_id is None:
            first = self.first_pending()
            if not first:
                raise ValueError("no batch is pending")
            batch_id = first[0]["batch_id"]
        elif not self.items().where(F.col("batch_id") == batch_id).limit(1).count():
            raise ValueError(f"unknown batch: {batch_id}")
        row = self.requests(batch_id=batch_id, **options).first()
        if row is None:
            raise ValueError(f"batch is complete: {batch_id}")
        ask, answer = self.request_paths(batch_id)
        files.put(self.spark, ask, row["request"].replace(f"{self.checkpoints}/{batch_id}_output.jsonl", answer))
        return {"ok": True, "batch_id": batch_id, "request_path": ask, "model_output_path": answer, "request": row["request"]}

    # what comes back

    def merge(self, output_path: str, batch_id: str, append: bool = False) -> dict:
        """The rows of a model's output for one batch, in order and normalised; and appended, if asked for."""
        items, ledger = self.items(), self.ledger()
        own = items.where(F.col("batch_id") == batch_id)
        if not own.limit(1).count():
            raise ValueError(f"unknown batch: {batch_id}")
        expected = progress.pending_items(own, progress.completed(ledger)).select("batch_id", "id", "idx", "source").cache()
        try:
            if not expected.limit(1).count():
                raise ValueError(f"batch is complete: {batch_id}")
            raw = self.spark.read.text(output_path, wholetext=True)
            rows = S.parse_model_output(raw, "value").withColumn("batch_id", F.lit(batch_id))
            if bad := rows.where("error is not null").select("error").first():
                raise ValueError(f"{output_path}: {bad[0]}")
            rows = rows.select("batch_id", "pos", F.col("segment_id").alias("id"), "translation", "status", "review_note")
            if rows.where("id is null or id = ''").limit(1).count():
                raise ValueError("a row has no segment_id")
            cover = translations.exact_cover(expected, rows, ["batch_id"]).first()
            for name in ("duplicate", "missing", "extra"):
                if cover[name]:
                    raise ValueError(f"{name} segment ids: {', '.join(map(str, cover[name][:LISTED]))}")
            good = translations.merged(expected, rows.drop("batch_id"))
            if bad := good.where("error is not null").select("id", "error").limit(LISTED).collect():
                raise ValueError("; ".join(f"{r['id']}: {r['error']}" for r in bad))
            out = good.select(F.col("id").alias("segment_id"), "translation", "status", "review_note", "idx")
            merged_path = output_path.rsplit(".", 1)[0] + "_merged.jsonl"
            lines = [r["value"] for r in files.json_lines(out.orderBy("idx").drop("idx")).collect()]  # one batch: at most max_segments rows
            files.put(self.spark, merged_path, "".join(f"{x}\n" for x in lines))
            ids = [r["segment_id"] for r in out.select("segment_id", "idx").orderBy("idx").collect()]
        finally:
            expected.unpersist()
        done = self.append(merged_path) if append else None
        return {"ok": True, "batch_id": batch_id, "merged_output_path": merged_path, "validated_rows": len(ids), "first_segment_id": ids[0], "last_segment_id": ids[-1], "reordered": bool(cover["reordered"]), "appended": append, "append_report": done}

    def append(self, draft_path: str, allow_existing: bool = False, dry_run: bool = False) -> dict:
        """Draft rows go to the ledger's end, all or none. A row that is there is an error, or is skipped."""
        segs, ledger = self.segments(), self.ledger()
        for rows, key, name in ((segs, "id", "source"), (ledger, "segment_id", "ledger")):
            if twice := _listed(progress.duplicates(rows, key), key):
                raise ValueError(f"the {name} repeats ids: {twice}")
        draft = S.read_jsonl(self.spark, draft_path, "segment_id string, translation string, status string, review_note string")
        if bad := draft.where("error is not null").select("line_number", "error").limit(LISTED).collect():
            raise ValueError("; ".join(f"{draft_path}:{r['line_number']}: {r['error']}" for r in bad))
        # a draft in parts is one draft: lines go on counting from part to part, in the order of their names
        parts = draft.groupBy("file").agg(F.max("line_number").alias("_lines"))
        above = F.coalesce(F.sum("_lines").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        draft = draft.join(F.broadcast(parts.select("file", above.alias("_above"))), "file").select((F.col("line_number") + F.col("_above")).cast("long").alias("append_pos"), "fields.*")
        order = segs.withColumn("pos", F.struct("book_id", "pos"))
        plan = translations.append_plan(draft, order, ledger, allow_existing).cache()
        try:
            counts = {r["action"]: r["n"] for r in plan.groupBy("action").agg(F.count("*").alias("n")).collect()}
            if not counts:
                raise ValueError("the draft is empty")
            if errors := sorted(set(counts) - {"append", "skip"}):
                bad = plan.where(F.col("action").isin(errors)).orderBy("append_pos").select("segment_id", "action").limit(LISTED).collect()
                raise ValueError("; ".join(f"{r['segment_id']}: {r['action']}" for r in bad))
            new = plan.where("action = 'append'")
            first = new.agg(F.min_by("segment_id", "append_pos"), F.max_by("segment_id", "append_pos")).first()
            if not dry_run and counts.get("append"):
                last = ledger.agg(F.coalesce(F.max("append_pos"), F.lit(0))).first()[0]
                files.append_jsonl(new.withColumn("append_pos", F.col("append_pos") + last).drop("action"), self.ledger_path)
        finally:
            plan.unpersist()
        return {"ok": True, "dry_run": dry_run, "appended_rows": 0 if dry_run else counts.get("append", 0), "validated_rows": sum(counts.values()), "skipped_existing_rows": counts.get("skip", 0), "first_segment_id": first[0], "last_segment_id": first[1]}

    def step(self, assemble: bool = False, context_segments: int = 8) -> dict:
        """Submits the output of the first pending batch, if it is there, and asks for the next; or assembles."""
        self._checked()
        performed, submitted = ["validate_progress"], None
        state = self.report(list_pending=1)
        if not state["ok"]:
            raise ValueError(f"progress is not valid: {state['issues']}")
        if state["next_missing_batch"]:
            batch_id = state["next_missing_batch"]["batch_id"]
            ask, answer = self.request_paths(batch_id)
            found, asked = files.size_and_time(self.spark, answer), files.size_and_time(self.spark, ask)
            if found and found[0]:
                if asked and found[1] < asked[1]:
                    raise ValueError(f"the output is older than its request: {answer}")
                self.merge(answer, batch_id, append=True)
                state = self.report([batch_id], list_pending=1)
                if not state["ok"]:
                    raise ValueError(f"progress is not valid: {state['issues']}")
                performed += [f"merge_output:{batch_id}", f"validate_batch:{batch_id}"]
                submitted = batch_id
        base = {"ok": True, "performed": performed, "submitted_batch_id": submitted}
        if assemble:
            done = self.assemble()
            performed.append("assemble_parallel")
            return base | {"action": "assembled", "assembled": True, "parallel_output": self.html_path, "next_pending_batch": state["next_missing_batch"], "validation": state, "assembly": done}
        if not state["next_missing_batch"]:
            return base | {"action": "no_pending", "assembled": False}
        made = self.request(state["next_missing_batch"]["batch_id"], context_segments=context_segments)
        performed.append(f"prepare_request:{made['batch_id']}")
        return base | {"action": "translate", "assembled": False} | made

    def checkpoint(self, batches: list[str] = (), from_batch: str | None = None, count: int | None = None, list_pending: int = 12, skip_assemble: bool = False) -> dict:
        """Checks that the batches are complete, and rebuilds the pages."""
        state = self.report(list(batches), from_batch, count, list_pending)
        if not state["ok"]:
            raise ValueError(f"checkpoint is not valid: {state['issues']}")
        return {"ok": True, "validation": state, "assembly": None if skip_assemble else self.assemble()}

    # results

    def assemble(self, title: str = "Parallel text", only_translated: bool = False, show_metadata: bool = False, generated_at: str | None = None) -> dict:
        """Side-by-side pages: output/parallel.html for one book, a page for each of several."""
        segs, ledger = self.segments(), self.ledger()
        rows = render.aligned(segs, ledger, self.items())
        pages = render.documents(rows, title, generated_at or files.now(), only_translated=only_translated, show_metadata=show_metadata)
        several = segs.select("book_id").distinct().limit(2).count() > 1
        if several:
            files.put_each(pages, f"{self.root}/output", "book_id", "html", ".html", overwrite=True)
        elif (page := pages.first()) is not None:
            files.put(self.spark, self.html_path, page["html"])
        shown = rows.where("status <> 'pending'") if only_translated else rows
        twice = progress.later_occurrences(ledger, "segment_id", "append_pos").orderBy("append_pos")
        lost = ledger.select("segment_id").distinct().join(segs.select(F.col("id").alias("segment_id")), "segment_id", "left_anti").orderBy("segment_id")
        ids = lambda x: [r[0] for r in x.select("segment_id").limit(LISTED).collect()]
        return {"ok": True, **render.stats(rows).first().asDict(), "rendered_status_counts": {r["status"]: r["n"] for r in render.status_histogram(shown).collect()}, "duplicate_translation_ids": ids(twice), "unmatched_translation_ids": ids(lost)}

    def build_epubs(self, path: str | None = None, language: str = "zh-CN", dry_run: bool = False, overwrite: bool = False, **options) -> list[dict]:
        """Translated archives in output/; the ones that cannot be built safely are reported and not written."""
        books = E.archives(self.spark, path or f"{self.root}/input/*.epub")
        built = epub.build_epubs(books, self.segments(), self.ledger(), language=language, dry_run=dry_run, **options)
        built = built.cache()
        try:
            built.count()
            # the archives are read once more: one that changed meanwhile is not written
            built = epub.unchanged(built, E.archives(self.spark, path or f"{self.root}/input/*.epub"))
            if not dry_run:
                files.put_each(built.where("content is not null"), f"{self.root}/output", "book_id", "content", ".translated.epub", overwrite)
            return [r.asDict(recursive=True) for r in built.drop("content").collect()]
        finally:
            built.unpersist()


def clean(spark: SparkSession, source: str, target: str, overwrite: bool = False) -> dict:
    """Books without page markers, one text file each."""
    books = segment.clean_pages(S.read_books(spark, source))
    files.put_each(books, target, "book_id", "text", ".no_pages.md", overwrite)
    r = books.agg(F.coalesce(F.sum("removed"), F.lit(0)), F.coalesce(F.sum(T.line_count(F.col("text"))), F.lit(0))).first()
    return {"ok": True, "removed_page_markers": r[0], "lines": r[1]}
