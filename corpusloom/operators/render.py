"""Side-by-side HTML of sources and translations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .progress import last_of

HEADS = ("book_title", "heading")
STYLE = "body{font-family:serif;margin:2rem auto;max-width:72rem}.pair{display:grid;grid-template-columns:1fr 1fr;gap:1.5rem}.meta{color:#666;font-size:.8rem}.note{color:#999}.is-heading{font-weight:bold}"


def status(found: Column, translation: Column, state: Column) -> Column:
    """pending without a row, empty with a blank one, else the row's status (translated if it has none)."""
    return F.when(found.isNull(), "pending").when(T.strip(F.coalesce(translation, F.lit(""))) == "", "empty").otherwise(F.coalesce(F.nullif(state, F.lit("")), F.lit("translated")))


def aligned(segments: DataFrame, ledger: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """segments with translation, review_note, batch_id and derived status. Of repeated ids the last counts."""
    t = last_of(ledger.select("segment_id", "append_pos", "translation", F.col("status").alias("_state"), "review_note"), "segment_id", "append_pos")
    x = segments.drop("status").join(t.withColumnRenamed("segment_id", "id").withColumn("_found", F.lit(1)), "id", "left")
    x = x.withColumn("status", status(F.col("_found"), F.col("translation"), F.col("_state"))).drop("_found", "_state", "append_pos")
    if items is None:
        return x.withColumn("batch_id", F.lit(""))
    b = last_of(items.select(F.col("id").cast("string").alias("id"), "batch_id", "batch_order"), "id", "batch_order").drop("batch_order")
    return x.join(b, "id", "left").withColumn("batch_id", F.coalesce("batch_id", F.lit("")))


def rendered(rows: DataFrame, only_translated: bool = False, show_metadata: bool = False) -> DataFrame:
    """rows of aligned() with html. only_translated leaves out what is pending; blank rows stay."""
    x = rows.where("status <> 'pending'") if only_translated else rows
    head = F.col("kind").isin(*HEADS)
    shown = lambda c: F.when(head, T.strip_heading_marks(c)).otherwise(c)
    esc = lambda c: T.html_escape(F.col(c))
    right = F.when(F.col("status") == "pending", '<span class="note">not translated</span>').when(F.col("status") == "empty", '<span class="note">empty</span>').otherwise(T.line_html(shown(F.col("translation"))))
    meta = F.concat(F.lit('<div class="meta">'), F.array_join(F.array(esc("id"), esc("kind"), esc("chapter_id"), F.when(F.col("batch_id") == "", "no batch").otherwise(esc("batch_id")), esc("status")), " · "), F.lit("</div>")) if show_metadata else F.lit("")
    html = F.concat(
        *(F.lit('<article id="'), esc("id"), F.lit('" class="kind-'), esc("kind"), F.lit(" status-"), esc("status"), F.when(head, " is-heading").otherwise("")),
        *(F.lit('" data-chapter="'), esc("chapter_id"), F.lit('" data-batch="'), esc("batch_id"), F.lit('">'), meta),
        *(F.lit('<div class="pair"><p>'), T.line_html(shown(F.col("source"))), F.lit("</p><p>"), right, F.lit("</p></div></article>")),
    )
    return x.withColumn("html", html)


def contents(rows: DataFrame) -> DataFrame:
    """book_id, pos, id, label, html of titles and headings: the translation if there is one, else the source."""
    own = T.strip_heading_marks(F.coalesce("translation", F.lit("")))
    label = F.coalesce(F.nullif(own, F.lit("")), T.strip_heading_marks(F.col("source")))
    x = rows.where(F.col("kind").isin(*HEADS)).withColumn("label", label)
    return x.select("book_id", "pos", "id", "label", F.concat(F.lit('<a href="#'), T.html_escape(F.col("id")), F.lit('">'), T.html_escape(F.col("label")), F.lit("</a>")).alias("html"))


def status_histogram(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by, "status").agg(F.count("*").alias("n"))


def stats(rows: DataFrame, *by: str) -> DataFrame:
    """translated counts that status alone; pending counts ids without a row; blank rows are neither."""
    is_ = lambda s: F.count_if(F.col("status") == s)
    return rows.groupBy(*by).agg(F.count("*").alias("segments"), is_("translated").alias("translated"), is_("needs_review").alias("needs_review"), is_("empty").alias("empty"), is_("pending").alias("pending"))


def documents(rows: DataFrame, title: str = "Parallel text", generated_at: str = "", **options) -> DataFrame:
    """book_id, html: a whole page per book, of aligned() rows."""
    body = rendered(rows, **options).groupBy("book_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "html"))), lambda r: r["html"]), "\n").alias("body"))
    toc = contents(rows).groupBy("book_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "html"))), lambda r: r["html"]), "\n").alias("toc"))
    name = T.html_escape(F.lit(title))
    page = F.concat(F.lit('<!doctype html>\n<html><head><meta charset="utf-8"><title>'), name, F.lit(f"</title><style>{STYLE}</style></head><body><h1>"), name, F.lit(f'</h1><p class="note">{generated_at}</p><nav>\n'), F.coalesce("toc", F.lit("")), F.lit("\n</nav>\n"), F.col("body"), F.lit("\n</body></html>\n"))
    return body.join(toc, "book_id", "left").select("book_id", page.alias("html"))
