"""Routing pages to subjects: keyword scores, context windows, batches, and semantic targets with a margin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factsieve.functions.storage import materialize

MIN_SCORE, CONTEXT, SEMANTIC_SCORE, SEMANTIC_MARGIN = 3, 1, 5.0, 1.5
HEADING = r"^\s*(제\s*[0-9]+\s*[장절]|[0-9]+(\.[0-9]+)*[.)]?\s|[가-하][.)]\s|#)"


def _hits(text: Column, words: Column) -> Column:
    return F.size(F.filter(words, lambda w: F.contains(text, w)))


def page_scores(pages: DataFrame, routes: DataFrame, text: str = "text", has_table: str | None = None) -> DataFrame:
    """``pages`` x ``routes`` (sheet, strong, weak, negative: word arrays) with score.

    3 a strong word, 1 a weak one, 2 for each heading-like line among the first 18 of the first 1,200 characters that
    holds either, 2 for a table, -2 a negative word. ``routes`` is a fixed word list, so its rows are broadcast.
    """
    lines = F.slice(F.split(F.substring(text, 1, 1200), "\n"), 1, 18)
    both = pages.join(F.broadcast(routes))
    heading = F.size(F.filter(lines, lambda l: (l.rlike(HEADING) | (F.length(F.trim(l)) <= 36)) & (F.trim(l) != "") & ((_hits(l, F.col("strong")) + _hits(l, F.col("weak"))) > 0)))  # noqa: E741
    table = F.when(F.col(has_table), 2).otherwise(0) if has_table else F.lit(0)
    score = 3 * _hits(F.col(text), F.col("strong")) + _hits(F.col(text), F.col("weak")) + 2 * heading + table - 2 * _hits(F.col(text), F.col("negative"))
    return both.withColumn("score", score.cast("int"))


def with_context(anchors: DataFrame, pages: DataFrame, doc: str, page: str, context: int = CONTEXT) -> DataFrame:
    """(sheet, doc, page) of anchor pages and the pages up to ``context`` around them; the band join is an equality join on exploded page numbers."""
    wanted = anchors.select("sheet", doc, F.explode(F.sequence(F.col(page) - context, F.col(page) + context)).alias(page)).distinct()
    return wanted.join(pages.select(doc, page).distinct(), [doc, page]).select("sheet", doc, page)


def top_anchors(scores: DataFrame, doc: str, page: str, k: int, least: int = MIN_SCORE) -> DataFrame:
    """The k best pages of each document and sheet by score, then page, with at least ``least``."""
    place = F.row_number().over(Window.partitionBy("sheet", doc).orderBy(F.desc("score"), page))
    return scores.filter(F.col("score") >= least).withColumn("place", place).filter(F.col("place") <= k)


def batches(df: DataFrame, group: list[str], order: str, size: int) -> DataFrame:
    """Number of the batch of ``size`` rows each row of a group falls into, from 0."""
    return df.withColumn("batch_no", F.floor((F.row_number().over(Window.partitionBy(*group).orderBy(order)) - 1) / size).cast("int"))


def index_page_kind(text: Column) -> Column:
    """"table_index", "figure_index" or "contents" by a title among the first three filled lines, "contents" also for eight
    lines that begin like a caption of which four end in a page number behind leaders; else null."""
    lines = F.filter(F.transform(F.split(text, r"\r\n|[\n\r]"), lambda l: F.trim(F.regexp_replace(l, r"[\s\p{Z}]+", " "))), lambda l: l != "")  # noqa: E741
    titles = [("table_index", r"(?i)^(표\s*(목\s*차|차\s*례)|tables?)$"), ("figure_index", r"(?i)^((그림|도|사진)\s*(목\s*차|차\s*례)|figures?)$"), ("contents", r"(?i)^(목\s*차|차\s*례|contents?)$")]
    kind = lambda l: F.coalesce(*[F.when(l.rlike(p), F.lit(name)) for name, p in titles])  # noqa: E731, E741
    title = F.get(F.array_compact(F.transform(F.slice(lines, 1, 3), kind)), 0)
    listed = F.filter(lines, lambda l: l.rlike(r"(?i)^[<\[(]?\s*(표|그림|figure)\s*[0-9]"))  # noqa: E741
    leaders = F.size(F.filter(listed, lambda l: l.rlike(r"(\.{3,}|·{4,}|…{2,})\s*[0-9]+\s*$")))  # noqa: E741
    return F.coalesce(title, F.when((F.size(listed) >= 8) & (leaders >= 4), "contents"))


def semantic_targets(channels: DataFrame, terms: DataFrame, key: list[str], least: float = SEMANTIC_SCORE, margin: float = SEMANTIC_MARGIN) -> DataFrame:
    """(key…, sheet, score, runner_up): the best sheet by weighted term hits where it scores ``least`` and leads by ``margin``.

    ``channels`` has the key, text and weight of each channel, ``terms`` (sheet, term) is a fixed list. The pairs with
    a hit are summed; the top two come from one aggregation each, so no group is sorted.
    """
    hits = channels.join(F.broadcast(terms), F.contains(F.col("text"), F.col("term"))).groupBy(*key, "sheet").agg(F.sum("weight").alias("score"))
    top = hits.groupBy(*key).agg(F.max_by("sheet", F.struct("score", "sheet")).alias("sheet"), F.slice(F.sort_array(F.collect_list("score"), asc=False), 1, 2).alias("_two"))
    out = top.select(*key, "sheet", F.col("_two")[0].alias("score"), F.coalesce(F.get("_two", 1), F.lit(0.0)).alias("runner_up"))
    return out.filter((F.col("score") >= least) & (F.col("score") - F.col("runner_up") >= margin))


def unanimous(df: DataFrame, key: list[str], value: str) -> DataFrame:
    """(key…, value): the value where all non-null ones of a key agree."""
    return df.groupBy(*key).agg(F.min(value).alias(value), F.max(value).alias("_max")).filter(F.col(value) == F.col("_max")).drop("_max")


def route_pages(pages: DataFrame, routes: DataFrame, doc: str, page: str, text: str, k: int | None = None) -> DataFrame:
    """Anchors, of each sheet and document the ``k`` best or all, and context: (sheet, doc, page)."""
    scored = page_scores(pages, routes, text).select("sheet", doc, page, "score")
    anchors = materialize(scored.filter(F.col("score") >= MIN_SCORE), "anchors")
    return with_context(top_anchors(anchors, doc, page, k) if k else anchors, pages, doc, page)
