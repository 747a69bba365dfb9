"""Document objects: building, identity, evidence match, confidence and triage."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factsieve.functions.geometry import iou
from factsieve.functions.ids import object_number
from factsieve.functions.similarity import caption_similarity

IOU_SAME, IOU_CANDIDATE, CAPTION_SAME, CAPTION_STRONG = 0.8, 0.55, 0.72, 0.94
NATIVE_CONFIDENCE = 0.78
HEADING = r"^\s*(제\s*[0-9]+\s*[장절]|[0-9]+\.\s|#+\s)"


def sections(lines: DataFrame, doc: str, order: list[str], text: str, heading: str = HEADING) -> DataFrame:
    """Each line with the last heading at or before it in its document."""
    w = Window.partitionBy(doc).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("section", F.last(F.when(F.col(text).rlike(heading), F.trim(F.col(text))), ignorenulls=True).over(w))


def page_objects(pages: DataFrame, doc: str, page: str, text: str) -> DataFrame:
    """Objects of a page's text: one row a block between blank lines, typed text, table or caption, numbered on the page."""
    blocks = pages.select(doc, page, F.posexplode(F.split(text, r"\n\s*\n")).alias("sequence", "text"))
    table = F.size(F.filter(F.split("text", "\n"), lambda l: l.rlike(r"[|;\t].*[|;\t]"))) >= 2  # noqa: E741
    caption = F.col("text").rlike(r"^\s*[<\[]?\s*(표|그림)\s*[0-9]")
    kind = F.when(table, "table").when(caption, "caption").otherwise("text")
    return blocks.filter(F.trim("text") != "").select(doc, page, "sequence", kind.alias("object_type"), "text", object_number(F.col("text")).alias("number"))


def match_objects(left: DataFrame, right: DataFrame, doc: str, page: str) -> DataFrame:
    """(left_id, right_id, rule): the first rule that holds among shared id, number, caption and overlap, for pairs of one page and type.

    Both sides have object_id, object_type, number, caption and box. Candidates come from the equality on document, page
    and type, which holds few objects; similarity is computed for those only.
    """
    r = right.select(*[F.col(c).alias(f"r_{c}") for c in (doc, page, "object_id", "object_type", "number", "caption", "box")])
    pairs = left.join(r, (F.col(doc) == F.col(f"r_{doc}")) & (F.col(page) == F.col(f"r_{page}")) & (F.col("object_type") == F.col("r_object_type")))
    pairs = pairs.withColumns({"_iou": iou(F.col("box"), F.col("r_box")), "_sim": caption_similarity(F.coalesce("caption", F.lit("")), F.coalesce("r_caption", F.lit("")))})
    rule = F.when(F.col("object_id") == F.col("r_object_id"), "id").when((F.col("number") == F.col("r_number")) & (F.col("_sim") >= CAPTION_SAME), "number").when(F.col("_sim") >= CAPTION_STRONG, "caption").when(F.col("_iou") >= IOU_SAME, "overlap")
    return pairs.select(F.col("object_id").alias("left_id"), F.col("r_object_id").alias("right_id"), rule.alias("rule")).filter(F.col("rule").isNotNull())


def unique_matches(pairs: DataFrame) -> DataFrame:
    """Pairs in which both sides occur once; the others are ambiguous and left for review."""
    n = pairs.groupBy("left_id").agg(F.count("*").alias("_n"))
    m = pairs.groupBy("right_id").agg(F.count("*").alias("_m"))
    return pairs.join(n, "left_id").join(m, "right_id").filter("_n = 1 AND _m = 1").select("left_id", "right_id", "rule")


def consolidate(objects: DataFrame, doc: str, page: str) -> DataFrame:
    """Objects of a page merged one by one: exactly one earlier match merges its aliases, several mark the object
    ambiguous, other content keeps both. Order-dependent, hence a kernel per page sorted by sequence and id.

    ``objects`` has object_id, object_type, number, text and sequence; the result adds aliases and state.
    """

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        kept: list[dict] = []
        for r in rows.sort_values(["sequence", "object_id"]).to_dict("records"):
            same = [k for k in kept if k["object_type"] == r["object_type"] and r["number"] and k["number"] == r["number"]]
            if len(same) == 1 and (not r["text"] or not same[0]["text"] or r["text"] == same[0]["text"]):
                same[0]["aliases"] = sorted({*same[0]["aliases"], r["object_id"]})
                same[0]["text"] = same[0]["text"] or r["text"]
            else:
                state = "ambiguous" if len(same) > 1 else "content_conflict" if same else "single"
                kept.append({**r, "aliases": [r["object_id"]], "state": state})
        return pd.DataFrame(kept, columns=[*rows.columns, "aliases", "state"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in objects.schema) + ", aliases array<string>, state string"
    return objects.groupBy(doc, page).applyInPandas(merge, schema)


def evidence_match(rows: DataFrame, objects: DataFrame, row_id: str, doc: str = "doc_id") -> DataFrame:
    """(row_id, object_id, status): rows to objects of their document by exact evidence id, else object id, else number and page.

    Stages are joins on exploded ids; the best stage with one object stands, several objects are ambiguous.
    """
    o = objects.select(doc, "object_id", "evidence_id", "number", F.col("page_number").alias("page"))
    by_evidence = rows.select(F.col(row_id).alias("row_id"), doc, F.explode("evidence_ids").alias("evidence_id")).join(o, [doc, "evidence_id"]).select("row_id", "object_id", F.lit(1).alias("stage"))
    by_object = rows.select(F.col(row_id).alias("row_id"), doc, F.explode("object_ids").alias("object_id")).join(o.select(doc, "object_id"), [doc, "object_id"]).select("row_id", "object_id", F.lit(2).alias("stage"))
    by_number = rows.select(F.col(row_id).alias("row_id"), doc, "number", F.explode("pages").alias("page")).join(o, [doc, "number", "page"]).select("row_id", "object_id", F.lit(3).alias("stage"))
    found = by_evidence.unionByName(by_object).unionByName(by_number)
    first = found.groupBy("row_id").agg(F.min("stage").alias("stage"))
    best = found.join(first, ["row_id", "stage"]).groupBy("row_id", "stage").agg(F.count_distinct("object_id").alias("n"), F.min("object_id").alias("object_id"))
    status = F.when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "ambiguous").when(F.col("stage") == 1, "exact").when(F.col("stage") == 2, "object").otherwise("partial")
    return rows.select(F.col(row_id).alias("row_id")).join(best, "row_id", "left").select("row_id", F.when(F.col("n") == 1, F.col("object_id")).alias("object_id"), status.alias("status"))


#: Words of decorative or referring objects.
NEGATIVE_SIGNALS = ["목차", "행사", "공모전", "모집", "사진", "로고", "위원회 사진", "참고 사례"]
#: Rows and columns from which a table counts as complex.
COMPLEX_ROWS, COMPLEX_COLUMNS = 45, 12


def native_confidence(object_type: Column, text: Column, rows: Column, missing: Column, strategy: Column) -> Column:
    """Confidence DOUBLE that natively read content suffices, by type.

    Text by its length; a table by what is filled, how even its rows are, its cells and its size; charts and figures
    hardly. ``rows`` is ARRAY<ARRAY<STRING>>; null counts as empty, a null ``missing`` or ``strategy`` as not set.
    """
    rows = F.coalesce(rows, F.array().cast("array<array<string>>"))
    widths = F.transform(rows, lambda r: F.size(r))
    n, width = F.size(rows), F.coalesce(F.array_max(widths), F.lit(0))
    cells = F.flatten(rows)
    filled = F.size(F.filter(cells, lambda c: F.coalesce(F.trim(F.regexp_replace(c, r"[\s\p{Z}]+", " ")) != "", F.lit(False))))
    fill = F.coalesce(F.try_divide(filled, F.size(cells)), F.lit(0.0))
    ragged = F.coalesce(F.try_divide(F.size(F.filter(widths, lambda w: w != width)), n), F.lit(1.0))
    less = lambda condition, by: F.when(condition, F.lit(by)).otherwise(F.lit(0.0))
    table = F.lit(0.96) - less(fill < 0.7, 0.3) - less(ragged > 0.25, 0.25) - less(filled < 4, 0.35) - less((n >= COMPLEX_ROWS) | (width >= COMPLEX_COLUMNS), 0.18) - less(F.coalesce(strategy == "text", F.lit(False)), 0.08)
    absent = F.coalesce(missing, F.lit(False)) | (n < 2) | (width < 2)
    length = F.length(F.trim(F.coalesce(text, F.lit(""))))
    score = F.when(object_type == "text", F.when(length >= 80, 0.98).when(length >= 20, 0.78).otherwise(0.25)).when(object_type == "table", F.when(absent, 0.15).otherwise(F.greatest(table, F.lit(0.0)))).when(object_type == "chart", 0.2).when(object_type.isin("figure", "image"), 0.3).otherwise(0.5)
    return F.round(score, 4)


def data_signals(text: Column) -> Column:
    """Names of the strong data signals of a text: years, units, amounts, and words of measure."""
    return F.array_compact(F.array(F.when(text.rlike("(19|20)[0-9]{2}"), F.lit("year")), F.when(text.rlike(r"(?i)(tco2|co2eq|kwh|mwh|백만원|억원|천톤)"), F.lit("unit")), F.when(text.rlike(r"[0-9]{1,3}(,[0-9]{3})+"), F.lit("amount")), F.when(text.rlike("(배출량|감축량|예산|목표|실적)"), F.lit("term"))))


def triage(objects: DataFrame, threshold: float = NATIVE_CONFIDENCE) -> DataFrame:
    """``objects`` with action and final_status.

    They have object_type, confidence, signals (names of strong data signals), negative (names of NEGATIVE_SIGNALS found),
    render_proxy and index_caption BOOLEAN (a caption placeholder on an index page). The first rule that fits decides.
    """
    proxy, listed = F.coalesce("render_proxy", F.lit(False)), F.coalesce("index_caption", F.lit(False))
    kind = F.col("object_type")
    action = F.when(proxy, "transport_only").when(listed, "skip_index_caption").when(kind == "text", "native_keep").when(kind == "table", F.when(F.col("confidence") < threshold, "ocr_required").otherwise("native_keep")).when(kind == "chart", "ocr_required").when(kind.isin("figure", "image"), F.when(F.size("signals") > 0, "ocr_required").otherwise("skip_non_data")).when(F.size("negative") > 0, "skip_non_data").otherwise("native_keep")
    status = F.when(F.col("action") == "native_keep", "extracted").when(F.col("action") == "ocr_required", "needs_review").otherwise("not_relevant")
    return objects.withColumn("action", action).withColumn("final_status", status)


def fill_from_reading(native: DataFrame, reading: DataFrame, key: list[str]) -> DataFrame:
    """Cells of a native table completed by a second reading of the same (key, row label, header): filled, conflict, kept or added."""
    n = native.select(*key, "label", "header", F.col("value").alias("_n"))
    r = reading.select(*key, "label", "header", F.col("value").alias("_r"))
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    state = F.when(blank(F.col("_n")) & ~blank(F.col("_r")), "filled").when(~blank(F.col("_n")) & ~blank(F.col("_r")) & (F.col("_n") != F.col("_r")), "conflict").otherwise("kept")
    both = n.join(r, [*key, "label", "header"], "full_outer")
    return both.select(*key, "label", "header", F.when(blank(F.col("_n")), F.col("_r")).otherwise(F.col("_n")).alias("value"), state.alias("state"))
