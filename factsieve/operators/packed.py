"""Several values packed in one field: infer the delimiters of each source, then split and explode with position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factsieve.functions.joins import skew_safe_join

#: Candidate delimiters as Java patterns, each a character class or word that can't be part of a number.
CANDIDATES = {"comma": ",", "semicolon": ";", "slash": "/", "bar": r"\|", "middle_dot": "[·ㆍ‧・]", "ideographic": "、", "newline": r"\n", "and": r"(?<=[0-9년쪽\s])(?:및|and|&)(?=[\s0-9])"}
#: Pages of a span that one generated row holds at first; longer spans go through several.
SPAN_CHUNK = 4096
#: Two runs of digits: only such a text can hold several values.
SEVERAL = r"[0-9][^0-9]+[0-9]"
SPAN = r"^([0-9]{1,18})\s*[-‐‑‒–—~∼～〜]\s*([0-9]{1,18})$"


def _strip_notation(text: Column, kind: str) -> Column:
    """Drop list brackets, remarks and the words that go with a value, and leave values, delimiters and double quotes."""
    out = F.regexp_replace(F.regexp_replace(text, "\\r\\n?", "\n"), "[“”]", '"')
    # Quotes around the whole field are no part of it.
    out = F.regexp_replace(out, r'^\s*"([^"]*)"\s*$', "$1")
    if kind == "page":
        out = F.regexp_replace(out, r"(?i)(?:표|그림|부록|table|figure|fig\.)\s*[0-9]+(?:\s*[-.–]\s*[0-9]+)*", "")
        out = F.regexp_replace(out, r"(?i)\bpp?\s*\.?\s*(?=[0-9])|쪽|페이지|면", "")
        return F.regexp_replace(out, r"[\[\]'()]", " ")
    out = F.regexp_replace(out, r"\([^()0-9]*\)", "")
    out = F.regexp_replace(out, r"(?<![0-9])['’‘＇´`]\s*([0-9]{2})(?![0-9])", "20$1")
    return F.regexp_replace(F.regexp_replace(out, "년도?", ""), r"[\[\]']", " ")


def _split(text: Column, pattern: Column) -> Column:
    """Pieces of a text between delimiters that stand outside double quotes, without their quotes; blank ones are left out."""
    outside = F.concat(F.lit("(?:"), pattern, F.lit(r')(?=(?:[^"]*"[^"]*")*[^"]*$)'))
    marked = F.when(F.contains(text, F.lit('"')), F.regexp_replace(text, outside, F.lit("\u0001"))).otherwise(F.regexp_replace(text, pattern, F.lit("\u0001")))
    pieces = F.transform(F.split(marked, "\u0001"), lambda p: F.trim(F.regexp_replace(p, r'["\s\p{Z}]+', " ")))
    return F.filter(pieces, lambda p: p != "")


def _regular(piece: Column, kind: str) -> Column:
    """Whether a piece is one value of its kind: a year of four digits, or a page or span of pages."""
    return piece.rlike(r"^[12][0-9]{3}$") if kind == "year" else piece.rlike(r"^[0-9]{1,18}$") | piece.rlike(SPAN)


def delimiter_scores(df: DataFrame, text_col: str, source_col: str, kind: str) -> DataFrame:
    """Score each candidate delimiter for each source: (source, delimiter, n_rows, regularity, consistency, score).

    Regularity is the share of pieces that are values of the expected type once the other candidates are split too;
    consistency is the share of the rows with the delimiter in which every piece is regular, so that their number of
    pieces means a number of values. A single aggregation with map-side combine; its result has
    |sources| x |candidates| rows.
    """
    text = _strip_notation(F.col(text_col), kind)
    any_delim = "|".join(CANDIDATES.values())
    pieces = _split(text, F.lit(any_delim))
    base = df.filter(F.col(text_col).rlike(SEVERAL)).select(F.col(source_col).alias("source"), text.alias("_t"), pieces.alias("_p"))
    good = F.size(F.filter("_p", lambda p: _regular(p, kind)))
    base = base.withColumn("_n", F.size("_p")).withColumn("_g", good)
    aggs = []
    for name, pattern in CANDIDATES.items():
        has = F.col("_t").rlike(pattern)
        aggs += [F.sum(F.when(has, 1).otherwise(0)).alias(f"n_{name}"), F.sum(F.when(has, F.col("_n")).otherwise(0)).alias(f"p_{name}"), F.sum(F.when(has, F.col("_g")).otherwise(0)).alias(f"g_{name}"), F.sum(F.when(has & (F.col("_n") == F.col("_g")) & (F.col("_n") > 1), 1).otherwise(0)).alias(f"c_{name}")]
    wide = base.groupBy("source").agg(*aggs)
    rows = F.array(*[F.struct(F.lit(n).alias("delimiter"), F.col(f"n_{n}").alias("n_rows"), F.try_divide(F.col(f"g_{n}"), F.col(f"p_{n}")).alias("regularity"), F.try_divide(F.col(f"c_{n}"), F.col(f"n_{n}")).alias("consistency")) for n in CANDIDATES])
    out = wide.select("source", F.inline(rows)).filter("n_rows > 0")
    return out.withColumn("score", F.coalesce(F.col("regularity"), F.lit(0.0)) * F.coalesce(F.col("consistency"), F.lit(0.0)))


def _pieces(df: DataFrame, id_col: str, text_col: str, source_col: str, kind: str, accept: float) -> DataFrame:
    """(id, source, raw, pieces): the texts that hold a digit, cut at the delimiters of their source."""
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"), F.col(text_col).cast("string").alias("raw")).filter(F.col("raw").rlike("[0-9]"))
    scores = delimiter_scores(rows, "raw", "source", kind)
    patterns = F.create_map(*[F.lit(x) for pair in CANDIDATES.items() for x in pair])
    overall = scores.groupBy("delimiter").agg((F.sum(F.col("score") * F.col("n_rows")) / F.sum("n_rows")).alias("s")).agg(F.collect_set(F.when(F.col("s") >= accept, F.col("delimiter"))).alias("_all"))
    own = scores.groupBy("source").agg(F.collect_set(F.when(F.col("score") >= accept, F.col("delimiter"))).alias("_own"), F.collect_set("delimiter").alias("_met"), F.sum("n_rows").alias("_weight"))
    names = F.array_sort(F.array_union("_own", F.array_except("_all", "_met")))
    pattern = F.coalesce(F.nullif(F.array_join(F.transform(names, lambda n: F.element_at(patterns, n)), "|"), F.lit("")), F.lit("(?!)"))
    accepted = own.join(F.broadcast(overall)).select("source", "_weight", pattern.alias("_pattern"))  # overall is one row
    several = rows.filter(F.col("raw").rlike(SEVERAL))
    cut = skew_safe_join(several, accepted, "source", "_weight", how="left").select("id", "source", "raw", _split(_strip_notation(F.col("raw"), kind), F.coalesce("_pattern", F.lit("(?!)"))).alias("pieces"))
    alone = rows.filter(~F.col("raw").rlike(SEVERAL)).select("id", "source", "raw", _split(_strip_notation(F.col("raw"), kind), F.lit(r"[,;/\n]")).alias("pieces"))
    return cut.unionByName(alone)


def split_packed(df: DataFrame, id_col: str, text_col: str, source_col: str, kind: str = "page", accept: float = 0.5) -> DataFrame:
    """One row per value: (id, source, pos BIGINT from 1 as written, val BIGINT, n_values BIGINT).

    ``kind`` is "page" (a span stands for every page in it; numbers of tables and figures are no pages) or "year" (four
    digits; an apostrophe and two digits mean 20xx). A delimiter is accepted for a source when it scores at least
    ``accept`` there; a source in which it never stands takes over what all sources together say. Delimiters within double
    quotes don't split. Every piece must be one value of its kind, else the text gives no value but stands in
    ``rejected``. Null, blank and digit-free texts give no row; repeated values stay; a span running backwards gives its
    two ends; repeated input rows each give their values; a null source is a source of its own; other columns of ``df``
    are ignored.
    """
    good = _pieces(df, id_col, text_col, source_col, kind, accept).filter((F.size("pieces") > 0) & F.forall("pieces", lambda p: _regular(p, kind)))

    def ends(piece: Column) -> Column:
        span = piece.rlike(SPAN)
        lo = F.when(span, F.regexp_extract(piece, SPAN, 1)).otherwise(piece).try_cast("bigint")
        hi = F.when(span, F.regexp_extract(piece, SPAN, 2)).otherwise(piece).try_cast("bigint")
        one = lambda a, b: F.struct(a.alias("lo"), b.alias("hi"))
        return F.when(hi >= lo, F.array(one(lo, hi))).otherwise(F.array(one(lo, lo), one(hi, hi)))

    spans = good.select("id", "source", F.flatten(F.transform("pieces", ends)).alias("_s"))
    zero = F.lit(0).cast("bigint")
    sized = spans.withColumn("n_values", F.aggregate("_s", zero, lambda n, x: n + x["hi"] - x["lo"] + 1))
    # Values before each span: its number where all are single values, else a running sum.
    before = F.when(F.col("n_values") == F.size("_s"), F.sequence(zero, F.size("_s").cast("bigint"))).otherwise(F.aggregate("_s", F.array(zero), lambda seen, x: F.concat(seen, F.array(F.element_at(seen, -1) + x["hi"] - x["lo"] + 1))))
    each = sized.select("id", "source", "n_values", F.explode(F.arrays_zip("_s", F.slice(before, 1, F.size("_s")).alias("_b"))).alias("_x")).select("id", "source", "n_values", "_x._s.lo", "_x._s.hi", "_x._b")
    parts = each.withColumn("_c", F.explode(F.sequence(zero, F.floor((F.col("hi") - F.col("lo")) / SPAN_CHUNK)))).withColumn("_from", F.col("lo") + F.col("_c") * SPAN_CHUNK)
    out = parts.withColumn("val", F.explode(F.sequence(F.col("_from"), F.least(F.col("hi"), F.col("_from") + SPAN_CHUNK - 1))))
    return out.select("id", "source", (F.col("_b") + F.col("val") - F.col("lo") + 1).alias("pos"), "val", "n_values")


def rejected(df: DataFrame, id_col: str, text_col: str, source_col: str, kind: str = "page", accept: float = 0.5) -> DataFrame:
    """(id, source, raw, piece): texts with a digit that hold no value or a piece that is none, with the first such piece."""
    bad = F.filter("pieces", lambda p: ~_regular(p, kind))
    return _pieces(df, id_col, text_col, source_col, kind, accept).filter((F.size("pieces") == 0) | (F.size(bad) > 0)).select("id", "source", "raw", F.get(bad, 0).alias("piece"))


def source_class(col: Column) -> Column:
    """The name of a source without case and separators."""
    return F.regexp_replace(F.lower(F.coalesce(col, F.lit(""))), r"[\s\p{Z}_-]+", "")
