"""Cross-sheet guards: rows that break a contract go to quarantine with their reasons."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factsieve.functions.numbers import same_number
from factsieve.functions.text import alnum_fold, is_blank


def quarantine(df: DataFrame, reasons: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected): rejected rows carry the array _reasons of every reason that holds."""
    found = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(r)) for r, c in reasons.items()]))
    marked = df.withColumn("_reasons", found)
    return marked.filter(F.size("_reasons") == 0).drop("_reasons"), marked.filter(F.size("_reasons") > 0)


def summarize(rejected: DataFrame, sheet: str) -> DataFrame:
    """(sheet, reason, n) with the totals of both: a cube."""
    return rejected.select(F.col(sheet).alias("sheet"), F.explode("_reasons").alias("reason")).cube("sheet", "reason").agg(F.count("*").alias("n"))


def target_reasons(sector: str = "부문", quantities: tuple[str, ...] = ("목표감축량", "목표배출량")) -> dict[str, Column]:
    """Reasons of the reduction-target guard that need one row only."""
    none = reduce(lambda a, b: a & b, [F.col(q).isNull() for q in quantities])
    return {"no_target_quantity": none, "visual_metric_label_as_sector": F.col(sector).rlike("배출량|감축량|비율|증감|%")}


def duplicated_elsewhere(rows: DataFrame, other: DataFrame, equal: list[tuple[str, str]], numbers: tuple[str, str], row_id: str, residual: Column | None = None, others: tuple[str, ...] = ()) -> DataFrame:
    """Ids of ``rows`` that have a counterpart in ``other``: equal in the column pairs and in a number to half a percent,
    and as ``residual`` says, in which the columns ``others`` of the other side are written _r_NAME.

    A semi join. The number joins by equality on logarithmic buckets one percent wide and their neighbours, so equal
    keys don't bring all their rows together; the exact comparison follows. Numbers of any sign and zero take part.
    """
    step = 0.01

    def bucket(x: Column) -> Column:
        return F.when(F.abs(x) < 1, F.lit(0)).otherwise(F.signum(x) * (F.floor(F.log(F.abs(x)) / step) + 1)).cast("bigint")

    x, y = numbers
    a = rows.filter(F.col(x).isNotNull()).withColumn("_b", F.explode(F.array(*[bucket(F.col(x)) + i for i in (-1, 0, 1)])))
    b = other.filter(F.col(y).isNotNull()).select(*[F.col(o).alias(f"_o_{o}") for _, o in equal], F.col(y).cast("double").alias("_o_number"), bucket(F.col(y)).alias("_b2"), *[F.col(c).alias(f"_r_{c}") for c in others])
    on = (F.col("_b") == F.col("_b2")) & same_number(F.col(x), F.col("_o_number"))
    for l, o in equal:  # noqa: E741
        on = on & (F.col(l) == F.col(f"_o_{o}"))
    if residual is not None:
        on = on & residual
    return a.join(b, on, "left_semi").select(row_id).distinct()


def containment_quarantine(df: DataFrame, group: list[str], text: str, quantity: str | None, row_id: str, least: int = 8) -> DataFrame:
    """(row_id, kept_id): rows whose folded text (of ``least`` characters or more) stands in a longer one of their group; of
    equal texts the later goes. Where either has a quantity, they must agree to half a percent.

    Sequential by contract (a removed row removes no other), hence a kernel per group; groups are the plans of one
    project and year. Exact repetitions are reduced before it, so a group of copies doesn't gather in one task.
    """
    q = F.col(quantity).cast("double") if quantity else F.lit(None).cast("double")
    base = df.select(*group, F.col(row_id).alias("row_id"), alnum_fold(F.col(text)).alias("t"), q.alias("q")).filter(F.length("t") >= least)
    firsts = base.groupBy(*group, "t", "q").agg(F.min("row_id").alias("first_id"))
    on = reduce(lambda a, b: a & b, [base[c].eqNullSafe(firsts[c]) for c in (*group, "t", "q")])
    copies = base.join(firsts, on).filter("row_id != first_id").select("row_id", F.col("first_id").alias("kept_id"))

    def contain(rows: pd.DataFrame) -> pd.DataFrame:
        items = sorted(rows[["first_id", "t", "q"]].itertuples(index=False, name=None), key=lambda r: (-len(r[1]), r[0]))
        kept, out = [], []
        for i, t, v in items:
            for j, u, w in kept:
                agree = (pd.isna(v) and pd.isna(w)) or (not pd.isna(v) and not pd.isna(w) and abs(v - w) <= 0.005 * max(abs(v), abs(w), 1))
                if agree and t in u:
                    out.append((i, j))
                    break
            else:
                kept.append((i, t, v))
        return pd.DataFrame(out, columns=["row_id", "kept_id"])

    crowded = firsts.groupBy(*[F.col(g).alias(f"_s_{g}") for g in group]).agg(F.count("*").alias("_n")).filter("_n > 1")
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_s_{g}")) for g in group])
    near = firsts.join(crowded, same, "left_semi").groupBy(*group).applyInPandas(contain, "row_id bigint, kept_id bigint")
    return copies.unionByName(near)


def strongest_heading(df: DataFrame, identity: list[str], strength: str) -> DataFrame:
    """Rows weaker than the strongest of their identity, which only echo its heading; the maximum is aggregated, not windowed."""
    top = df.groupBy(*identity).agg(F.max(strength).alias("_top"))
    return df.join(top, identity).filter(F.col(strength) < F.col("_top")).drop("_top")


def year_bounds(df: DataFrame, year: str, first: int = 1990, last: int = 2060, end: str | None = None) -> Column:
    """Whether a year lies outside the guard's bounds, the later of ``last`` and twenty years after the plan's end."""
    top = F.greatest(F.lit(last), F.col(end) + 20) if end else F.lit(last)
    return ~F.col(year).between(F.lit(first), top)


def reclassify(df: DataFrame, grounded: Column, future: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(stay, move, hold): rows about the future move to the forecast where a scenario is grounded and are held otherwise."""
    f, g = F.coalesce(future, F.lit(False)), F.coalesce(grounded, F.lit(False))
    return df.filter(~f), df.filter(f & g), df.filter(f & ~g)


def first_failing(checks: list[tuple[str, Column]]) -> Column:
    """Name of the first check that fails, null where all hold; a null check fails."""
    out = F.lit(None).cast("string")
    for name, ok in reversed(checks):
        out = F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)).otherwise(out)
    return out


def validate_responses(targets: DataFrame, responses: DataFrame) -> DataFrame:
    """(candidate_id, status, reason) of every target: "validated_reading", or "held" for the first reason that applies.

    ``targets`` has candidate_id, name, year, funding, page, object_id, evidence_ids, value DECIMAL and unit; ``responses``
    candidate_id, status, name, year, funding, page, object_id, evidence_id, amount, unit and quote. A target has no
    response, or several that differ, or its one response is checked in order; the quote must hold the amount as a number
    of its own. Texts compare without case and white space; equal responses count once.
    """
    from factsieve.functions.numbers import strict_decimal
    from factsieve.operators.coverage import dimension, factor

    fields = [c for c in responses.columns if c != "candidate_id"]
    given = responses.groupBy("candidate_id").agg(F.count_distinct(F.to_json(F.struct(*fields))).alias("_n"), F.first(F.struct(*fields)).alias("r"))
    both = targets.join(given, "candidate_id", "left")
    label = lambda c: F.coalesce(F.regexp_replace(F.lower(c), r"[\s\p{Z}]+", ""), F.lit(""))
    total = lambda c: F.when(label(c).isin("계", "총계"), "합계").otherwise(label(c))
    amount = strict_decimal(F.col("r.amount"))
    digits = F.regexp_replace(F.regexp_replace(amount.cast("string"), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    quoted = F.rlike(F.regexp_replace("r.quote", ",", ""), F.concat(F.lit(r"(?<![0-9.])"), F.regexp_replace(digits, r"([.+-])", r"\\$1"), F.lit(r"(?![0-9.])")))
    checks = [
        ("not_returned", F.col("_n").isNotNull()),
        ("conflicting_duplicate_response", F.col("_n") == 1),
        ("model_status", F.col("r.status") == "read"),
        ("business_mismatch", label(F.col("r.name")) == label(F.col("name"))),
        ("year_mismatch", F.col("r.year") == F.col("year")),
        ("funding_mismatch", total(F.col("r.funding")) == total(F.col("funding"))),
        ("page_mismatch", F.col("r.page") == F.col("page")),
        ("evidence_mismatch", (F.col("r.object_id") == F.col("object_id")) & F.array_contains("evidence_ids", F.col("r.evidence_id"))),
        ("invalid_amount", amount.isNotNull()),
        ("unit_or_scale_mismatch", ~is_blank(F.col("r.unit")) & (dimension(F.col("r.unit")) == dimension(F.col("unit"))) & (factor(F.col("r.unit")) == factor(F.col("unit")))),
        ("source_value_conflict", amount == F.col("value")),
        ("amount_quote_missing", quoted),
    ]
    failing = first_failing(checks)
    reason = F.when(failing == "model_status", F.concat(F.lit("model_"), F.coalesce("r.status", F.lit("unknown")))).otherwise(F.coalesce(failing, F.lit("source_fact_and_review_agree")))
    return both.select("candidate_id", F.when(failing.isNull(), "validated_reading").otherwise("held").alias("status"), reason.alias("reason"))
