"""Best representative of each duplicate group by a latent model of two-sided source quality (problem 5)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factsieve.functions.joins import skew_safe_join
from factsieve.functions.storage import materialize

#: Sources are bits of an integer; a fact's pattern is the pair (asserting sources, covering sources), so a field has at
#: most 3 ** MAX_SOURCES patterns whatever the number of facts. Sources beyond share the last bit, hence one quality.
MAX_SOURCES = 10
#: Weight of the priors, as a share of the facts.
PRIOR_SHARE = 0.002
#: Texts that stand for an absent value.
PLACEHOLDERS = ["", "-", "—", "미정", "없음", "n/a"]


def present(col: Column) -> Column:
    """The trimmed text, null where it is blank or a placeholder."""
    text = F.trim(F.regexp_replace(col, r"[\s\p{Z}]+", " "))
    return F.when(~F.lower(text).isin(PLACEHOLDERS), text)


def infer_truth(patterns: list[tuple[int, int, int]], n_sources: int, rounds: int = 50, false_prior: tuple[float, float] = (1.0, 99.0), true_prior: tuple[float, float] = (2.0, 2.0)) -> tuple[dict[tuple[int, int], float], np.ndarray, np.ndarray]:
    """Expectation-maximisation over counted patterns (assert mask, cover mask, count).

    Returns the posterior truth of each pattern, and each source's sensitivity and specificity. The E step gives the
    posterior of every pattern from the current qualities, the M step re-estimates the qualities from all of them,
    with Beta priors of PRIOR_SHARE of the facts: sources seldom invent values but often leave some out. A pattern
    stands for all of its facts, so this equals the estimation over every single fact. A value is judged false where the
    sources that are silent about it would most likely have named it, and the ones that name it have been found to invent.
    """
    if not patterns:
        return {}, np.full(n_sources, 0.5), np.full(n_sources, 0.99)
    bits = 1 << np.arange(n_sources)
    asserted = np.array([[bool(a & b) for b in bits] for a, _, _ in patterns], dtype=float)
    covered = np.array([[bool(c & b) for b in bits] for _, c, _ in patterns], dtype=float)
    denied = covered * (1 - asserted)
    counts = np.array([n for *_, n in patterns], dtype=float)
    strength = max(1.0, counts.sum() * PRIOR_SHARE)
    sensitivity, fallout, prior = np.full(n_sources, 0.5), np.full(n_sources, false_prior[0] / sum(false_prior)), 0.5
    for _ in range(rounds):
        yes = np.log(prior) + asserted @ np.log(sensitivity) + denied @ np.log1p(-sensitivity)
        no = np.log1p(-prior) + asserted @ np.log(fallout) + denied @ np.log1p(-fallout)
        truth = 1 / (1 + np.exp(np.clip(no - yes, -500, 500)))
        t, f = counts * truth, counts * (1 - truth)
        sensitivity = (t @ asserted + true_prior[0] * strength) / (t @ covered + sum(true_prior) * strength)
        fallout = (f @ asserted + false_prior[0] * strength) / (f @ covered + sum(false_prior) * strength)
        prior = float(np.clip((t.sum() + strength) / (counts.sum() + 2 * strength), 1e-6, 1 - 1e-6))
    return {(a, c): float(p) for (a, c, _), p in zip(patterns, truth)}, sensitivity, 1 - fallout


def survivors(keyed: DataFrame, fields: dict[str, str], threshold: float = 0.5) -> tuple[DataFrame, DataFrame, DataFrame, dict[str, tuple[np.ndarray, np.ndarray]]]:
    """Members of groups with several rows, and the number of values of each field judged true in each of them.

    ``keyed`` has key, row_id, bit (number of the source; those from MAX_SOURCES on count as the last) and, for each
    entry of ``fields``, an array column of the values the row claims (empty or null: none). Returns (groups: key, n,
    first_row_id; members: the columns of ``keyed`` with one INT column named by ``fields`` each; values: key, field,
    value, n_claims, truth, judged; qualities per field). A source covers a field's facts in a group if any of its rows
    there claims a value of that field. Every value whose posterior reaches ``threshold`` is kept, so a field may keep
    several. Null keys belong to no group.
    """
    spark = keyed.sparkSession
    keyed = keyed.withColumn("bit", F.least("bit", F.lit(MAX_SOURCES - 1)))
    covers = [F.bit_or(F.when(F.size(F.coalesce(F.col(c), F.array().cast("array<string>"))) > 0, F.call_function("shiftleft", F.lit(1), F.col("bit"))).otherwise(0)).alias(f"_cover_{c}") for c in fields]
    groups = keyed.filter(F.col("key").isNotNull()).groupBy("key").agg(F.count("*").alias("n"), F.min("row_id").alias("first_row_id"), *covers).filter("n > 1")
    members = materialize(skew_safe_join(keyed, groups, "key", "n"), "members")
    claims = None
    for i, c in enumerate(fields):
        part = members.select("key", "row_id", "bit", F.lit(i).alias("field"), F.col(f"_cover_{c}").alias("cover"), F.explode(F.array_distinct(c)).alias("value"))
        claims = part if claims is None else claims.unionByName(part)
    claims = claims.select("key", "row_id", "bit", "field", "cover", "value", F.xxhash64("key", "field", "value").alias("fact"), F.xxhash64("value", "key").alias("_check"))
    facts = claims.groupBy("fact", "_check", "field").agg(F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("bit"))).alias("asserted"), F.max("cover").alias("cover"), F.count("*").alias("n_claims"), F.first("key").alias("key"), F.first("value").alias("value"))
    facts = materialize(facts, "facts")
    counted = facts.groupBy("field", "asserted", "cover").count().collect()  # at most len(fields) * 3 ** MAX_SOURCES rows
    truths, qualities = [], {}
    for i, c in enumerate(fields):
        posterior, sensitivity, specificity = infer_truth([(r["asserted"], r["cover"], r["count"]) for r in counted if r["field"] == i], MAX_SOURCES)
        qualities[c] = (sensitivity, specificity)
        truths += [(i, c, a, v, p, p >= threshold) for (a, v), p in posterior.items()]
    verdicts = F.broadcast(spark.createDataFrame(truths, "field INT, name STRING, asserted INT, cover INT, truth DOUBLE, judged BOOLEAN"))
    decided = facts.join(verdicts, ["field", "asserted", "cover"])
    # Only values judged false, few by nature, are taken back from the rows that claim them.
    false = decided.filter("NOT judged").select("fact", "n_claims")
    doubted = skew_safe_join(claims.select("row_id", "field", "fact"), false, "fact", "n_claims")
    per_row = doubted.groupBy("row_id").agg(*[F.count_if(F.col("field") == i).cast("int").alias(f"_false_{i}") for i in range(len(fields))])
    per_row = per_row.withColumnRenamed("row_id", "_r")
    joined = members.join(per_row, F.col("row_id") == F.col("_r"), "left")
    claimed = {name: (F.greatest(F.size(F.array_distinct(F.coalesce(F.col(c), F.array().cast("array<string>")))), F.lit(0)) - F.coalesce(f"_false_{i}", F.lit(0))).cast("int").alias(name) for i, (c, name) in enumerate(fields.items())}
    out = joined.select("key", "row_id", "bit", *[c for c in keyed.columns if c not in ("key", "row_id", "bit", *fields)], *claimed.values())
    return groups.select("key", "n", "first_row_id"), out, decided.select("key", F.col("name").alias("field"), "value", "n_claims", "truth", "judged"), qualities


def pick(condition: Column, order: list[Column], row_id: str = "row_id") -> Column:
    """Aggregate: the row id first in ``order`` among the rows that satisfy ``condition``, -1 where none does."""
    return F.coalesce(F.max_by(F.when(condition, F.col(row_id)), F.when(condition, F.struct(*order, (-F.col(row_id)).alias("_tie")))), F.lit(-1).cast("bigint"))
