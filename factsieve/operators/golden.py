"""Golden matching: strict, relaxed, similarity and graph tiers, and the tallies over matches."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factsieve.functions.joins import broadcast_if_small
from factsieve.functions.storage import materialize

TOKEN_JACCARD, BIGRAM_JACCARD, OBSERVE_JACCARD = 0.6, 0.3, 0.2


def strict_fifo(golden: DataFrame, output: DataFrame, keys: list[str], order: str) -> DataFrame:
    """(g_row, o_row): the n-th golden row of a key meets its n-th output row; null keys match nothing.

    First in, first out along equal keys is a join on (key, number within the key).
    """
    number = lambda df: df.dropna(subset=keys).withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))
    g = number(golden).select(*keys, "_n", F.col(order).alias("g_row"))
    o = number(output).select(*keys, "_n", F.col(order).alias("o_row"))
    return g.join(o, [*keys, "_n"]).select("g_row", "o_row")


def relaxed_kernel(golden: DataFrame, output: DataFrame, keys: list[str], veto: str, order: str) -> DataFrame:
    """(g_row, o_row) within each key: each golden row in order takes the first output row left whose ``veto`` field is
    compatible; candidates that it passes over are spent. Order-dependent by contract, hence a grouped kernel."""
    g = golden.select(*keys, F.col(order).alias("row"), F.col(veto).cast("string").alias("veto"), F.lit("g").alias("side"))
    o = output.select(*keys, F.col(order).alias("row"), F.col(veto).cast("string").alias("veto"), F.lit("o").alias("side"))

    def match(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row")
        queue = list(rows[rows["side"] == "o"][["row", "veto"]].itertuples(index=False, name=None))
        out = []
        for row, value in rows[rows["side"] == "g"][["row", "veto"]].itertuples(index=False, name=None):
            while queue:
                other, found = queue.pop(0)
                if not value or not found or value == found:
                    out.append((row, other))
                    break
        return pd.DataFrame(out, columns=["g_row", "o_row"])

    shared = golden.select(*keys).distinct().join(output.select(*keys).distinct(), keys)
    return g.unionByName(o).join(shared, keys, "left_semi").groupBy(*keys).applyInPandas(match, "g_row bigint, o_row bigint")


@dataclass(frozen=True)
class SimilarSets:
    """Similar values of two tables: (g_set, g_n, o_set, o_n, similarity) with the rows of each value counted in g_n and o_n, and which rows hold a value: (g_row, g_set), (o_row, o_set)."""

    pairs: DataFrame
    g_rows: DataFrame
    o_rows: DataFrame


def similar_sets(golden: DataFrame, output: DataFrame, partition: list[str], items: str, least: float, order: str, split: Callable[[Column], Column] | None = None) -> SimilarSets:
    """Pairs of the distinct values of a partition whose item sets, made of the column ``items`` by ``split``, reach a Jaccard similarity of ``least``.

    Each value is compared once, however many rows hold it. Prefix filtering: with items in rare-first order, two sets of
    that similarity share an item among their first n - ceil(least * n) + 1; so only those prefixes are joined, and a
    frequent item brings few pairs together. The rarest shared item stands in both prefixes, so a pair is taken there alone
    and nothing but true pairs leaves the join.
    """
    spark = golden.sparkSession
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = lambda df: df.select(*partition, F.col(order).alias("row"), F.col(items).alias("value")).filter(F.col("value").isNotNull())
    numbered = lambda df: materialize(df.groupBy(*partition, "value").agg(F.count("*").alias("n")).withColumn("set", F.monotonically_increasing_id()), "values")
    g, o = base(golden), base(output)
    g_values, o_values = numbered(g), numbered(o)
    members = lambda values: materialize(values.select("set", F.explode(F.array_distinct(split(F.col("value")) if split else F.col("value"))).alias("item")), "members")
    g_members, o_members = members(g_values), members(o_values)
    # Numbers that rise with the sorted order stand for the items, so sorted numbers are items from the rarest on.
    frequency = g_members.unionByName(o_members).groupBy("item").agg(F.count("*").alias("f"))
    codes = materialize(frequency.orderBy("f", "item").select("item", F.monotonically_increasing_id().alias("code")), "codes")

    def coded(values: DataFrame, members: DataFrame, side: str) -> DataFrame:
        sets = members.join(codes, "item").groupBy("set").agg(F.array_sort(F.collect_list("code")).alias("items"))
        sets = sets.join(values.select(*partition, "set", "n"), "set").select(*partition, F.col("set").alias(f"{side}_set"), F.col("n").alias(f"{side}_n"), F.col("items").alias(f"_{side}"))
        # Small files are read by few tasks, so the sets are spread again for the join.
        return materialize(sets, "sets").repartition(spread, f"{side}_set")

    def prefixes(sets: DataFrame, side: str) -> DataFrame:
        n = F.size(f"_{side}")
        return sets.withColumn("code", F.explode(F.slice(f"_{side}", F.lit(1), (n - F.ceil(n * least - 1e-9) + 1).cast("int"))))

    a, b = prefixes(coded(g_values, g_members, "g"), "g"), prefixes(coded(o_values, o_members, "o"), "o")
    shared, total = F.array_intersect("_g", "_o"), F.size("_g") + F.size("_o")
    # The bound that costs one look at a candidate comes first; what is left is held to the exact one.
    likely = F.size(shared) >= total * (least / (1 + least)) - 1e-6
    similarity = F.size(shared).cast("double") / (total - F.size(shared)).cast("double")
    pairs = b.join(broadcast_if_small(a, 20_000), [*partition, "code"]).filter(likely).filter((F.get(shared, F.lit(0)) == F.col("code")) & (similarity >= least))
    pairs = materialize(pairs.select("g_set", "g_n", "o_set", "o_n", similarity.alias("similarity")), "pairs")
    rows = lambda df, values, side: df.join(values, [*partition, "value"]).select(F.col("row").alias(f"{side}_row"), F.col("set").alias(f"{side}_set"))
    return SimilarSets(pairs, rows(g, g_values, "g"), rows(o, o_values, "o"))


def similar_pairs(golden: DataFrame, output: DataFrame, partition: list[str], items: str, least: float, order: str, split: Callable[[Column], Column] | None = None) -> DataFrame:
    """(g_row, o_row, similarity): pairs of rows of a partition whose item sets reach a Jaccard similarity of ``least``."""
    found = similar_sets(golden, output, partition, items, least, order, split)
    spread = int(golden.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Rows multiply in the last join only; what goes into it is small but spread over all tasks.
    half = found.o_rows.join(found.pairs.select("g_set", "o_set", "similarity"), "o_set").select("g_set", "o_row", "similarity").repartition(spread, "g_set", "o_row")
    return half.join(broadcast_if_small(materialize(found.g_rows, "rows")), "g_set").select("g_row", "o_row", "similarity")


def mutual_best(found: SimilarSets) -> DataFrame:
    """(g_row, o_row, similarity): pairs that are the single best of both their rows; ties on either side are left out.

    Bests and ties are found among the values by the number of their rows; pairs of rows are never listed.
    """

    def best(rows: DataFrame, side: str, other: str) -> DataFrame:
        at = found.pairs.groupBy(f"{side}_set", "similarity").agg(F.sum(f"{other}_n").alias("_n"))
        top = at.groupBy(f"{side}_set").agg(F.max(F.struct("similarity", "_n")).alias("_b"))
        # A row number that stands on several rows has the best of them all.
        at = rows.join(top, f"{side}_set").groupBy(f"{side}_row", "_b.similarity").agg(F.sum("_b._n").alias("_n"), F.min(f"{side}_set").alias("_s"))
        return at.groupBy(f"{side}_row").agg(F.max(F.struct("similarity", "_n", "_s")).alias("_b")).filter("_b._n = 1").select(f"{side}_row", F.col("_b._s").alias(f"{side}_set"), F.col("_b.similarity").alias("similarity"))

    both = found.pairs.join(best(found.g_rows, "g", "o"), ["g_set", "similarity"]).join(best(found.o_rows, "o", "g"), ["o_set", "similarity"])
    return both.select("g_row", "o_row", "similarity")


def greedy_assignment(pairs: DataFrame, partition: str) -> DataFrame:
    """One-to-one assignment by falling similarity, ties by row numbers; a kernel per partition (a sheet of one document)."""

    def assign(rows: pd.DataFrame) -> pd.DataFrame:
        used_g, used_o, out = set(), set(), []
        for r in rows.sort_values(["similarity", "g_row", "o_row"], ascending=[False, True, True]).itertuples():
            if r.g_row not in used_g and r.o_row not in used_o:
                used_g.add(r.g_row)
                used_o.add(r.o_row)
                out.append((r.g_row, r.o_row, r.similarity))
        return pd.DataFrame(out, columns=["g_row", "o_row", "similarity"])

    return pairs.groupBy(partition).applyInPandas(assign, "g_row bigint, o_row bigint, similarity double")


def unique_graph(golden: DataFrame, output: DataFrame, anchor: list[str], compatible: list[str], payload: list[str], order: str) -> DataFrame:
    """(g_row, o_row, status): order-free matching. Edges join rows equal in ``anchor`` whose ``compatible`` fields don't
    contradict; a golden row is matched if all its candidates have one payload and each is the candidate of no other golden
    row (the lowest row stands), ambiguous if it has candidates otherwise, missing if none."""
    g = golden.select(*[F.col(c).alias(f"_g_{c}") for c in {*anchor, *compatible}], F.col(order).alias("g_row"))
    o = output.select(*[F.col(c).alias(f"_o_{c}") for c in {*anchor, *compatible}], F.col(order).alias("o_row"), F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in payload]).alias("_p"))
    filled = lambda c: c.isNotNull() & (c.cast("string") != "")
    on = reduce(lambda a, b: a & b, [F.col(f"_g_{c}") == F.col(f"_o_{c}") for c in anchor])
    for c in compatible:
        x, y = F.col(f"_g_{c}"), F.col(f"_o_{c}")
        on = on & (~filled(x) | ~filled(y) | (x == y))
    edges = g.join(o, on).select("g_row", "o_row", "_p")
    degree = edges.groupBy("o_row").agg(F.count("*").alias("_d"))
    per = edges.join(degree, "o_row").groupBy("g_row").agg(F.min("o_row").alias("o_row"), F.count_distinct("_p").alias("_n"), F.max("_d").alias("_d"))
    per = per.withColumn("status", F.when((F.col("_n") == 1) & (F.col("_d") == 1), "matched").otherwise("ambiguous"))
    out = golden.select(F.col(order).alias("g_row")).join(per, "g_row", "left")
    return out.select("g_row", F.when(F.col("status") == "matched", F.col("o_row")).alias("o_row"), F.coalesce("status", F.lit("missing")).alias("status"))


def scope_match(golden: DataFrame, output: DataFrame, strict: list[str], relaxed: list[str], scope: str, order: str) -> DataFrame:
    """(g_row, o_row, pass_no): four passes (strict and both scopes filled, strict, relaxed and both filled, relaxed).

    A pass takes the pairs equal in its keys, with compatible scopes, that are unique in both directions among the rows
    left; a blank scope doesn't bridge where a row with an openly different scope competes for the same key.
    """
    filled = lambda c: F.coalesce(F.trim(c) != "", F.lit(False))
    g_left, o_left, found = golden, output, None
    for number, (keys, both) in enumerate([(strict, True), (strict, False), (relaxed, True), (relaxed, False)], 1):
        g = g_left.dropna(subset=keys).select(*keys, F.col(order).alias("g_row"), F.col(scope).alias("_gs"))
        o = o_left.dropna(subset=keys).select(*keys, F.col(order).alias("o_row"), F.col(scope).alias("_os"))
        pairs = g.join(o, keys)
        equal = F.coalesce(F.col("_gs") == F.col("_os"), F.lit(False)) & filled(F.col("_gs"))
        blank = ~filled(F.col("_gs")) | ~filled(F.col("_os"))
        rival = pairs.filter(~equal & ~blank).select("g_row").distinct().withColumn("_rival", F.lit(True))
        cand = pairs.filter(equal) if both else pairs.join(rival, "g_row", "left").filter(equal | (blank & F.col("_rival").isNull()))
        n = cand.groupBy("g_row").agg(F.count("*").alias("_ng"))
        m = cand.groupBy("o_row").agg(F.count("*").alias("_no"))
        # Kept once a pass: the rows left and the result both build on it.
        hit = materialize(cand.join(n, "g_row").join(m, "o_row").filter("_ng = 1 AND _no = 1").select("g_row", "o_row", F.lit(number).alias("pass_no")), "pass")
        found = hit if found is None else found.unionByName(hit)
        g_left = g_left.join(hit.select(F.col("g_row").alias(order)), order, "left_anti")
        o_left = o_left.join(hit.select(F.col("o_row").alias(order)), order, "left_anti")
    return found


def cell_tally(matches: DataFrame, golden: DataFrame, output: DataFrame, fields: list[str], order: str, tolerance: float = 0.005) -> DataFrame:
    """(field, golden_cells, both, equal, golden_only, output_only) over matches; golden_cells counts all filled golden
    cells, matched or not. Numbers are equal within half a percent, texts without white space and case."""
    g = golden.select(F.col(order).alias("g_row"), *[F.col(f).cast("string").alias(f) for f in fields]).unpivot("g_row", fields, "field", "_g")
    o = output.select(F.col(order).alias("o_row"), *[F.col(f).cast("string").alias(f) for f in fields]).unpivot("o_row", fields, "field", "_o")
    joined = g.join(matches.select("g_row", "o_row"), "g_row", "left").join(o, ["o_row", "field"], "left")
    has_g, has_o = F.coalesce(F.trim("_g") != "", F.lit(False)), F.coalesce(F.trim("_o") != "", F.lit(False))
    a, b = F.col("_g").try_cast("double"), F.col("_o").try_cast("double")
    fold = lambda c: F.regexp_replace(F.lower(c), r"\s+", "")
    equal = F.coalesce(F.when(a.isNotNull() & b.isNotNull(), F.abs(a - b) <= F.abs(a) * tolerance).otherwise(fold(F.col("_g")) == fold(F.col("_o"))), F.lit(False))
    matched = F.col("o_row").isNotNull()
    return joined.groupBy("field").agg(F.count_if(has_g).alias("golden_cells"), F.count_if(matched & has_g & has_o).alias("both"), F.count_if(matched & has_g & has_o & equal).alias("equal"), F.count_if(matched & has_g & ~has_o).alias("golden_only"), F.count_if(matched & ~has_g & has_o).alias("output_only"))


def score_rollup(df: DataFrame, groups: list[str], hit: Column) -> DataFrame:
    """Recall by every prefix of ``groups`` down to the total: ROLLUP."""
    return df.rollup(*groups).agg(F.count("*").alias("n"), F.count_if(hit).alias("hits")).withColumn("rate", F.round(F.try_divide("hits", "n"), 6))


def source_groups(df: DataFrame, source: str, groups: dict[str, str], hit: Column) -> DataFrame:
    """Tally by source type and by derived group; a row counts in both."""
    derived = F.element_at(F.create_map(*[F.lit(x) for p in groups.items() for x in p]), F.col(source))
    return df.withColumn("grp", F.explode(F.array_compact(F.array(F.col(source), derived)))).groupBy("grp").agg(F.count("*").alias("n"), F.count_if(hit).alias("hits"))
