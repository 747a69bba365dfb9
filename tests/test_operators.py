import json

import pytest
from pyspark.sql import functions as F

from factsieve.functions import codes
from factsieve.functions.similarity import bigrams
from factsieve.operators import clean, context, coverage, golden, guard, ledger, merge, objects, quality, route
from factsieve.sources import html_tables, json_text, workbook
from factsieve.streaming.ledger_stream import coalesce_stream


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_first_non_null_takes_input_order(spark):
    df = spark.createDataFrame([(2, "a ", None, "x"), (1, "a", 5, None), (3, None, 7, ""), (4, "a", 9, "y")], "seq int, k string, v int, w string")
    assert rows(clean.first_non_null(df.repartition(3), ["k"], "seq").select("k", "v", "w", "seq"), "k") == [("", 7, "", 3), ("a", 5, "x", 1)]


def test_contract_dedup_merges_only_one_compatible(spark):
    df = spark.createDataFrame([(1, "k", 1.0, "a", None), (2, "k", 1.0, None, "b"), (3, "k", 2.0, "a", None), (4, "z", 1.0, "q", "r")], "seq int, k string, v double, p string, q string")
    got = clean.contract_dedup(df, ["k"], "v").select("k", "v", "p", "q", "_copies", "_conflict")
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("k", 1.0, "a", "b", 2, "same_entity_different_value"), ("k", 2.0, "a", None, 1, "same_entity_different_value"), ("z", 1.0, "q", "r", 1, None)], key=str)


def test_contract_dedup_unites_evidence_and_keeps_original_axes_apart(spark):
    df = spark.createDataFrame([(1, "k", 1.0, "a", None, "e1"), (2, "k", 1.0, "A ", None, "e2"), (3, "k", 1.0, "a", "x", "e3"), (4, "k", 1.0, "b", None, "e4")], "seq int, k string, v double, p string, _axis string, ev string")
    got = clean.contract_dedup(df, ["k"], "v", ids=("ev",), axis_original="_axis").collect()
    assert sorted((r["seq"], tuple(r["ev"]), r["_conflict"]) for r in got) == [(1, ("e1", "e2"), "same_entity_different_field"), (3, ("e3",), "same_entity_different_field"), (4, ("e4",), "same_entity_different_field")]


@pytest.mark.parametrize("text,code", [("1A3 도로", "수송"), ("3.기타", "3.기타"), (" 교통 ", "수송"), ("가" * 41, None), (None, None)])
def test_sector(spark, text, code):
    assert spark.createDataFrame([(text,)], "s string").select(codes.sector(F.col("s")).alias("x")).first()["x"] == code


@pytest.mark.parametrize("text,kind", [("\n표 차 례\n표 1 가", "table_index"), ("1장\n그림목차", "figure_index"), ("CONTENTS\n1", "contents"), ("머리\n" + "\n".join(f"표 {i} 가 ... {i}" for i in range(8)), "contents"), ("\n".join(f"가  나 {i}" for i in range(20)), None), (None, None)])
def test_index_pages(spark, text, kind):
    assert spark.createDataFrame([(text,)], "t string").select(route.index_page_kind(F.col("t")).alias("x")).first()["x"] == kind


def test_responses(spark):
    fields = "candidate_id int, status string, name string, year int, funding string, page int, object_id string, evidence_id string, amount string, unit string, quote string"
    good = ("read", "가 나", 2024, "총계", 3, "o", "e", "1,200", "백만원", "사업비 1,200백만원")
    change = lambda i, **new: (i, *[new.get(k.split()[0], v) for k, v in zip(fields.split(", ")[1:], good)])
    given = [change(1), change(1), change(2), change(2, amount="7"), change(3, status="blank"), change(4, name="다"), change(5, page=4), change(6, unit="억원"), change(7, amount="1300"), change(8, quote="11,200"), change(10, year=None)]
    targets = spark.createDataFrame([(i, "가나", 2024, "합계", 3, "o", ["e", "f"], "1200", "백만원") for i in range(1, 11)], "candidate_id int, name string, year int, funding string, page int, object_id string, evidence_ids array<string>, v string, unit string").withColumn("value", F.col("v").cast("decimal(20,6)"))
    got = dict(tuple(r)[::2] for r in guard.validate_responses(targets, spark.createDataFrame(given, fields)).collect())
    assert got == {1: "source_fact_and_review_agree", 2: "conflicting_duplicate_response", 3: "model_blank", 4: "business_mismatch", 5: "page_mismatch", 6: "unit_or_scale_mismatch", 7: "source_value_conflict", 8: "amount_quote_missing", 9: "not_returned", 10: "year_mismatch"}


def test_strict_ledger_has_line_numbers(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": 1}\n\n{damaged\n{"id": 4}\n')
    got = json_text.strict_ledger(spark, str(tmp_path / "a.jsonl"), "id int").orderBy("line_no").collect()
    assert [(r["line_no"], r["id"], r["_damaged"] is not None) for r in got] == [(1, 1, False), (3, None, True), (4, 4, False)]


def test_objects_of_other_documents_dont_match(spark):
    r = spark.createDataFrame([(1, "d1", ["e1"], [], "3-1", [5]), (2, "d2", [], ["o1"], "3-1", [5])], "row_id int, doc_id string, evidence_ids array<string>, object_ids array<string>, number string, pages array<int>")
    o = spark.createDataFrame([("d1", "o1", "e1", "3-1", 5), ("d3", "o9", "e1", "3-1", 5)], "doc_id string, object_id string, evidence_id string, number string, page_number int")
    assert rows(objects.evidence_match(r, o, "row_id"), "row_id") == [(1, "o1", "exact"), (2, None, "missing")]


def test_confidence_of_native_objects(spark):
    full, ragged = [["a", "b"], ["c", "d"], ["e", "f"]], [["a", "b", "c"], ["d"], ["e"], ["f"]]
    df = spark.createDataFrame([(1, "text", "가" * 80, None), (2, "text", " 가 ", None), (3, "table", None, full), (4, "table", None, ragged), (5, "table", None, [["a"]]), (6, "chart", None, None), (7, "figure", "", []), (8, "other", None, None)], "i int, k string, t string, r array<array<string>>")
    got = rows(df.select("i", objects.native_confidence(F.col("k"), F.col("t"), F.col("r"), F.lit(None).cast("boolean"), F.lit(None).cast("string")).alias("c")), "i")
    assert got == [(1, 0.98), (2, 0.25), (3, 0.96), (4, 0.71), (5, 0.15), (6, 0.2), (7, 0.3), (8, 0.5)]


def test_clean_sheet(spark):
    df = spark.createDataFrame([("교통", "직접 배출", "2,020", "1,000.5", ""), ("건물", "합계", "2021", None, "x")], "`부문` string, `배출유형` string, `연도` string, `배출량` string, `지자체명` string")
    got = clean.clean_sheet(df, "emissions_regional", "서울시").select("부문", "배출유형", "연도", "배출량", "지자체명").collect()
    assert [tuple(r) for r in got] == [("수송", "직접배출", 2020, 1000.5, "서울시")]


def test_every_sheet_has_a_cleaner(spark):
    for sheet, (wholes, measures, required) in clean.SHEETS.items():
        names = {*wholes, *measures, *required, "지자체명"}
        df = spark.createDataFrame([tuple(None for _ in names)], ", ".join(f"`{n}` string" for n in sorted(names)))
        assert clean.clean_sheet(df, sheet).count() == (0 if required else 1)


def test_conflicts_keep_both(spark):
    df = spark.createDataFrame([(1, "e", 1.0, None), (2, "e", 2.0, "t"), (3, "e", 1.0, None), (4, "f", 1.0, "t"), (5, None, 1.0, "t"), (6, None, 2.0, "t")], "seq int, e string, v double, u string")
    got = rows(merge.conflict_pairs(df, ["e"], ["v", "u"], "seq").select("e", "earlier", "later", "differing"), "earlier")
    assert got == [("e", 1, 2, ["v"]), (None, 5, 6, ["v"])]


def test_stable_merge_is_order_free(spark):
    df = spark.createDataFrame([(1, "a", 1, "x"), (2, "a", 1, "y"), (3, "b", 1, "x")], "seq int, k string, n int, ev string")
    one = sorted(map(str, merge.stable_merge(df, ["k", "n"], ["ev"], "seq").collect()))
    two = sorted(map(str, merge.stable_merge(df.orderBy(F.desc("seq")).repartition(3), ["k", "n"], ["ev"], "seq").collect()))
    assert one == two and "ev=['x', 'y']" in one[0]


def test_blank_scope(spark):
    data = [(1, "k", 5.0, "A", "p"), (2, "k", 5.0, "", None), (3, "m", 1.0, "A", None), (4, "m", 1.0, "B", None), (5, "m", 1.0, None, None), (6, "z", 1.0, None, None), (7, "k", 6.0, None, None), (8, "k", 5.0, None, "q"), (9, "n", 1.0, "A", None), (10, "n", 1.0, "A", None), (11, "n", 1.0, " ", None)]
    df = spark.createDataFrame(data, "seq int, k string, v double, s string, o string")
    got = {r["seq"]: (r["_scope_status"], r["_target"]) for r in merge.resolve_blank_scope(df, ["k"], "v", "s", ["o"], "seq").collect()}
    assert got[1] == ("known", "A") and got[2] == ("absorbed", "A") and got[5] == ("ambiguous_blank_scope", None) and got[6] == ("alone", None)
    assert got[7] == ("alone", None) and got[8] == ("scope_candidate_payload_conflict", None) and got[11] == ("several", None)


def test_append_only(spark):
    base = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, v double")
    new = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 4.0)], "k string, v double")
    assert {r["k"]: r["_decision"] for r in merge.append_only(base, new, ["k"]).collect()} == {"a": "already", "b": "held", "c": "add"}


def test_quality_rules(spark):
    df = spark.createDataFrame([(1, "사업", 2030, 0.0, "백만원", 3), (2, "", 1700, None, "tCO2eq", 99), (3, "x", 2030, 1.0, "푼", -1)], "row_id int, `사업명` string, `연도` int, `예산액` double, `예산단위` string, `출처페이지` int")
    rules = quality.sheet_rules("financial_plan", df.columns, F.lit(50))
    got = {(r["row_id"], r["rule_id"]) for r in quality.evaluate(df, "financial_plan", rules, "row_id").collect()}
    assert got == {(2, "required.missing"), (2, "time.invalid_year"), (2, "budget.non_money_unit"), (2, "provenance.invalid_page"), (3, "budget.unknown_unit"), (3, "provenance.invalid_page")}


def test_storage_compare(spark):
    a = spark.createDataFrame([(1, "f", "1.0"), (2, "f", "x"), (3, "f", None)], "row_no int, field string, value string")
    b = spark.createDataFrame([(1, "f", "1"), (2, "f", "y"), (4, "f", "z")], "row_no int, field string, value string")
    assert rows(quality.compare_storage(a, b), "row_no") == [(2, "f", "storage.cell_mismatch"), (4, "f", "storage.extra")]


def test_strict_and_relaxed(spark):
    g = spark.createDataFrame([(1, "k", "a"), (2, "k", "b"), (3, None, "c")], "row int, k string, v string")
    o = spark.createDataFrame([(7, "k", "b"), (8, "k", "a"), (9, "k", "b")], "row int, k string, v string")
    assert rows(golden.strict_fifo(g, o, ["k"], "row"), "g_row") == [(1, 7), (2, 8)]
    # The first golden row passes over row 7, which is spent; the second takes row 9.
    assert rows(golden.relaxed_kernel(g, o, ["k"], "v", "row"), "g_row") == [(1, 8), (2, 9)]


def test_similar_pairs_equal_brute_force(spark):
    import random

    random.seed(4)
    make = lambda n: [(i, [f"w{random.randint(0, 12)}" for _ in range(random.randint(0, 7))]) for i in range(n)]
    a, b = make(40), make(50)
    df = lambda x: spark.createDataFrame(x, "row int, items array<string>")
    got = {(r[0], r[1]) for r in golden.similar_pairs(df(a), df(b), [], "items", 0.6, "row").collect()}
    exact = {(i, j) for i, x in a for j, y in b if x and y and len({*x} & {*y}) / len({*x} | {*y}) >= 0.6}
    assert got == exact


def _jaccard_brute_force(a, b, least):
    return [(i, j, len({*x} & {*y}) / len({*x} | {*y})) for i, x in a for j, y in b if x and y and len({*x} & {*y}) / len({*x} | {*y}) >= least]


def test_mutual_best_lists_no_pairs_of_rows(spark):
    # A name that many rows hold is compared once; of the two others, one is single on both sides.
    a = [(i, ["u", "v", "w"]) for i in range(1500)] + [(5000, ["p", "q"]), (5001, ["x", "y"])]
    b = [(i, ["u", "v", "w"]) for i in range(1500)] + [(5000, ["p", "q", "r"]), (5001, ["x", "y"]), (5001, ["x", "y"]), (5002, [])]
    df = lambda x: spark.createDataFrame(x, "row int, items array<string>")
    found = golden.similar_sets(df(a), df(b), [], "items", 0.3, "row")
    assert found.pairs.count() == 3
    assert rows(golden.mutual_best(found), "g_row") == [(5000, 5000, 2 / 3)]


def test_mutual_best_equals_brute_force(spark):
    import random
    from collections import Counter

    random.seed(9)
    # Row numbers that stand on two rows, equal sets and empty ones among them.
    make = lambda n, size: [(random.randint(0, n), [f"w{random.randint(0, size)}" for _ in range(random.randint(0, 6))]) for i in range(n)]
    a, b = make(60, 20), make(70, 20)
    df = lambda x: spark.createDataFrame(x, "row int, items array<string>")
    pairs = _jaccard_brute_force(a, b, 0.3)
    alone = lambda k: {key: m for key, m, n in ((key, max(p[2] for p in pairs if p[k] == key), None) for key in {p[k] for p in pairs}) if Counter(p[2] for p in pairs if p[k] == key)[m] == 1}
    g, o = alone(0), alone(1)
    exact = sorted(p for p in pairs if g.get(p[0]) == p[2] and o.get(p[1]) == p[2])
    assert exact and rows(golden.mutual_best(golden.similar_sets(df(a), df(b), [], "items", 0.3, "row")), "g_row") == exact


def test_similar_pairs_keep_every_row(spark):
    import random

    random.seed(5)
    # Each row counts, also where a row number stands on several; a name is cut by the caller's rule.
    make = lambda n: [(random.randint(0, n), "".join(random.choice("abc ") for _ in range(random.randint(0, 6)))) for _ in range(n)] + [(n + 1, None)]
    a, b = make(40), make(50)
    df = lambda x: spark.createDataFrame(x, "row int, name string")
    cut = lambda x: [(i, [t[k : k + 2] for k in range(len(t) - 1)]) for i, t in ((i, (t or "").replace(" ", "")) for i, t in x)]
    exact = sorted(_jaccard_brute_force(cut(a), cut(b), 0.3))
    got = golden.similar_pairs(df(a), df(b), [], "name", 0.3, "row", bigrams)
    assert exact and sorted(tuple(r) for r in got.collect()) == exact


def test_similar_pairs_within_a_partition(spark):
    a = spark.createDataFrame([(1, "d", ["x", "y"]), (2, "e", ["x", "y"]), (3, None, ["x"])], "row int, doc string, items array<string>")
    b = spark.createDataFrame([(7, "d", ["y", "x", "x"]), (8, "f", ["x"]), (9, None, ["x"])], "row int, doc string, items array<string>")
    assert rows(golden.similar_pairs(a, b, ["doc"], "items", 0.6, "row"), "g_row") == [(1, 7, 1.0)]


def test_unique_graph(spark):
    g = spark.createDataFrame([(1, "k", "s", 1.0), (2, "m", None, 1.0), (3, "q", None, 2.0)], "row int, k string, c string, v double")
    o = spark.createDataFrame([(5, "k", None, 1.0), (6, "k", "s", 1.0), (7, "m", "x", 1.0), (8, "m", "y", 2.0)], "row int, k string, c string, v double")
    assert rows(golden.unique_graph(g, o, ["k"], ["c"], ["v"], "row"), "g_row") == [(1, 5, "matched"), (2, None, "ambiguous"), (3, None, "missing")]


def test_scope_passes(spark):
    g = spark.createDataFrame([(1, "k", "A"), (2, "m", None), (3, "n", "A")], "row int, k string, s string")
    o = spark.createDataFrame([(5, "k", "A"), (6, "k", "B"), (7, "m", "A"), (8, "n", None), (9, "n", "B")], "row int, k string, s string")
    assert rows(golden.scope_match(g, o, ["k"], ["k"], "s", "row"), "g_row") == [(1, 5, 1), (2, 7, 2)]


def test_routing(spark):
    pages = spark.createDataFrame([("d", 1, "배출량 표\n\n배출량 10"), ("d", 2, "그 밖"), ("d", 4, "끝"), ("d", 3, None)], "doc string, page int, text string")
    routes = spark.createDataFrame([("e", ["배출량"], ["표"], ["설문"])], "sheet string, strong array<string>, weak array<string>, negative array<string>")
    got = route.page_scores(pages.filter(F.col("text").isNotNull()), routes).filter("score >= 3")
    assert rows(got.select("page", "score"), "page") == [(1, 8)]
    assert rows(route.route_pages(pages.filter(F.col("text").isNotNull()), routes, "doc", "page", "text").select("page"), "page") == [(1,), (2,)]


def test_guards(spark):
    a = spark.createDataFrame([(1, "d", 100.0), (2, "d", 250.0), (3, "e", 100.0), (4, "d", None), (5, "d", -40.0), (6, "d", 0.0)], "row_id int, doc string, x double")
    b = spark.createDataFrame([("d", 100.4), ("d", 252.0), ("d", -40.1), ("d", 0.0)], "doc string, y double")
    assert rows(guard.duplicated_elsewhere(a, b, [("doc", "doc")], ("x", "y"), "row_id"), "row_id") == [(1,), (5,), (6,)]
    plans = spark.createDataFrame([(1, "k", "태양광 발전 설비 보급"), (2, "k", "태양광 발전 설비 보급 및 점검"), (3, "k", "태양광 발전 설비 보급"), (4, "k", "짧다"), (5, "m", "태양광 발전 설비 보급")], "row_id bigint, k string, t string")
    assert rows(guard.containment_quarantine(plans, ["k"], "t", None, "row_id"), "row_id") == [(1, 2), (3, 1)]


def test_html_grid_and_markdown(spark):
    html = "<table><tr><th rowspan=2>사업</th><th colspan=2>연도</th></tr><tr><th>2024</th><th>2025</th></tr><tr><td>a</td><td>1</td><td>2</td></tr></table>"
    df = spark.createDataFrame([(html,), (None,), ("<table><tr><td rowspan=2>a</td><td>b</td></tr><tr><td colspan=2>c</td></tr></table>",)], "h string")
    got = [r["g"] for r in df.select(html_tables.html_grid("h").alias("g")).collect()]
    assert got[0]["rows"] == [["사업", "연도", "연도"], ["사업", "2024", "2025"], ["a", "1", "2"]] and got[0]["header_rows"] == 2
    md = spark.createDataFrame([("| a | b |\n|---|---|\n| 1 | |",)], "t string")
    grid = html_tables.markdown_grid(F.col("t"))
    assert md.select(grid.alias("g")).first()["g"] == [["a", "b"], ["1", ""]]
    assert md.select(html_tables.to_markdown(grid).alias("g")).first()["g"].splitlines()[0] == "| a | b |"


def test_workbook_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("d1", "=1+1", True, ["a"]), ("d1", "나", False, None), ("d2", None, None, [])], "doc string, `이름` string, ok boolean, xs array<string>")
    workbook.write_workbooks({"11_재정": df}, "doc", str(tmp_path))
    cells = {(r["path"].rsplit("/", 1)[1], r["row_no"], r["field"]): r["value"] for r in workbook.read_workbooks(spark, str(tmp_path)).collect()}
    assert cells["d1.xlsx", 2, "이름"] == "'=1+1" and cells["d1.xlsx", 2, "ok"] == "Y" and cells["d1.xlsx", 2, "xs"] == '["a"]'
    spark.dataSource.register(workbook.WorkbookSource)
    assert spark.read.format("workbook").option("paths", str(tmp_path / "d1.xlsx")).load().count() == len([k for k in cells if k[0] == "d1.xlsx"])


def test_tolerant_json(spark):
    df = spark.createDataFrame([('말: ```json\n{"a": [1, 2]}\n``` 끝',), ("[oops {\"b\": 1}",), ("없음",), (None,)], "t string")
    assert [r["j"] for r in df.select(json_text.tolerant_json(F.col("t")).alias("j")).collect()] == ['{"a": [1, 2]}', '{"b": 1}', None, None]


def test_coverage(spark):
    facts = spark.createDataFrame([(1, "a", "2", "억원"), (2, "b", "5", "백만원"), (3, "c", "12.5", "tCO2eq"), (4, "z", "1", "원")], "fact_id int, k string, v string, unit string")
    saved = spark.createDataFrame([("a", "200", "백만원"), ("b", "6", "백만원"), ("c", "12.5", "tCO2")], "k string, v string, unit string")
    num = F.col("v").cast("decimal(20,6)").alias("value")
    got = coverage.reconcile(facts.select("fact_id", "k", num, "unit"), saved.select("k", num, "unit"), ["k"])
    assert rows(got, "fact_id") == [(1, "covered"), (2, "conflict_review"), (3, "unit_review"), (4, "absent")]


def test_conflict_is_not_hidden_by_a_matching_duplicate(spark):
    facts = spark.createDataFrame([(i, k, "100", "백만원", [1]) for i, k in enumerate("abcdefg")], "fact_id int, k string, v string, unit string, pages array<int>")
    saved = [("a", "100", "백만원", [1]), ("a", "101", "백만원", [1]), ("b", "1", "억원", [1]), ("b", "100", "tCO2", [1]), ("c", "100", "백만원", [1]), ("c", None, "백만원", [1]), ("d", "100", "백만원", [2]), ("e", "100", "백만원", [2, 1]), ("e", "100", "백만원", [2, 1]), ("f", "100", " ", [1])]
    num = F.col("v").cast("decimal(20,6)").alias("value")
    s = spark.createDataFrame(saved, "k string, v string, unit string, pages array<int>")
    got = coverage.reconcile(facts.select("fact_id", "k", num, "unit", "pages"), s.select("k", num, "unit", "pages"), ["k"], "pages")
    assert rows(got, "fact_id") == [(0, "conflict_review"), (1, "unit_review"), (2, "ambiguous_review"), (3, "ambiguous_review"), (4, "covered"), (5, "ambiguous_review"), (6, "absent")]
    # A name alone covers nothing: without common pages the same rows are ambiguous.
    alone = coverage.reconcile(facts.filter("k = 'c'").select("fact_id", "k", num, "unit", F.lit(None).cast("array<int>").alias("pages")), s.select("k", num, "unit", "pages"), ["k"], "pages")
    assert rows(alone, "fact_id") == [(2, "ambiguous_review")]


def test_itemize_repeated_headers(spark):
    grid = [["사업명", "단위", "2024", "2025"], ["a", "t", "1", "-"], ["합계", "t", "9", "9"], ["사업명", "단위", "2026", "2027"], ["b", "t", "3", "0"]]
    df = spark.createDataFrame([("d", grid)], "doc string, rows array<array<string>>")
    assert rows(coverage.itemize(df, ["doc"]).select("name", "year", "raw_value", "raw_unit"), "name", "year") == [("a", 2024, "1", "t"), ("b", 2026, "3", "t"), ("b", 2027, "0", "t")]


def test_ledger_batch_equals_stream(spark, tmp_path):
    recs = [("b1", 1, "partial", ["x"]), ("b1", 2, "call_fail", ["y"]), ("b2", 3, "ok", ["z"]), ("b2", 4, "call_fail", []), ("b3", 5, "call_fail", []), ("b3", 6, "ok", ["w"])]
    df = spark.createDataFrame(recs, "batch_id string, line_no int, status string, payload array<string>")
    batch = {r["batch_id"]: (r["status"], r["payload"], r["recovered"]) for r in ledger.coalesce_ledger(df).collect()}
    assert batch == {"b1": ("partial", ["x", "y"], True), "b2": ("call_fail", [], False), "b3": ("ok", ["w"], False)}
    for n, part in enumerate((recs[:1], recs[1:4], recs[4:])):
        spark.createDataFrame(part, df.schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    out = []
    stream = coalesce_stream(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in")))
    stream.writeStream.outputMode("update").foreachBatch(lambda d, i: out.extend((i, *r) for r in d.collect())).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert {k: v for _, k, *v in sorted(out, key=lambda r: r[0])}.keys() == batch.keys()
    assert {k: tuple(v) for _, k, *v in sorted(out, key=lambda r: r[0])} == batch


def test_objects(spark):
    box = lambda x: (x, 0.0, x + 100, 100.0)
    schema = "doc string, page int, object_id string, object_type string, number string, caption string, box struct<x0:double,y0:double,x1:double,y1:double>"
    a = spark.createDataFrame([("d", 1, "o1", "table", "3-2", "배출량 추이", box(0.0)), ("d", 1, "o2", "table", None, None, box(500.0))], schema)
    b = spark.createDataFrame([("d", 1, "n1", "table", "3-2", "배출량 추이", box(900.0)), ("d", 1, "n2", "table", None, None, box(503.0)), ("d", 2, "n3", "table", None, None, box(500.0))], schema)
    assert rows(objects.unique_matches(objects.match_objects(a, b, "doc", "page")), "left_id") == [("o1", "n1", "number"), ("o2", "n2", "overlap")]


def test_asof(spark):
    df = spark.createDataFrame([("d", 1, "h", "A"), ("d", 2, "t", "x"), ("d", 12, "t", "y"), ("e", 1, "t", "z")], "doc string, page int, kind string, text string")
    got = context.nearest_preceding(df, ["doc"], ["page"], F.col("kind") == "h", F.col("text"), F.lit(8), F.col("page"))
    assert rows(got.select("doc", "page", "scope"), "doc", "page") == [("d", 1, None), ("d", 2, "A"), ("d", 12, None), ("e", 1, None)]


def test_queries_and_oracles_agree_in_names():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert json.dumps(sorted(entry.queries()))
