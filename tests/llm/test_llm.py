import random
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from factsieve.functions.storage import exists
from factsieve.llm import copies, language, leakage, linkage, lookalikes, mapping, packing, survivors


def test_ledger_in_batches_equals_one(spark):
    rows = [(i, random.Random(i).choice(["A b", "a-B", "c", None, "", "A  b."])) for i in range(300)]
    df = spark.createDataFrame(rows, "id bigint, t string").select(copies.record_key(["t"], []).alias("key"), "id")
    one, many = copies.CopyLedger(spark), copies.CopyLedger(spark)
    one.absorb(df)
    for c in copies.batches(df, "id", 5):
        many.absorb(df.filter(c))
    many.absorb(df.limit(0))
    get = lambda l: sorted((bytes(r["key"]), r["n"], r["first_id"]) for r in l.table().collect())
    assert get(one) == get(many) and len(get(one)) == 4  # a b, c, null, empty


def test_find_copies_with_a_hot_group(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).cast("binary").alias("key"), "id")
    got = copies.find_copies(df, copies.CopyLedger(spark))
    assert got.count() == 1666 and got.select("first_id").distinct().collect()[0][0] == 0


def test_payload_keys(spark):
    same = ['{"a": 10539, "b": "EV  단속"}', '{"b":"[ev 단속]","a":"10,539"}', '{"a":"10539","b":"\\u0045V 단속","c":null}']
    df = spark.createDataFrame([(t,) for t in [*same, '{"a": 1}', "깨진 {", None, ""]], "p string").select(copies.payload_key(F.col("p"), []).alias("k"))
    keys = [bytes(r["k"]) for r in df.collect()]
    assert keys[0] == keys[1] == keys[2] and len(set(keys)) == 5


def test_ledger_is_found_again_and_takes_a_batch_once(spark):
    rows = lambda *ids: spark.createDataFrame([(bytes([i % 3]), i) for i in ids], "key binary, id bigint")
    name = f"t{random.random()}"
    first = copies.CopyLedger(spark, name)
    assert first.absorb(rows(4, 5, 6), "monday") and first.table().count() == 3
    again = copies.CopyLedger(spark, name)
    assert not again.absorb(rows(4, 5, 6), "monday") and again.absorb(rows(0, 9), "tuesday")
    spark.sql(f"DROP TABLE {again._table(again.generation)}")  # as in a session whose catalog doesn't know it
    last = copies.CopyLedger(spark, name)
    assert last.generation == 2 and last.buckets == first.buckets
    assert sorted((bytes(r["key"])[0], r["n"], r["first_id"]) for r in last.table().collect()) == [(0, 3, 0), (1, 1, 4), (2, 1, 5)]
    assert not exists(spark, f"{last.folder}/1") and exists(spark, f"{last.folder}/2")


def test_copies_of_an_empty_table(spark):
    df = spark.createDataFrame([], "key binary, id bigint")
    assert copies.find_copies(df, copies.CopyLedger(spark)).count() == 0


REFS = [("S1", "건물", "Buildings"), ("S2", "수송", "Transport"), ("S3", "가정용 연료", "Household Fuel"), ("S4", "수소", "Hydrogen")]


@pytest.mark.parametrize("text,ref", [("건무", "S1"), ("2-1 수송 부문", "S2"), ("rjsanf", "S1"), ("가용정 연료", "S3"), ("trasnport sector", "S2"), ("건물/Buildings", "S1"), ("수쇼", "S4"), ("문화유산", None), ("???", None)])
def test_sectors(spark, text, ref):
    sectors = spark.createDataFrame(REFS, "ref_id string, name string, english string")
    values = spark.createDataFrame([(text, 1)], "value string, n bigint")
    got = mapping.match_sectors(values, sectors, spark.createDataFrame([], "ref_id string, uses bigint")).collect()
    assert [r["ref_id"] for r in got] == ([ref] if ref else [])


def test_pigeonhole_loses_no_pair(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randint(1, 9)))
    refs, values = [(f"r{i}", word()) for i in range(25)], [(i, word()) for i in range(120)]

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
        return row[-1]

    got = {(r["i"], r["ref_id"]) for r in mapping.pigeonhole_join(spark.createDataFrame(values, "i int, form string"), spark.createDataFrame(refs, "ref_id string, form string"), F.lit(2)).collect()}
    exact = {(i, r) for i, v in values for r, w in refs if distance(v, w) <= min(2, len(w) - 1)}
    assert got == exact


def test_linkage_keeps_other_work_apart(spark):
    names = ["마을버스 무공해차 교체", "교체 마을버스 무공해차", "가랑동 마을버스 친환경차 교체 (2차)", "마을버스 무공해챠 교체", "마을버스 무공해차 시승 행사", "토종 씨앗 도서실", None, "", unicodedata.normalize("NFD", "마을버스 무공해차 교체")]
    others = [f"서로 다른 일 {chr(0xAC00 + i * 37)}{chr(0xB098 + i * 53)} 교육" for i in range(60)]
    rows = [(i, n, "수송" if i % 2 else None, 2022) for i, n in enumerate(names + others)] + [(999, names[0], "수송", 2035), (998, names[0], "건물", 2022), (997, names[0], None, None)]
    plan = spark.createDataFrame(rows, "row_id bigint, name string, sector string, year int")
    units = spark.createDataFrame([("2-1", "마을버스 무공해차 교체", "수송", 2020, 2026), ("2-2", "마을버스 무공해차 교체", "수송", 2027, None), ("1-1", "경로당 창호 단열 보강", "건물", 2020, None)], "unit_no string, entry string, sector string, first int, last int")
    got = {(r["row_id"], r["unit_no"]) for r in linkage.link(plan, units).collect()}
    assert {(0, "2-1"), (2, "2-1"), (8, "2-1"), (999, "2-2")} <= got and not {i for i, _ in got} & {4, 5, 6, 7, 997, 998}


def test_project_names_of_many_words_and_without_spaces(spark):
    words = ["".join(chr(0xAC00 + 588 * (i % 19) + 28 * (i % 21) + k) for k in range(2)) for i in range(15)]
    catalog = spark.createDataFrame([("C1", " ".join(words)), ("C2", "마을버스 무공해차 교체")], "ref_id string, name string")
    values = [" ".join(words[4:] + words[:4]), "무공해차교체마을버스", "가 " * 3000]
    got = mapping.match_projects(spark.createDataFrame([(v, 1) for v in values], "value string, n bigint"), catalog)
    assert {(r["value"], r["ref_id"]) for r in got.collect()} == {(values[0], "C1"), (values[1], "C2")}


def test_blocking_loses_no_link(spark):
    plan = [f"{a} {b} {c}" for a in ("마을버스", "경로당", "공영주차장") for b in ("무공해차", "창호 단열", "태양광 발전") for c in ("교체", "보강", "설치")]
    entries = [("마을버스 무공해차 교체",), ("경로당 창호 단열 보강",), ("공영주차장 태양광 발전 설치",)]
    names = spark.createDataFrame([(linkage_name,) for linkage_name in plan], "name string")
    listed = spark.createDataFrame(entries, "entry string")
    blocked = {(r["name"], r["entry"]) for r in linkage.compare_names(names, listed).filter("explained >= 0.72 AND shown >= 0.5").collect()}
    whole = linkage.block_keys
    try:
        linkage.block_keys = lambda c: F.array(F.lit("all"))  # every pair
        every = {(r["name"], r["entry"]) for r in linkage.compare_names(names, listed).filter("explained >= 0.72 AND shown >= 0.5").collect()}
    finally:
        linkage.block_keys = whole
    assert every and blocked == every


def test_lookalikes(spark):
    texts = ["BRT 제9호"] * 5 + ["ＢＲＴ 제９호", "ВRT​ 제9호", unicodedata.normalize("NFD", "BRT 제9호"), "BRT㎡", "Éco"] + ["E​́co", None, "​", "   "]
    df = spark.createDataFrame([("t", i, "d", t) for i, t in enumerate(texts)], "src string, row_id bigint, d string, text string").withColumn("scope", F.unhex(F.md5("d"))).drop("d")
    rules = lookalikes.representatives(lookalikes.count_members(df, "text"))
    assert sorted((r["row_id_a"], r["row_id_b"]) for r in lookalikes.find_variants(df, rules).collect()) == [(0, 5), (0, 6), (0, 7), (9, 10)]
    assert lookalikes.find_variants(df.limit(0), rules).count() == 0


def test_truth_keeps_several_values():
    posterior, sensitivity, specificity = survivors.infer_truth([(1, 3, 50), (2, 3, 40), (3, 3, 100)], 2)
    assert all(p > 0.5 for p in posterior.values()) and (specificity > 0.9).all() and (sensitivity > 0.5).all()


def _claims(seed, inventing):
    """Groups with three true values that each good source names nine times of ten, and a poor source that may invent one."""
    rng, rows, invented = random.Random(seed), [], set()
    for g in range(300):
        for bit in range(4):
            values = [f"t{g}-{i}" for i in range(3) if rng.random() < (0.9 if bit < 3 else 0.4)]
            if bit == 3 and rng.random() < inventing:
                values.append(f"f{g}")
                invented.add(f"f{g}")
            rows.append((f"g{g}".encode(), 4 * g + bit, bit, values, []))
    return rows, invented


def test_invented_values_are_judged_false(spark):
    rows, invented = _claims(4, 0.5)
    keyed = spark.createDataFrame(rows, "key binary, row_id bigint, bit int, lineage array<string>, evidence array<string>")
    _, members, values, qualities = survivors.survivors(keyed, {"lineage": "n_lineage", "evidence": "n_evidence"})
    false = {r["value"] for r in values.filter("NOT judged").collect()}
    assert len(false & invented) >= 0.95 * len(invented) and len(false - invented) <= 0.05 * len(false)
    sensitivity, specificity = qualities["lineage"]
    assert specificity[3] < 0.8 < specificity[:3].min() and sensitivity[3] < 0.6 < sensitivity[:3].min()
    # A row is credited with what is judged true only, unlike with a threshold that judges nothing false.
    poor = {r["row_id"]: r["n_lineage"] for r in members.collect()}
    every = {r["row_id"]: r["n_lineage"] for r in survivors.survivors(keyed, {"lineage": "n_lineage", "evidence": "n_evidence"}, threshold=0.0)[1].collect()}
    assert sum(every.values()) - sum(poor.values()) == len(false)
    assert all(len(v) == every[i] for _, i, _, v, _ in rows)


def test_survivors_of_many_sources(spark):
    rows = [(b"k", i, i, [f"v{i}"], ["x"]) for i in range(14)]
    keyed = spark.createDataFrame(rows, "key binary, row_id bigint, bit int, lineage array<string>, evidence array<string>")
    _, members, values, _ = survivors.survivors(keyed, {"lineage": "n_lineage", "evidence": "n_evidence"})
    assert members.count() == 14 and values.filter("field = 'lineage'").count() == 14


def test_all_ranks_of_a_long_source_list_count(spark, tmp_path):
    from factsieve.llm import survivor_queries

    trust = [(f"s{i:02d}", i, "") for i in range(1, 15)] + [(f"s99", 99, "")]
    spark.createDataFrame(trust, "`추출원천` string, trust_rank int, `설명` string").write.parquet(f"{tmp_path}/source_trust.parquet")
    names = ["S-14", "s 12", "s99", "?", None]
    rows = [(i, "d", "p", "b", "n", "f", 2020, 1.0, "원", None, n, "e" if n else None, None) for i, n in enumerate(names)]
    spark.createDataFrame(rows, "row_id bigint, doc_id string, `계획구분` string, `부문` string, `사업명` string, `재원구분` string, `연도` int, `예산액` double, `예산단위` string, `출처계보` string, `추출원천` string, `근거ID` string, loaded_at timestamp").write.parquet(f"{tmp_path}/financial_plan.parquet")
    assert [tuple(r) for r in survivor_queries.p5_found(spark, str(tmp_path)).collect()] == [(0, -1, 1, 1)]


def test_survivors(spark):
    rows = [(b"k", 1, 1, ["a"], ["x"]), (b"k", 2, 2, ["a", "b"], []), (b"k", 3, 0, None, None), (b"z", 4, 1, ["q"], ["q"]), (None, 5, 1, ["q"], ["q"]), (None, 6, 1, ["q"], ["q"])]
    keyed = spark.createDataFrame(rows, "key binary, row_id bigint, bit int, lineage array<string>, evidence array<string>")
    groups, members, *_ = survivors.survivors(keyed, {"lineage": "n_lineage", "evidence": "n_evidence"})
    assert groups.count() == 1
    assert sorted((r["row_id"], r["n_lineage"], r["n_evidence"]) for r in members.collect()) == [(1, 1, 1), (2, 2, 0), (3, 0, 0)]


@pytest.mark.parametrize("bins", [1, 3, 64])
def test_best_fit_never_overfills(bins):
    rng = random.Random(bins)
    sizes = [rng.randint(0, 2048) for _ in range(3000)]
    number, offset = packing.best_fit(sizes, 2048, bins)
    used = {}
    for n, o, s in sorted(zip(number, offset, sizes), key=lambda x: (x[0], x[1], x[2])):
        assert o == used.get(n, 0)
        used[n] = o + s
    assert max(used.values()) <= 2048


def test_a_full_item_closes_no_bin():
    bins, _ = packing.best_fit([1000, 2048, 1000], 2048, 1)
    assert len(set(bins)) == 2
    rng = random.Random(1)
    sizes = [rng.randint(1, 2048) for _ in range(2000)]
    used = len(set(packing.best_fit(sizes, 2048, 64)[0]))
    assert -(-sum(sizes) // 2048) <= used <= 1.1 * sum(sizes) / 2048


def test_pack_cuts_only_long_documents(spark):
    sizes = spark.createDataFrame([(1, 5000), (2, 2048), (3, 0), (4, 10), (4, 10)], "id bigint, n_tokens bigint")
    got = sorted((r["id"], r["piece"], r["n_tokens"]) for r in packing.pack(sizes).collect())
    assert got == [(1, 0, 2048), (1, 1, 2048), (1, 2, 904), (2, 0, 2048), (3, 0, 0), (4, 0, 10), (4, 0, 10)]
    assert packing.pack(sizes.limit(0)).count() == 0


def _brute_tiles(a, b, size):
    out, ma, mb = 0, [False] * len(a), [False] * len(b)
    while True:
        best = 0
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and not ma[i + n] and not mb[j + n]:
                    n += 1
                best, at = (n, (i, j)) if n > best else (best, at if best else None)
        if best < size:
            return out
        for k in range(best):
            ma[at[0] + k] = mb[at[1] + k] = True
        out += best


def test_tiles_cover_what_brute_force_covers():
    rng = random.Random(8)
    for _ in range(15):
        item = "".join(rng.choice("abcdefghijklmnop") for _ in range(70))
        doc = "".join(rng.choice("abcdefghijklmnop") for _ in range(20)) + item[35:] + "zz" + item[:33] + "yy"
        a, b = leakage.letters_of(doc), leakage.letters_of(item)
        ha, hb = leakage.fingerprints(a), leakage.fingerprints(b)
        p, q = np.nonzero(ha[:, None] == hb[None, :])
        assert sum(n for *_, n in leakage.tiles(p, q)) == _brute_tiles(doc, item, leakage.SEED)


def test_leaks(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("가나다라마바사아자차카타파하") for _ in range(rng.randint(2, 5))) for _ in range(500)]
    item = " ".join(rng.sample(words, 60))
    other = " ".join(rng.sample(words, 60))
    w = item.split()
    texts = {1: "앞말 " + item.replace(" ", "\n").upper() + " 뒷말", 2: " ".join(w[:36]), 3: " ".join(w[:20]), 4: None, 5: "", 6: " ".join(w[:18] + ["바뀐말"] + w[19:40]), 7: "끝 " * 5000 + item, 8: " ".join(w[30:] + w[:30])}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    items = spark.createDataFrame([(10, item), (11, other), (12, None), (13, "짧다")], "item_id bigint, text string")
    found = leakage.leaks(docs, items)
    assert {(r["doc_id"], r["item_id"]) for r in found.filter(F.col("run") >= leakage.COVERAGE).collect()} == {(1, 10), (2, 10), (6, 10), (7, 10), (8, 10)}
    assert leakage.leaks(docs.limit(0), items).count() == 0


def test_leaks_of_half_an_item_with_changed_words():
    rng = random.Random(8)
    words = ["".join(rng.choice("가나다라마바사아자차카타파하거너더러머버서어저처커터퍼허") for _ in range(4)) for _ in range(200)]
    item, chance = words[:50], words[50:100]
    half = item[12:38]  # 52 % of the letters
    own = leakage.letters_of(" ".join(item))
    shared = lambda doc: leakage.shares(leakage.letters_of(" ".join(words[100:130] + doc + words[130:160])), own)[0]
    for changed in ([6], [6, 13], [6, 13, 20], [1, 8, 24]):
        assert shared([w if i not in changed else "바뀐말들" for i, w in enumerate(half)]) >= leakage.COVERAGE
    assert shared(item[:20]) < leakage.COVERAGE  # 40 %
    assert shared([item[i] if i % 4 < 2 else chance[i] for i in range(26)]) < leakage.COVERAGE  # every other pair of words


def test_leaks_of_short_tiles_and_both_ways_of_joining(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("가나다라마바사아자차카타파하") for _ in range(4)) for _ in range(700)]
    item = words[:60]
    # Every fourth word of the leaked stretch is changed, so no tile is longer than twelve letters.
    leaked = [w if i % 4 else "바뀐" + w[:1] for i, w in enumerate(item[10:50])]
    stock = " ".join(words[600:620])
    docs = [(1, " ".join(words[100:300] + leaked + words[300:350])), (1, "같은 번호"), (2, " ".join(words[100:400])), (3, " ".join(item)), (3, " ".join(item)), (4, stock + " 책꽂이"), (5, "앞 책 꽂-이! 뒤"), (6, None)]
    items = [(10, " ".join(item)), (11, " ".join(item).replace(" ", ", ")), (12, "책꽂이"), (13, None), (14, "?"), *[(100 + i, stock + " " + " ".join(words[400 + i : 402 + i])) for i in range(80)]]
    d, t = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    results = [{(r["doc_id"], r["item_id"], round(r["run"], 6)) for r in leakage.leaks(d, t, broadcast_letters=n).collect()} for n in (10**7, 0)]
    assert results[0] == results[1]
    pairs = {(a, b) for a, b, _ in results[0]}
    assert pairs == {(1, 10), (1, 11), (3, 10), (3, 11), (4, 12), (5, 12), *[(4, 100 + i) for i in range(80)]}
    assert leakage.leaks(d, t.limit(0)).count() == 0 and leakage.leaks(d.limit(0), t).count() == 0


SENTENCES = {"ko": "감축 수단별 비용을 비교한 결과 가장 적게 들었다", "en": "the council compared three routes for land use", "ja": "施工業者は配管を安い単価で計算し直しました", "zh": "施工企业以低单价更换了记录并检查", "de": "die Gemeinde will die Emissionen im Bereich senken", "fr": "le budget du conseil a été reporté pour la mairie", "es": "el municipio quiere reducir las emisiones del sector"}


def test_languages_and_wrong_labels(spark):
    rng = random.Random(1)

    def text(lang):
        chars = SENTENCES[lang]
        if " " in chars:
            words = chars.split()
            rng.shuffle(words)
            return " ".join(words)
        return chars[rng.randint(0, 5) :] + chars

    texts = [(text(lang), lang) for lang in SENTENCES for _ in range(30)]
    labels = [lang if rng.random() > 0.08 else "en" for _, lang in texts]
    model = language.fit([t for t, _ in texts], labels)
    df = spark.createDataFrame([(1, SENTENCES["ko"] + "\n\n" + SENTENCES["en"] + "\n12"), (2, SENTENCES["zh"]), (3, None), (4, "123 456\n"), (5, "")], "doc_id bigint, text string")
    got = {(r["doc_id"], r["seg"]): r["lang"] for r in language.label_lines(df, model).collect()}
    assert got[1, 1] == "ko" and got[1, 2] == "en" and got[1, 3] == got[1, 0] and got[2, 0] == "zh" and got[3, 0] is None and got[4, 0] is None and got[5, 0] is None


def test_confidence_is_calibrated():
    rng = np.random.default_rng(2)
    lead = rng.uniform(0, 2, 4000)
    hit = rng.random(4000) < 1 / (1 + np.exp(-3 * lead))
    slope, intercept = language._calibrate(lead, hit)
    assert abs(slope - 3) < 0.5 and abs(intercept) < 0.2
    slope, _ = language._calibrate(lead, np.ones(4000, bool))
    assert np.isfinite(slope) and slope > 0


@pytest.mark.parametrize("label,lang", [("한국어", "ko"), ("ko-KR", "ko"), ("ENG", "en"), ("zh-CN", "zh"), ("und", None), ("", None), (None, None), ("-", None)])
def test_labels(spark, label, lang):
    assert spark.createDataFrame([(label,)], "l string").select(language.label_language(F.col("l")).alias("x")).first()["x"] == lang


def test_training_lines_come_from_the_whole_text(spark):
    head = "12 345\n" * 600  # more than 3,000 characters and six lines without letters
    df = spark.createDataFrame([(i * 7 + k, lang, head + SENTENCES[lang]) for i in range(8) for k, lang in enumerate(SENTENCES)], "doc_id bigint, lang string, text string")
    model = language.fit_on(df)
    scores, _ = model.scores(list(SENTENCES.values()))
    assert [language.LANGUAGES[i] for i in scores.argmax(1)] == list(SENTENCES)
