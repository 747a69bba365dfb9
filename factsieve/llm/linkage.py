"""Matching entities across sources without keys: probabilistic record linkage (problem 3)."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factsieve.functions.joins import broadcast_if_small, skew_safe_join
from factsieve.functions.storage import materialize
from factsieve.functions.text import plain
from factsieve.llm.mapping import letters

#: Words of the field that are used for one another; the first of each line stands for all.
SYNONYMS = """
led 엘이디
iot 사물인터넷
ev 전기차
히트펌프 hp
페트 pet
ess 에너지저장장치
bems 빌딩에너지관리시스템
햇빛발전 태양광발전
무공해차 친환경차
마을버스 동네버스
청사 관청
연립주택 빌라
공동주택 아파트
휴경농지 묵은밭
경로당 노인정
갯벌 개펄
조명 전등
공영주차장 공용주차장
산단 산업단지
커피찌꺼기 커피박
하수슬러지 하수찌꺼기
음식쓰레기 음식물쓰레기
매립장 매립지
창호 창문
교체 대체
설치 구축
보강 강화
보조 지원
복원 회복
공공도서관 도서관
""".split("\n")
#: Words about place, phase or funding that leave the undertaking what it is.
REMARKS = r"홍보 ?병행|[0-9]차|[0-9]단계|계속|신규|시범|확대|추진|국고보조|국비보조|지원사업|보조사업|조성공사(?=$)|사업(?=$)|공사(?=$)"
PLACE = r"^[가-힣]{2,4}(?:읍|면|동|지구|마을)(?: |(?=[가-힣a-z0-9]{5}))"


def compose(df: DataFrame, column: str) -> DataFrame:
    """``column`` with conjoining letters and combining marks composed; only rows that have any go to Python."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            i = batch.schema.get_field_index(column)
            texts = pa.array([unicodedata.normalize("NFC", t) for t in batch.column(i).to_pylist()], pa.string())
            yield batch.set_column(i, batch.schema.field(i), texts)

    has = F.coalesce(F.col(column).rlike(r"[\x{300}-\x{36f}\x{1100}-\x{11ff}]"), F.lit(False))
    return df.filter(~has).unionByName(df.filter(has).mapInArrow(run, df.schema))


def undertaking(name: Column) -> Column:
    """A project name without look-alikes, bullets, number, place and remarks; words parted by single spaces."""
    out = F.regexp_replace(F.lower(plain(name)), r"[^0-9a-z가-힣à-ÿ]+", " ")
    out = F.regexp_replace(F.trim(out), r" ?제? ?[0-9]+ ?호$| [0-9]+$", "")
    out = F.regexp_replace(out, REMARKS, " ")
    out = F.trim(F.regexp_replace(out, r"\s+", " "))
    out = F.regexp_replace(out, PLACE, "")
    # Once more: words that stood before another remark.
    return F.trim(F.regexp_replace(F.regexp_replace(out, r"(?:조성공사|사업|공사)$", ""), r"\s+", " "))


def standard(text: Column) -> Column:
    """Each synonym as the first word of its line, then all words as one."""
    out = F.regexp_replace(text, " ", "")
    for line in SYNONYMS:
        first, *others = line.split()[:1] + line.split()[1:] if line.split() else ("",)
        for other in others:
            if first.endswith(other):
                out = F.regexp_replace(out, f"(?<!{first[: -len(other)]}){other}", first)
            elif other.startswith(first):
                out = F.regexp_replace(out, other, first)
            else:
                out = F.regexp_replace(out, other, first)
    return out


def shingles(text: Column, n: int = 3) -> Column:
    """Distinct runs of n letters of a spelled-out text."""
    size = F.length(text)
    return F.when(size >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), size - (n - 1)), lambda i: text.substr(i, F.lit(n))))).otherwise(F.array(text))


def block_keys(spelled: Column) -> Column:
    """Keys of several passes, each named by its pass: first letters, last letters, and every run of seven letters."""
    tag = lambda p, x: F.concat(F.lit(p), x)
    runs = F.transform(shingles(spelled, 7), lambda x: tag("r", x))
    return F.array_distinct(F.concat(F.array(tag("a", F.substring(spelled, 1, 5)), tag("z", F.right(spelled, F.lit(5)))), runs))


#: Lower ends of the agreement levels of three shares: of the name's runs of letters that the entry has, of the entry's that
#: the name has, and of the name's syllables that the entry has, which typing errors and exchanged words hardly lower.
NAME_LEVELS, ENTRY_LEVELS, SYLLABLE_LEVELS = (0.72, 0.85), (0.5, 0.75), (0.72, 0.85)
LEVELS = (3, 3, 3, 3, 2)


def _level(share: Column, ends: tuple[float, ...]) -> Column:
    return sum(((share >= e).cast("int") for e in ends), F.lit(0))


def compare_names(names: DataFrame, entries: DataFrame) -> DataFrame:
    """(name, entry, explained, shown, syllables) of the pairs that share a block; ``entries`` is a factor list of fixed size."""
    left = names.select("name", standard(F.col("name")).alias("_ls")).withColumn("_l", letters(F.col("_ls")))
    right = entries.select("entry", standard(undertaking(F.col("entry"))).alias("_rs")).distinct().withColumn("_r", letters(F.col("_rs")))
    lk = left.select("name", "_ls", "_l", F.explode(block_keys(F.col("_l"))).alias("_k"))
    rk = right.select("entry", "_rs", "_r", F.explode(block_keys(F.col("_r"))).alias("_k"))
    pairs = lk.join(broadcast_if_small(rk), "_k").select("name", "_ls", "_l", "entry", "_rs", "_r").distinct()
    a, b = shingles(F.col("_l")), shingles(F.col("_r"))
    common = F.size(F.array_intersect(a, b))
    mine = F.array_distinct(F.split("_ls", ""))
    same = F.size(F.array_intersect(mine, F.split("_rs", ""))) / F.size(mine)
    return pairs.select("name", "entry", (common / F.size(a)).alias("explained"), (common / F.size(b)).alias("shown"), same.alias("syllables"))


def fit_weights(counts: dict[tuple[int, ...], float], levels: tuple[int, ...], start: float = 0.2, rounds: int = 100) -> dict[tuple[int, ...], float]:
    """Expectation-maximisation of match and non-match probabilities over counted agreement patterns.

    ``counts`` gives the number of pairs of each pattern, ``levels`` the number of levels of each comparison, higher ones
    agreeing better. Comparisons are independent given match or non-match. Returns the posterior of every pattern.
    """
    if not counts:
        return {}
    patterns = np.array(list(counts))
    weight = np.array(list(counts.values()), dtype=float)
    m = [np.arange(1, n + 1, dtype=float) ** 2 for n in levels]
    u = [np.arange(n, 0, -1, dtype=float) ** 2 for n in levels]
    m, u, prior = [x / x.sum() for x in m], [x / x.sum() for x in u], start
    for _ in range(rounds):
        yes = np.log(prior) + sum(np.log(m[i][patterns[:, i]]) for i in range(len(levels)))
        no = np.log1p(-prior) + sum(np.log(u[i][patterns[:, i]]) for i in range(len(levels)))
        post = 1 / (1 + np.exp(np.clip(no - yes, -500, 500)))
        for side, share in ((m, weight * post), (u, weight * (1 - post))):
            for i, n in enumerate(levels):
                total = np.bincount(patterns[:, i], weights=share, minlength=n) + 0.5
                side[i] = total / total.sum()
        prior = float(np.clip((weight * post).sum() / weight.sum(), 1e-6, 1 - 1e-6))
    return {tuple(int(x) for x in p): float(v) for p, v in zip(patterns, post)}


def _combo(*columns: str) -> Column:
    """128-bit key of a combination of values."""
    return F.unhex(F.md5(F.to_json(F.struct(*columns)))).alias("combo")


def link(rows: DataFrame, entries: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(row_id, unit_no, confidence): financing rows and the factor entries of the same undertaking, with the posterior.

    ``rows`` has row_id, name, sector (null: none stated) and year; ``entries``, a list of fixed size, unit_no, entry,
    sector, first and last (null: open). Names, sectors and years are compared by level for every distinct combination;
    the estimation runs over the counts of all of them. Of the entries of a combination only the one with the highest
    posterior over all five comparisons is kept; it applies only if its years hold the row's (checked exactly, as is the
    sector where the row has one).
    Null and blank names and null years give no row.
    """
    spark = rows.sparkSession
    named = rows.filter(F.col("name").isNotNull())
    raw = compose(named.groupBy("name").agg(F.count("*").alias("n")).withColumn("as_stored", F.col("name")), "name")
    raw = materialize(raw.select("as_stored", "n", undertaking(F.col("name")).alias("base")).filter("base != ''"), "names")
    bases = raw.groupBy("base").agg(F.sum("n").alias("n"))
    scored = materialize(compare_names(bases.select(F.col("base").alias("name")), entries).withColumnRenamed("name", "base"), "pairs")
    # A row's name by its undertaking, kept with the fields that are compared.
    coded = materialize(skew_safe_join(named.select("row_id", F.col("name").alias("as_stored"), "sector", "year"), raw.select("as_stored", "base", "n"), "as_stored", "n").select("row_id", "base", "sector", "year"), "coded")
    combos = coded.groupBy("base", "sector", "year").agg(F.count("*").alias("n"))
    sides = entries.groupBy("entry").agg(F.collect_set("sector").alias("sectors"), F.min("first").alias("first"), F.max(F.coalesce("last", F.lit(9999))).alias("last"))
    weights = scored.groupBy("base").agg(F.count("*").alias("_w"))
    known = skew_safe_join(combos, weights, "base", "_w").drop("_w")
    pairs = known.join(scored.join(broadcast_if_small(sides), "entry"), "base")
    sector_level = F.when(F.col("sector").isNull(), 1).when(F.array_contains("sectors", F.col("sector")), 2).otherwise(0)
    year_level = F.coalesce(F.col("year").between(F.col("first"), F.col("last")), F.lit(False)).cast("int")
    name_level, entry_level, syllable_level = _level(F.col("explained"), NAME_LEVELS), _level(F.col("shown"), ENTRY_LEVELS), _level(F.col("syllables"), SYLLABLE_LEVELS)
    patterns = pairs.groupBy(name_level.alias("a"), entry_level.alias("b"), syllable_level.alias("e"), sector_level.alias("c"), year_level.alias("d")).agg(F.count("*").alias("n"))
    counted = {(r["a"], r["b"], r["e"], r["c"], r["d"]): float(r["n"]) for r in patterns.collect()}  # at most the product of LEVELS
    posterior = fit_weights(counted, LEVELS)
    verdicts = spark.createDataFrame([(*p, v) for p, v in posterior.items()], "a INT, b INT, e INT, c INT, d INT, confidence DOUBLE")
    # Every combination of name, sector and year takes the entry of the highest posterior; ties go to the larger shares.
    level = {"a": name_level, "b": entry_level, "e": syllable_level, "c": sector_level, "d": year_level}
    judged = pairs.withColumns(level).join(F.broadcast(verdicts), list(level))
    order = F.struct("confidence", (F.col("explained") + F.col("shown") + F.col("syllables")).alias("s"), "entry")
    best = judged.groupBy("base", "sector", "year").agg(F.max_by(F.struct("entry", "confidence"), order).alias("top"), F.first("n").alias("n"))
    best = best.filter(F.col("top.confidence") >= threshold).select(_combo("base", "sector", "year"), "n", "top.*")
    units = entries.select("unit_no", "entry", F.col("sector").alias("_sector"), "first", "last")
    exact = (F.col("_sector") == F.coalesce("sector", "_sector")) & (F.col("year") >= F.col("first")) & (F.col("year") <= F.coalesce("last", F.lit(9999)))
    applied = skew_safe_join(coded.select("*", _combo("base", "sector", "year")), best, "combo", "n").join(broadcast_if_small(units), "entry").filter(exact)
    return applied.select("row_id", "unit_no", "confidence")
