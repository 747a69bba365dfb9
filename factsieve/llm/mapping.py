"""Mapping free-entered values to a canonical list by a partition-based pigeonhole join (problem 2). SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factsieve.functions.joins import BROADCAST_ROWS, broadcast_if_small, skew_safe_join
from factsieve.functions.storage import materialize

#: Letters of the two-set Korean keyboard in the order of the Unicode syllable blocks.
INITIALS = "ㄱ ㄲ ㄴ ㄷ ㄸ ㄹ ㅁ ㅂ ㅃ ㅅ ㅆ ㅇ ㅈ ㅉ ㅊ ㅋ ㅌ ㅍ ㅎ".split()
VOWELS = "ㅏ ㅐ ㅑ ㅒ ㅓ ㅔ ㅕ ㅖ ㅗ ㅘ ㅙ ㅚ ㅛ ㅜ ㅝ ㅞ ㅟ ㅠ ㅡ ㅢ ㅣ".split()
FINALS = ["", *"ㄱ ㄲ ㄳ ㄴ ㄵ ㄶ ㄷ ㄹ ㄺ ㄻ ㄼ ㄽ ㄾ ㄿ ㅀ ㅁ ㅂ ㅄ ㅅ ㅆ ㅇ ㅈ ㅊ ㅋ ㅌ ㅍ ㅎ".split()]
INITIAL_KEYS = "r r s e e f a q q t t d w w c z x v g".split()
VOWEL_KEYS = "k o i o j p u p h hk ho hl y n nj np nl b m ml l".split()
FINAL_KEYS = ["", *"r r rt s sw sg e f fr fa fq ft fx fv fg a q qt t t d w c z x v g".split()]


def _spell(text: Column, first: list[str], middle: list[str], last: list[str]) -> Column:
    part = lambda table, i: F.element_at(F.array(*[F.lit(x) for x in table]), i.cast("int") + 1)

    def one(c: Column) -> Column:
        code = F.ascii(c) - 44032
        spelled = F.concat(part(first, F.floor(code / 588)), part(middle, F.floor((code % 588) / 28)), part(last, code % 28))
        return F.when((code >= 0) & (code < 11172), spelled).otherwise(c)

    return F.array_join(F.transform(F.split(text, ""), one), "")


def letters(text: Column) -> Column:
    """Hangul syllables spelled out in their letters, other characters as they are."""
    return _spell(text, INITIALS, VOWELS, FINALS)


def keystrokes(text: Column) -> Column:
    """What an English keyboard gives when the text is typed on it as on a Korean one, in lower case."""
    return _spell(text, INITIAL_KEYS, VOWEL_KEYS, FINAL_KEYS)


def segments(refs: DataFrame, k: Column) -> DataFrame:
    """Cut each reference form into k + 1 segments: (_ref, _form, _l, _k, _i, _p, _m, _piece) with _p from 1."""
    length = F.length("form")
    base = refs.select(F.col("ref_id").alias("_ref"), F.col("form").alias("_form"), length.alias("_l"), F.least(k, F.greatest(length - 1, F.lit(0))).alias("_k"))
    cut = base.select("*", F.explode(F.sequence(F.lit(0), F.col("_k"))).alias("_i"))
    size, longer = F.floor(F.col("_l") / (F.col("_k") + 1)), F.col("_l") % (F.col("_k") + 1)
    # The last `longer` segments are one character longer than the first ones.
    extra = F.greatest(F.lit(0), F.col("_i") - (F.col("_k") + 1 - longer))
    placed = cut.select("*", (F.col("_i") * size + extra + 1).cast("int").alias("_p"), (size + F.when(F.col("_i") >= F.col("_k") + 1 - longer, 1).otherwise(0)).cast("int").alias("_m"))
    return placed.withColumn("_piece", F.col("_form").substr(F.col("_p"), F.col("_m")))


def fits_broadcast(refs: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a count finds at most ``rows`` entries, so that the list and what is cut from it may be broadcast."""
    return refs.limit(rows + 1).count() <= rows


def pigeonhole_join(values: DataFrame, refs: DataFrame, k: Column, broadcast: bool | None = None) -> DataFrame:
    """All pairs (value columns, ref_id, ref_form, d) with levenshtein(form, ref_form) = d at most k(length of ref_form).

    If at most k edits lead from a reference to a value, one of its k + 1 segments stands unchanged in the value, and of
    those that do there is one with no more edits to its left than segments there, nor to its right; so segment i has moved
    by at most i places from the left end and k - i from the right end, and an equality join on (length, segment,
    substring) loses no pair. The built-in levenshtein verifies. The list's segments are broadcast where it is short (by
    a count, unless ``broadcast`` says), else joined by a shuffle; the probes of a value depend only on the lengths in the
    list and come from an equality join on its own length. A reference form needs at least one more character than edits;
    empty and null forms match nothing; repeated values give their pairs once.
    """
    hint = F.broadcast if (fits_broadcast(refs) if broadcast is None else broadcast) else lambda df: df
    pieces = segments(refs.filter(F.length("form") > 0), k)
    layout = pieces.select("_l", "_k", "_i", "_p", "_m").distinct()
    lengths = F.sequence(F.greatest(F.lit(1), F.col("_l") - F.col("_k")), F.col("_l") + F.col("_k"))
    moved, right = F.col("_n") - F.col("_l"), F.col("_k") - F.col("_i")
    sized = layout.withColumn("_n", F.explode(lengths)).select("*", F.greatest(F.lit(1), F.col("_p") - F.col("_i"), F.col("_p") + moved - right).alias("_from"), F.least(F.col("_n") - F.col("_m") + 1, F.col("_p") + F.col("_i"), F.col("_p") + moved + right).alias("_to"))
    probes = sized.filter("_from <= _to").select("_l", "_i", "_m", "_n", F.explode(F.sequence("_from", "_to")).alias("_at"))
    probed = values.withColumn("_n", F.length("form")).join(F.broadcast(probes), "_n").withColumn("_piece", F.col("form").substr(F.col("_at"), F.col("_m")))
    seg = pieces.select("_l", "_i", "_piece", "_ref", "_form", "_k")
    pairs = probed.join(hint(seg), ["_l", "_i", "_piece"]).select(*values.columns, F.col("_ref").alias("ref_id"), F.col("_form").alias("ref_form"), "_k").distinct()
    return pairs.withColumn("d", F.levenshtein("form", "ref_form")).filter("d <= _k").drop("_k")


def swapped(chars: Column) -> Column:
    """All forms of an array of characters with one neighbouring pair exchanged."""
    n = F.size(chars)
    swap = lambda i: F.array_join(F.concat(F.slice(chars, 1, i - 1), F.array(F.get(chars, i), F.get(chars, i - 1)), F.slice(chars, i + 2, n)), "")
    return F.when(n > 2, F.transform(F.sequence(F.lit(1), n - 1), swap)).otherwise(F.array().cast("array<string>"))


BULLETS = r"^(?:\s*(?:[0-9]+(?:-[0-9]+)?[.)]?(?=[\s가-힣a-z])|\([가-하a-z0-9]\)|[a-z0-9가-하]\)|[가-하]\.|[-○●■□▶•·*※ㅇ])\s*)+"


def sector_forms(value: Column) -> Column:
    """Array of plain forms of a typed sector: without numbering, brackets and the words for sector; each side of a slash."""
    text = F.regexp_replace(F.lower(F.trim(value)), BULLETS, "")
    text = F.regexp_replace(text, r"\(계\)|[\[\]()<>「」]", "")

    def tidy(part: Column) -> Column:
        out = F.regexp_replace(F.trim(part), r"(?<=\S)\s*(?:부문|분야|쪽|\bsector)\.?$", "")
        return F.regexp_replace(out, r"[\s\p{Z}\p{P}]+", "")

    return F.filter(F.array_distinct(F.transform(F.split(text, "/"), tidy)), lambda x: x != "")


#: Words for carrying out a project that are used for one another.
SAME_WORK = {"만들기": "조성", "변경": "전환", "마련": "구축", "구매": "도입", "운용": "운영", "추가설치": "증설", "시공": "설치", "가입": "참여", "대체": "교체"}
PLACE = r"^(?:[가-힣]{2,4}(?:읍|면|동|시|군|구|지구|마을)\s+)+"
PLACE_LAST = r"\s+[가-힣]{2,4}(?:읍|면|동|시|지구|마을)$"
PLACE_GLUED = r"^[가-힣]{2,3}(?:읍|면|동|지구|마을|[내들섬늪뫼울터곶실골숲]?[시군구])"


#: Letters by which a form may get shorter where a word for the same work replaces its last one.
SHORTENED = max(len(word) - len(same) for word, same in SAME_WORK.items())


def project_forms(value: Column, shortest: int, longest: int, heads: list[int]) -> Column:
    """Array of plain forms of a typed project name, none longer than the name: without bullets, marks, places and trailing words, in every rotation of its words.

    All rotations of a name have its number of letters, so they are made only where that lies between ``shortest`` and
    ``longest``, outside which no entry of the list can match. A name without spaces may have its first word at its end;
    it is turned by each of the lengths ``heads`` of the entries' first words.
    """
    text = F.regexp_replace(F.lower(F.trim(value)), r"\[?\(?(?:계속|신규)\)?\]?", " ")
    text = F.regexp_replace(F.trim(text), BULLETS, "")
    text = F.regexp_replace(text, r"(?:\s*(?:[0-9]+\)|[-.,:;*]|등|사업|지원|추진|확대))+\s*$", "")
    plain = F.trim(F.regexp_replace(text, r"[\p{P}\s\p{Z}]+", " "))
    bare = F.regexp_replace(F.regexp_replace(plain, PLACE, ""), PLACE_LAST, "")
    glued = F.regexp_replace(bare, PLACE_GLUED, "")

    def rotations(t: Column) -> Column:
        words, joined = F.split(t, " "), F.regexp_replace(t, " ", "")
        n, size = F.size(words), F.length(joined)
        turn = lambda i: F.array_join(F.concat(F.slice(words, i + 1, n), F.slice(words, 1, i)), "")
        cut = lambda h: F.when(size > h, F.concat(F.right(t, h), t.substr(F.lit(1), size - h))).otherwise(t)
        lengths = F.array(*[F.lit(h) for h in heads]).cast("array<int>")
        turned = F.when(n == 1, F.concat(F.array(t), F.transform(lengths, cut))).otherwise(F.transform(F.sequence(F.lit(0), n - 1), turn))
        return F.when((size >= shortest) & (size <= longest), turned).otherwise(F.array(joined))

    joined = F.array_distinct(F.concat(F.array(F.regexp_replace(plain, " ", "")), rotations(bare), F.array(F.regexp_replace(glued, " ", ""))))
    return F.filter(joined, lambda x: x != "")


def limit_by_length(short: int, long: int) -> Column:
    """Edits allowed for a reference form: one up to ``short`` characters, two up to ``long``, three beyond."""
    n = F.length("form")
    return F.when(n <= short, 1).when(n <= long, 2).otherwise(3)


def _spread(values: DataFrame) -> DataFrame:
    """The stored values over all cores: the forms of a value are many times its bytes."""
    tasks = max(values.sparkSession.sparkContext.defaultParallelism, values.count() // 50_000)
    return values.repartition(tasks, "value")


def _best(pairs: DataFrame, popularity: DataFrame | None = None) -> DataFrame:
    """(value, ref_id): the nearest entry of each value, ties to the entry typed exactly most often, then the smallest id."""
    if popularity is not None:
        pairs = pairs.join(popularity, "ref_id", "left")
    else:
        pairs = pairs.withColumn("uses", F.lit(0))
    return pairs.groupBy("value").agg(F.min_by("ref_id", F.struct("d", -F.coalesce("uses", F.lit(0)), "ref_id")).alias("ref_id"))


def map_values(rows: DataFrame, exact: DataFrame, matched: DataFrame) -> DataFrame:
    """(row columns, ref_id): ``matched`` (value, ref_id, n) joined back; values that mean no entry come by an anti-join."""
    matched = materialize(matched, "matched")  # read twice below
    free = rows.join(broadcast_if_small(exact.select("value")), "value", "left_anti")
    hits = skew_safe_join(free, matched, "value", "n")
    misses = free.join(matched.select("value"), "value", "left_anti").withColumn("ref_id", F.lit("UNMATCHED"))
    return hits.drop("n").unionByName(misses.select(*hits.drop("n").columns))


def distinct_values(rows: DataFrame, exact: DataFrame) -> DataFrame:
    """(value, n): the typed values that stand for something and aren't exactly an entry."""
    counted = rows.groupBy("value").agg(F.count("*").alias("n"))
    return materialize(counted.join(broadcast_if_small(exact.select("value")), "value", "left_anti"), "values")


def match_sectors(values: DataFrame, sectors: DataFrame, popularity: DataFrame) -> DataFrame:
    """(value, ref_id, n) for the typed sectors that mean an entry of ``sectors`` (ref_id, name, english)."""
    squeeze = lambda c: F.regexp_replace(F.lower(c), r"[\s\p{Z}\p{P}]+", "")
    core = sectors.select("ref_id", squeeze(F.col("name")).alias("ko"), squeeze(F.col("english")).alias("en"))
    refs = core.select("ref_id", F.explode(F.array(letters(F.col("ko")), keystrokes(F.col("ko")), F.col("en"))).alias("form")).distinct()
    short = fits_broadcast(sectors)
    forms = _spread(values).select("value", "n", F.explode(sector_forms(F.col("value"))).alias("core"))
    near = pigeonhole_join(forms.select("value", letters(F.col("core")).alias("form")).distinct(), refs, limit_by_length(7, 11), short).select("value", "ref_id", "d")
    # One exchanged pair of neighbouring characters counts as one edit; plain equality finds it.
    swaps = forms.select("value", F.explode(swapped(F.split("core", ""))).alias("form"))
    whole = core.select("ref_id", F.explode(F.array("ko", "en")).alias("form"))
    exchanged = swaps.join(F.broadcast(whole) if short else whole, "form").select("value", "ref_id", F.lit(1).alias("d"))
    return values.join(_best(near.unionByName(exchanged), popularity), "value")


def match_projects(values: DataFrame, catalog: DataFrame, k: int = 4) -> DataFrame:
    """(value, ref_id, n) for the typed project names that mean an entry of ``catalog`` (ref_id, name).

    Pairs within k syllables are found by the pigeonhole join and ranked by letters. The place that a project name begins
    with must itself agree within two letters, share half of its syllables or be
    its first two, as the same work at another place is another project.
    """
    squeeze = lambda c: F.regexp_replace(F.lower(c), r"[\s\p{Z}\p{P}]+", "")
    refs = catalog.select("ref_id", squeeze(F.col("name")).alias("form"), F.split(F.lower("name"), " ")[0].alias("head"))
    short = fits_broadcast(refs)
    head = F.length("head")
    sizes = refs.agg(F.min(F.length("form")).alias("lo"), F.max(F.length("form")).alias("hi"), F.array_sort(F.collect_set(head)).alias("heads")).first()
    lo, hi = (sizes["lo"] or 1) - k, (sizes["hi"] or 0) + k + SHORTENED
    forms = _spread(values).select("value", F.explode(project_forms(F.col("value"), lo, hi, [h for h in sizes["heads"] if h > 1])).alias("form"))
    for word, standard in SAME_WORK.items():
        forms = forms.withColumn("form", F.regexp_replace("form", f"{word}$", standard))
    forms = forms.withColumn("form", F.regexp_replace("form", "엘이디", "led"))
    pairs = pigeonhole_join(forms.distinct(), refs.select("ref_id", "form"), F.lit(k), short)
    heads = refs.select("ref_id", "head")
    pairs = pairs.join(F.broadcast(heads) if short else heads, "ref_id")
    start = F.substring("form", 1, F.length("head"))
    near = F.levenshtein(letters(start), letters(F.col("head"))) <= 2
    shared = F.size(F.array_intersect(F.split(start, ""), F.split("head", ""))) * 2 >= F.length("head")
    begins = F.substring("form", 1, 2) == F.substring("head", 1, 2)
    pairs = pairs.filter(near | shared | begins).withColumn("d", F.levenshtein(letters(F.col("form")), letters(F.col("ref_form"))))
    return values.join(_best(pairs.select("value", "ref_id", "d")), "value")
