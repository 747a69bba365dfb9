"""Evaluation texts leaking into training text by greedy string tiling with Karp-Rabin fingerprints (problem 9)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factsieve.functions.joins import skew_safe_join
from factsieve.functions.storage import materialize

#: Letters and digits of a seed; a tile has at least as many.
SEED = 8
#: A leak is a run of tiles that covers or spans at least this share of the item (about half of it) ...
COVERAGE = 0.485
#: ... where a span counts, changed words included, if tiles cover at least this share of it ...
DENSE = 0.8
#: ... or tiles in any order that cover this share of it in one place of the document: a reordered passage.
REORDERED = 0.9
#: Within a run, at most so many letters lie between two tiles, and the two texts differ there in length by at most DRIFT.
GAP, DRIFT = 40, 14
#: Tiles cover a good fifth of the item (half of half, less what DENSE leaves) within so many letters of one diagonal.
BAND = 64
#: A stretch of which fewer than this share of the seeds are left is no leak: a changed word costs eight seeds and those of
#: its letters, so that is a change in more than every third word.
SEED_SHARE = 0.25
#: Beside a tile, matches of so many letters count too if at most NEAR letters lie between: what is left between changed words.
FRAGMENT, NEAR = 4, 16
#: Letters kept on both sides of a place of a document for such matches.
MARGIN = 160
#: A seed that stands in more items than this finds no candidates unless an item can't be found without such seeds.
COMMON = 64
#: Items with at most so many letters together are broadcast; more are joined by a shuffle.
BROADCAST_LETTERS = 8_000_000
#: Candidate pairs a task tiles.
PAIRS_A_TASK = 20_000
#: Bits of the sieve that a document's seeds pass before anything is shuffled: 32 a seed of the items, within these powers of two.
SIEVE_POWERS = (16, 27)
_BASE, _MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
_TABLE: np.ndarray | None = None


def _table() -> np.ndarray:
    """Code point to letter or digit in lower case; 0 for all else (spacing, punctuation)."""
    global _TABLE
    if _TABLE is None:
        table = np.zeros(0x110000, dtype=np.uint32)
        for i in range(0x110000):
            ch = chr(i)
            if ch.isalnum():
                low = ch.lower()
                table[i] = ord(low) if len(low) == 1 else i
        table[0xFF10:0xFF1A], table[0xFF41:0xFF5B], table[0xFF21:0xFF3B] = np.arange(48, 58), np.arange(97, 123), np.arange(97, 123)
        _TABLE = table
    return _TABLE


def letters_of(text: str) -> np.ndarray:
    """Code points of the letters and digits of ``text`` in lower case; all else (spacing, punctuation, case) is left out."""
    codes = _table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    return codes[codes != 0].astype(np.uint64)


def _string(codes: np.ndarray) -> str:
    return codes.astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass")


def _plain(text: str) -> np.ndarray:
    """Code points of letters that ``_string`` has written."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)


def fingerprints(codes: np.ndarray, size: int = SEED) -> np.ndarray:
    """Karp-Rabin fingerprint of every run of ``size`` code points."""
    n = len(codes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for i in range(size):
        h = h * _BASE + codes[i : i + n]
    return h * _MIX


def tiles(p: np.ndarray, q: np.ndarray, size: int = SEED) -> list[tuple[int, int, int]]:
    """Greedy string tiling of a document and an item from the places (p, q) of their common seeds.

    Seeds that continue one another on a diagonal are one maximal match. The longest matches are marked first; of a match
    that overlaps marked text on either side the free parts stay in play if they keep the length of a seed. Returns
    (place in document, place in item, length), in document order.
    """
    shift = p - q
    order = np.lexsort((q, shift))
    p, q, shift = p[order], q[order], shift[order]
    cut = np.flatnonzero((np.diff(shift) != 0) | (np.diff(q) != 1)) + 1
    starts, ends = np.concatenate(([0], cut)), np.concatenate((cut, [len(p)]))
    queue: dict[int, list[tuple[int, int]]] = {}
    for a, b in zip(starts, ends):
        queue.setdefault(int(q[b - 1] - q[a]) + size, []).append((int(p[a]), int(q[a])))
    in_doc, in_item = np.zeros(int(p.max()) + size + 1, bool), np.zeros(int(q.max()) + size + 1, bool)
    marked = []
    while queue:
        n = max(queue)
        for dp, iq in sorted(queue.pop(n)):
            taken = in_doc[dp : dp + n] | in_item[iq : iq + n]
            if not taken.any():
                in_doc[dp : dp + n] = in_item[iq : iq + n] = True
                marked.append((dp, iq, n))
                continue
            free = np.flatnonzero(~taken)
            if len(free) < size:
                continue
            for part in np.split(free, np.flatnonzero(np.diff(free) != 1) + 1):
                if size <= len(part) < n:
                    queue.setdefault(len(part), []).append((dp + int(part[0]), iq + int(part[0])))
    return sorted(marked)


def with_fragments(found: list[tuple[int, int, int]], codes: np.ndarray, own: np.ndarray) -> list[tuple[int, int, int]]:
    """The tiles and, beside them, matches too short for a seed that neither text has marked yet, in document order."""
    in_doc, in_item = np.zeros(len(codes), bool), np.zeros(len(own), bool)
    for p, q, n in found:
        in_doc[p : p + n] = in_item[q : q + n] = True
    out, queue = list(found), [(t, ahead) for t in found for ahead in (True, False)]
    while queue:
        (p, q, n), ahead = queue.pop()
        reach = NEAR + FRAGMENT
        i, j = (p + n, q + n) if ahead else (max(p - reach, 0), max(q - reach, 0))
        i_end, j_end = (min(i + reach, len(codes)), min(j + reach, len(own))) if ahead else (p, q)
        same = (codes[i:i_end, None] == own[None, j:j_end]) & ~in_doc[i:i_end, None] & ~in_item[None, j:j_end]
        if min(same.shape, default=0) < FRAGMENT:
            continue
        rows, columns = same.shape[0] - FRAGMENT + 1, same.shape[1] - FRAGMENT + 1
        at = np.argwhere(np.logical_and.reduce([same[k : k + rows, k : k + columns] for k in range(FRAGMENT)]))
        # Places between the tile and the match, in either text.
        off = at if ahead else np.array([i_end - i, j_end - j]) - FRAGMENT - at
        at = at[(abs(off[:, 0] - off[:, 1]) <= DRIFT) & (off.max(axis=1, initial=0) <= NEAR)]
        if not len(at):
            continue
        x, y = (i + int(at[0 if ahead else -1][0]), j + int(at[0 if ahead else -1][1]))
        length = FRAGMENT
        while x + length < len(codes) and y + length < len(own) and codes[x + length] == own[y + length] and not (in_doc[x + length] or in_item[y + length]):
            length += 1
        while x and y and codes[x - 1] == own[y - 1] and not (in_doc[x - 1] or in_item[y - 1]):
            x, y, length = x - 1, y - 1, length + 1
        in_doc[x : x + length] = in_item[y : y + length] = True
        out.append((x, y, length))
        queue += [((x, y, length), True), ((x, y, length), False)]
    return sorted(out)


def longest_run(found: list[tuple[int, int, int]], dense: float = DENSE) -> int:
    """Most letters of the item in a run of tiles that follow one another in both texts with small gaps of like length.

    The letters are those from the first tile to the last, what was changed between them included, where the tiles cover
    ``dense`` of them, else those covered.
    """
    most = 0
    for first, (_, begin, _) in enumerate(found):
        best = {first: found[first][2]}
        for j in range(first, len(found)):
            p, q, n = found[j]
            for i in range(j - 1, first - 1, -1):
                before, at, length = found[i]
                gap, other = p - before - length, q - at - length
                if gap > 4 * GAP:
                    break
                if i in best and 0 <= gap <= GAP and 0 <= other <= GAP and abs(gap - other) <= DRIFT:
                    best[j] = max(best.get(j, 0), best[i] + n)
            if j in best:
                span = q + n - begin
                most = max(most, span if best[j] >= dense * span else best[j])
            elif p - found[max(best)][0] > 4 * GAP + found[max(best)][2]:
                break
    return most


def best_window(found: list[tuple[int, int, int]], item_length: int) -> int:
    """Most letters covered by tiles, in any order, within one window of the document a tenth longer than the item."""
    start, length = np.array([t[0] for t in found]), np.array([t[2] for t in found])
    total = np.concatenate(([0], np.cumsum(length)))
    last = np.searchsorted(start + length, start + int(item_length * 1.1) + 16, side="right")
    return int((total[np.maximum(last, np.arange(len(found)))] - total[np.arange(len(found))]).max())


def least_seeds(size: int, least: float) -> int:
    """Seeds that a leak of an item of ``size`` letters holds at least: SEED_SHARE of the stretch."""
    return max(1, int(np.floor(size * least * SEED_SHARE)))


def ranked_seeds(own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An item's distinct fingerprints in rising order, where the places of each begin, and all places in that order."""
    prints = fingerprints(own)
    order = np.argsort(prints, kind="stable")
    keys, begin = np.unique(prints[order], return_index=True)
    return keys, np.append(begin, len(prints)), order


def covered(q: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Letters of the item under the seeds at places ``q`` of each ``part``, numbered from 0: no tiling covers more."""
    order = np.lexsort((q, part))
    q, part = q[order], part[order]
    last = np.append(part[1:] != part[:-1], True)
    return np.bincount(part, weights=np.where(last, SEED, np.minimum(np.append(np.diff(q), SEED), SEED)))


def shares(codes: np.ndarray, own: np.ndarray, least: float = COVERAGE, prints: np.ndarray | None = None, ranked: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None) -> tuple[float, float]:
    """(run, window) shares of an item's letters ``own`` that tiles in a document's letters ``codes`` cover; zero where a
    run can't reach ``least`` or a window REORDERED.

    Only seeds that lie in a window, a tenth longer than the item, with as many as a leak needs take part. A run counts if
    it comes to half of ``least`` before fragments are added, and tiles cover DENSE of it. That share must be reached
    within BAND letters of one diagonal, or a tenth of the item be all that is left uncovered; else nothing is tiled.
    """
    size = len(own)
    prints = fingerprints(codes) if prints is None else prints
    keys, begin, at = ranked_seeds(own) if ranked is None else ranked
    need = least_seeds(size, least)
    if not len(keys) or not len(prints):
        return 0.0, 0.0
    where = np.minimum(np.searchsorted(keys, prints), len(keys) - 1)
    hit = np.flatnonzero(keys[where] == prints)
    if len(hit) < need:
        return 0.0, 0.0
    # Places (p, q) at which both have the same seed, in order of p.
    first = begin[where[hit]]
    count = begin[where[hit] + 1] - first
    p = np.repeat(hit, count)
    q = at[np.repeat(first, count) + np.arange(len(p)) - np.repeat(np.cumsum(count) - count, count)]
    window = np.searchsorted(hit, hit + int(size * 1.1) + 16) - np.arange(len(hit))
    near = np.flatnonzero(window >= need)
    if not len(near):
        return 0.0, 0.0
    mask = np.zeros(len(hit) + 1, np.int64)
    np.add.at(mask, near, 1)
    np.add.at(mask, near + window[near], -1)
    inside = np.repeat(np.cumsum(mask[:-1]) > 0, count)
    p, q = p[inside], q[inside]
    # What a run covers lies without a gap too long in the document and, for the most part, near one diagonal.
    part = np.concatenate(([0], np.cumsum(np.diff(p) > GAP + SEED)))
    bands = [(p - q + len(own) + i * BAND) // (2 * BAND) for i in range(2)]
    most = max(covered(q, np.unique(part * (1 << 32) + band, return_inverse=True)[1]).max() for band in bands)
    if most < size * least / 2 * DENSE and covered(q, np.zeros(len(q), np.int64))[0] < size * REORDERED:
        return 0.0, 0.0
    found = tiles(p, q)
    run, whole = longest_run(found) / size, best_window(found, size) / size
    if least / 2 <= run < least:
        run = longest_run(with_fragments(found, codes, own)) / size
    return run, whole


def places(doc_ids: list, texts: list[str], sieve: np.ndarray, power: int, apart: int, least: int, size: int = SEED) -> Iterator[tuple[int, str, np.ndarray]]:
    """(document, letters, distinct seeds) of every place of the texts with at least ``least`` seeds that pass the sieve.

    Seeds more than ``apart`` letters apart belong to different places. All texts are searched at once; a place keeps
    MARGIN letters on both sides.
    """
    codes = _table()[np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    keep = codes != 0
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])[keep]
    codes = codes[keep].astype(np.uint64)
    prints = fingerprints(codes, size)
    if not len(prints):
        return
    slot = prints >> np.uint64(64 - power)
    passed = (sieve[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1)
    at = np.flatnonzero((passed == 1) & (owner[: len(prints)] == owner[size - 1 :]))
    if not len(at):
        return
    cut = np.flatnonzero((np.diff(at) > apart) | (np.diff(owner[at]) != 0)) + 1
    starts, ends = np.concatenate(([0], cut)), np.concatenate((cut, [len(at)]))
    bounds = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(texts)))))
    for a, b in zip(starts, ends):
        if b - a >= least:
            doc = owner[at[a]]
            lo, hi = max(bounds[doc], at[a] - MARGIN), min(bounds[doc + 1], at[b - 1] + size + MARGIN)
            yield doc_ids[doc], _string(codes[lo:hi]), np.unique(prints[at[a:b]]).view(np.int64)


def item_letters(items: DataFrame) -> DataFrame:
    """(item_id, letters, n_letters) of the items that have a letter or digit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_string(letters_of(t)) if t else "" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["item_id", "letters"])

    rows = items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").mapInArrow(run, "item_id bigint, letters string").filter("letters != ''")
    return materialize(rows.withColumn("n_letters", F.length("letters")), "items")


def seeds_of(classes: DataFrame, size: int = SEED) -> DataFrame:
    """(class_id, seed, places): the distinct seeds of each class with their number of places in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(fingerprints(_plain(t), size), return_counts=True) for t in batch.column(1).to_pylist()]
            ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), [len(h) for h, _ in found])
            seed = np.concatenate([h for h, _ in found]) if found else np.zeros(0, np.uint64)
            n = np.concatenate([c for _, c in found]) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(seed.view(np.int64)), pa.array(n, pa.int32())], names=["class_id", "seed", "places"])

    return classes.select("class_id", "letters").mapInArrow(run, "class_id bigint, seed bigint, places int")


def make_sieve(seeds: DataFrame, n_seeds: int) -> tuple[np.ndarray, int]:
    """A bitmap of the seeds' leading bits, put together in words by the executors; its size is fixed by SIEVE_POWERS."""
    power = int(np.clip(np.ceil(np.log2(max(n_seeds, 1) * 32)), *SIEVE_POWERS))
    slot = F.shiftrightunsigned("seed", 64 - power)
    words = seeds.groupBy(F.shiftright(slot, 6).cast("int").alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), slot.bitwiseAND(63).cast("int"))).alias("bits")).toArrow()
    sieve = np.zeros(max(1, (1 << power) >> 6), np.uint64)
    sieve[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return sieve, power


def find_places(documents: DataFrame, seeds: DataFrame, n_seeds: int, apart: int, least: int, size: int = SEED, block: int = 1 << 20) -> DataFrame:
    """(place BIGINT, doc_id, letters, seeds ARRAY<BIGINT>) of all documents: their one pass, ``block`` characters at a time."""
    sieve, power = make_sieve(seeds, n_seeds)
    shared = documents.sparkSession.sparkContext.broadcast(sieve)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(ids: list, texts: list[str]) -> pa.RecordBatch:
            rows = list(places(ids, texts, shared.value, power, apart, least, size))
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.list_(pa.int64()))], names=["doc_id", "letters", "seeds"])

        for batch in batches:
            ids, texts, held = [], [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text:
                    ids.append(doc)
                    texts.append(text)
                    held += len(text)
                    if held >= block:
                        yield found(ids, texts)
                        ids, texts, held = [], [], 0
            yield found(ids, texts)

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, letters string, seeds array<bigint>")
    return materialize(rows.select(F.xxhash64("doc_id", "letters").alias("place"), "doc_id", "letters", "seeds"), "places")


def _whole_in(documents: DataFrame, short: DataFrame) -> DataFrame:
    """(doc_id, class_id, run, share): items with fewer letters than a seed, which count only where they stand whole."""
    out = None
    for n in [r["n_letters"] for r in short.select("n_letters").distinct().orderBy("n_letters").collect()]:  # below SEED
        seeds = materialize(seeds_of(short.filter(F.col("n_letters") == n), n), "whole")
        found = find_places(documents, seeds, seeds.count(), 0, 1, n)
        part = found.select("doc_id", F.explode("seeds").alias("seed")).join(seeds, "seed").select("doc_id", "class_id", F.lit(1.0).alias("run"), F.lit(1.0).alias("share")).distinct()
        out = part if out is None else out.unionByName(part)
    return out


def _by_joins(documents: DataFrame, seeds: DataFrame, used: DataFrame, long: DataFrame, least: float, longest: int, shortest: int) -> DataFrame:
    """(doc_id, class_id, run, share) of the candidates, found by joins on seeds: for items too many to broadcast.

    What passes the sieve is kept with the letters around it, so the documents' texts are neither read again nor shuffled.
    """
    spark = documents.sparkSession
    apart = SEED + max(GAP, int(np.ceil((2.1 - 2 * REORDERED) * longest)) + 16)
    near = find_places(documents, seeds, seeds.count(), apart, min(least_seeds(shortest, least), 1 << 30))
    hits = near.select("place", F.explode("seeds").alias("seed")).join(used, "seed")
    wanted = hits.groupBy("place", "class_id").agg(F.sum("places").alias("n"), F.max("need").alias("need")).filter("n >= need").select("place", "class_id")
    wanted = materialize(wanted, "candidates")
    weights = wanted.groupBy("class_id").agg(F.count("*").alias("n"))
    pairs = skew_safe_join(wanted, weights.join(long.select("class_id", F.col("letters").alias("own")), "class_id"), "class_id", "n").drop("n")
    pairs = near.select("place", "doc_id", "letters").join(pairs, "place").select("doc_id", "class_id", "letters", "own")
    # Tiling a pair costs far more than its bytes tell, so the pairs are spread by their number.
    pairs = pairs.repartition(max(spark.sparkContext.defaultParallelism, wanted.count() // PAIRS_A_TASK), "doc_id", "class_id")

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [shares(_plain(a), _plain(b), least) for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array([g[i] for g in got], pa.float64()) for i in range(2)]], names=["doc_id", "class_id", "run", "share"])

    return pairs.mapInArrow(tile, "doc_id bigint, class_id bigint, run double, share double")


def candidates(prints: np.ndarray, owner: np.ndarray, index: tuple[np.ndarray, ...], need: np.ndarray, sizes: np.ndarray, least: float) -> Iterator[tuple[int, int, int, int]]:
    """(document, item, first and last place) of the pairs that ``shares`` would tile, found for several documents at once.

    ``prints`` are the fingerprints at all places of the documents, ``owner`` the document of each; ``index`` has the
    seeds, where the rows of each begin, and the item and place of each row. An item needs ``need`` seeds in a window.
    """
    keys, begin, item, place = index
    where = np.minimum(np.searchsorted(keys, prints), max(len(keys) - 1, 0))
    at = np.flatnonzero(keys[where] == prints) if len(keys) else np.zeros(0, np.int64)
    if not len(at):
        return
    where = where[at]
    count = begin[where + 1] - begin[where]
    p = np.repeat(at, count)
    row = np.repeat(begin[where], count) + np.arange(len(p)) - np.repeat(np.cumsum(count) - count, count)
    pair = (owner[p] - owner[at[0]]) * len(need) + item[row]
    kept = np.flatnonzero((np.bincount(pair) >= need[np.arange(pair.max() + 1) % len(need)])[pair])
    if not len(kept):
        return
    kept = kept[np.argsort(pair[kept], kind="stable")]
    pair, p, row = pair[kept], p[kept], row[kept]
    found, q = item[row], place[row]
    reach = (sizes * 1.1).astype(np.int64) + 16
    line = pair * np.int64(len(prints) + int(reach.max()) + 1) + p
    end = np.searchsorted(line, line + reach[found])
    dense = np.flatnonzero(end - np.arange(len(line)) >= need[found])
    if not len(dense):
        return
    mask = np.bincount(dense, minlength=len(line) + 1) - np.bincount(end[dense], minlength=len(line) + 1)
    inside = np.flatnonzero(np.cumsum(mask[:-1]) > 0)
    pair, p, q, found = pair[inside], p[inside], q[inside], found[inside]
    number = np.concatenate(([0], np.cumsum(pair[1:] != pair[:-1])))
    starts = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
    size = sizes[found[starts]]
    width, origin = int(sizes.max()) + 1, p[starts][number]
    good = np.zeros(len(starts), bool)
    for shift, share in ((0, least / 2 * DENSE), (BAND, least / 2 * DENSE), (None, REORDERED)):
        band = np.zeros(len(p), np.int64) if shift is None else (p - origin - q + width + shift) // (2 * BAND)
        bands = int(band.max()) + 1
        line = np.sort((number * bands + band) * width + q)
        group = line // width
        last = np.append(group[1:] != group[:-1], True)
        cover = np.add.reduceat(np.where(last, SEED, np.minimum(np.append(np.diff(line), SEED), SEED)), np.concatenate(([0], np.flatnonzero(last)[:-1] + 1)))
        good[(group[last] // bands)[cover >= size[group[last] // bands] * share]] = True
    ends = np.append(starts[1:], len(p)) - 1
    for i in np.flatnonzero(good):
        yield int(owner[p[starts[i]]]), int(found[starts[i]]), int(p[starts[i]]), int(p[ends[i]])


def _seed_rows(hashes: np.ndarray, item: np.ndarray, ranked: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Seeds in rising order, where the rows of each begin, and the item and place of every row."""
    pieces = []
    for i in np.unique(item):
        keys, begin, at = ranked[i]
        mine = np.searchsorted(keys, hashes[item == i])
        pieces += [(keys[k], i, at[begin[k] : begin[k + 1]]) for k in mine]
    sizes = [len(at) for *_, at in pieces]
    h = np.repeat(np.array([k for k, *_ in pieces], np.uint64), sizes)
    order = np.argsort(h, kind="stable")
    keys, begin = np.unique(h[order], return_index=True)
    items = np.repeat(np.array([i for _, i, _ in pieces], np.int64), sizes)[order]
    return keys, np.append(begin, len(h)), items, np.concatenate([at for *_, at in pieces])[order] if pieces else np.zeros(0, np.int64)


def _in_one_pass(documents: DataFrame, used: DataFrame, rules: DataFrame, long: DataFrame, least: float, block: int = 1 << 18) -> DataFrame:
    """(doc_id, class_id, run, share) of the candidates, found in one pass over the documents with the items broadcast.

    For items of at most BROADCAST_LETTERS letters; ``block`` characters of documents are searched at once.
    """
    own = {r["class_id"]: r["letters"] for r in long.select("class_id", "letters").collect()}
    needs = {r["class_id"]: r["need"] for r in rules.select("class_id", "need").collect()}
    rows = used.select("seed", "class_id").toArrow()
    ids = np.array(sorted(own), np.int64)
    hashes = rows.column("seed").to_numpy().view(np.uint64)
    item = np.searchsorted(ids, rows.column("class_id").to_numpy())
    shared = documents.sparkSession.sparkContext.broadcast((hashes, item, np.array([needs[i] for i in ids.tolist()], np.int64), [own[i] for i in ids.tolist()], ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, item, need, texts_of_items, ids = shared.value
        letters = [_plain(t) for t in texts_of_items]
        ranked = [ranked_seeds(c) for c in letters]
        sizes = np.array([len(c) for c in letters], np.int64)
        index = _seed_rows(hashes, item, ranked)

        def leaks_in(docs: list, texts: list[str]) -> list[tuple[int, int, float, float]]:
            codes = _table()[np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
            keep = codes != 0
            owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])[keep]
            codes = codes[keep].astype(np.uint64)
            prints = fingerprints(codes)
            prints[owner[: len(prints)] != owner[SEED - 1 :][: len(prints)]] = 0  # they span two documents
            bounds = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(texts)))))
            out = []
            for doc, i, lo, hi in candidates(prints, owner, index, need, sizes, least):
                around = int(sizes[i] * 1.1) + 16 + MARGIN
                lo, hi = max(int(bounds[doc]), lo - around), min(int(bounds[doc + 1]), hi + SEED + around)
                out.append((docs[doc], int(ids[i]), *shares(codes[lo:hi], letters[i], least, prints[lo : max(lo, hi - SEED + 1)], ranked[i])))
            return out

        for batch in batches:
            docs, texts, held, found = [], [], 0, []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text:
                    docs.append(doc)
                    texts.append(text)
                    held += len(text)
                    if held >= block:
                        found += leaks_in(docs, texts)
                        docs, texts, held = [], [], 0
            if docs:
                found += leaks_in(docs, texts)
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.float64()))], names=["doc_id", "class_id", "run", "share"])

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, class_id bigint, run double, share double")


def leaks(documents: DataFrame, items: DataFrame, least: float = COVERAGE, broadcast_letters: int = BROADCAST_LETTERS) -> DataFrame:
    """(doc_id, item_id, run DOUBLE, share DOUBLE) of all documents and items with a run of ``least`` or a share of REORDERED.

    ``run`` is the share covered in order by the longest run of tiles, ``share`` that covered in any order in one place (0
    below REORDERED).
    Documents are read once. Their seeds meet the items' by equality; an item is a candidate for a place with as many of
    its seeds as any leak has (``least_seeds``), and only candidates are tiled. A seed that more than COMMON items share
    takes part only for the items that consist of such seeds to that extent; the threshold of the others is lowered by the
    number of theirs, so no leak is lost. Items of at most ``broadcast_letters`` letters together are broadcast, more are
    joined by shuffles, with the same result. Items alike in letters are searched once. Items with fewer letters than a
    seed count where they stand whole. Null and empty texts contain nothing; repeated rows of a document or an item give
    each pair once, with its highest shares.
    """
    spark = documents.sparkSession
    own = item_letters(items)
    classes = materialize(own.groupBy("letters", "n_letters").agg(F.min("item_id").alias("class_id")), "classes")
    members = own.join(classes.select("letters", "class_id"), "letters").select("class_id", "item_id").distinct()
    long, short = classes.filter(F.col("n_letters") >= SEED), classes.filter(F.col("n_letters") < SEED)
    sizes = classes.agg(F.coalesce(F.sum("n_letters"), F.lit(0)).alias("all"), F.max("n_letters").alias("longest"), F.min(F.when(F.col("n_letters") >= SEED, F.col("n_letters"))).alias("shortest"), F.count_if(F.col("n_letters") < SEED).alias("short")).first()
    small = sizes["all"] <= broadcast_letters
    hint = F.broadcast if small else lambda df: df
    found = spark.createDataFrame([], "doc_id bigint, class_id bigint, run double, share double")
    if sizes["shortest"]:
        seeds = materialize(seeds_of(long), "seeds")
        common = seeds.groupBy("seed").agg(F.count("*").alias("n")).filter(F.col("n") > COMMON).select("seed", F.lit(True).alias("common"))
        marked = seeds.join(common, "seed", "left").withColumn("common", F.coalesce("common", F.lit(False)))
        floor = F.greatest(F.lit(1), F.floor(F.col("n_letters") * F.lit(float(least)) * SEED_SHARE).cast("int"))
        rules = marked.groupBy("class_id").agg(F.sum(F.when(F.col("common"), F.col("places")).otherwise(0)).alias("n_common")).join(long.select("class_id", floor.alias("floor")), "class_id")
        rules = materialize(rules.select("class_id", (F.col("n_common") >= F.col("floor")).alias("stock"), F.when(F.col("n_common") >= F.col("floor"), F.col("floor")).otherwise(F.col("floor") - F.col("n_common")).alias("need")), "rules")
        used = marked.join(hint(rules), "class_id").filter("stock OR NOT common").select("seed", "class_id", "places", "need")
        if small:
            tiled = _in_one_pass(documents, used, rules, long, least)
        else:
            tiled = _by_joins(documents, seeds, used, long, least, sizes["longest"], sizes["shortest"])
        tiled = tiled.filter((F.col("run") >= least) | (F.col("share") >= REORDERED))
        found = tiled.groupBy("doc_id", "class_id").agg(F.max("run").alias("run"), F.max("share").alias("share"))
    if sizes["short"]:
        found = found.unionByName(_whole_in(documents, short))
    return found.join(hint(members), "class_id").select("doc_id", "item_id", "run", "share")
