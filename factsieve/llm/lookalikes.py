"""Visually identical text with different characters: look-alike classes, their representatives, and a rewriter (problem 4)."""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factsieve.functions.joins import skew_safe_join
from factsieve.functions.storage import materialize

#: Cyrillic, Greek and Armenian letters drawn like the Latin letter at the same place.
DRAWN_ALIKE = ("АВЕКМНОРСТХаеорсухіјѕһԁԛԝϹϲΑΒΕΖΗΙΚΜΝΟΡΤΥΧοЅІЈ", "ABEKMHOPCTXaeopcyxijshdqwCcABEZHIKMNOPTYXoSIJ")
#: Further characters drawn alike.
ALSO = [("ѵ", "v"), ("ν", "v"), ("ӏ", "l"), ("ɑ", "a"), ("ı", "i"), ("ɡ", "g"), ("У", "Y"), ("Ү", "Y"), ("ү", "y"), ("օ", "o"), ("ո", "n"), ("ս", "u"), ("հ", "h"), ("‧", "·"), ("・", "·"), ("ㆍ", "·"), ("ᆞ", "·")]
#: Kinds of compatibility decomposition that print the same sign; <square>, <super>, <sub> and others visibly differ.
SAME_KINDS = ("<wide>", "<narrow>", "<noBreak>")


class UnionFind:
    """Disjoint sets of strings."""

    def __init__(self) -> None:
        self.parent: dict[str, str] = {}

    def find(self, x: str) -> str:
        self.parent.setdefault(x, x)
        root = x
        while self.parent[root] != root:
            root = self.parent[root]
        while self.parent[x] != root:
            self.parent[x], x = root, self.parent[x]
        return root

    def union(self, x: str, y: str) -> None:
        self.parent[self.find(x)] = self.find(y)

    def classes(self) -> list[list[str]]:
        out: dict[str, list[str]] = {}
        for x in self.parent:
            out.setdefault(self.find(x), []).append(x)
        return list(out.values())


@lru_cache(maxsize=1)
def lookalike_classes() -> list[list[str]]:
    """Transitive classes of strings and code points that print alike, by rule from the Unicode character data.

    Joined are: a code point and its wide, narrow or no-break counterpart; a Roman numeral and the letters it is drawn
    with; special spaces and the space; characters that print nothing and the empty string; letters of other scripts drawn
    alike; a composed character and every sequence of base and marks in which the base is any member of its class. The alphabet bounds the size.
    """
    sets = UnionFind()
    composed: list[tuple[str, str, str]] = []
    for code in range(0x110000):
        if 0xD800 <= code < 0xE000 or 0xAC00 <= code <= 0xD7A3:
            continue
        ch = chr(code)
        category = unicodedata.category(ch)
        if category == "Zs" and ch not in " \u1680":
            sets.union(ch, " ")
            continue
        if category == "Cf" and not 0x600 <= code <= 0x8FF and code < 0xE0000 or code in (0x34F, 0x115F, 0x1160, 0x3164, 0xFFA0) or 0xFE00 <= code <= 0xFE0F:
            sets.union(ch, "")
            continue
        kind, _, rest = unicodedata.decomposition(ch).partition(" ")
        if kind in SAME_KINDS or kind == "<compat>" and category == "Nl":
            sets.union(ch, "".join(chr(int(x, 16)) for x in rest.split()))
        elif kind and kind[0] != "<":
            full = unicodedata.normalize("NFD", ch)
            if len(full) == 1:
                sets.union(ch, full)
            else:
                composed.append((ch, full[0], full[1:]))
    for a, b in [*zip(*DRAWN_ALIKE), *ALSO]:
        sets.union(a, b)
    alike: dict[str, list[str]] = {x: c for c in sets.classes() for x in c}
    for ch, base, marks in composed:
        for b in alike.get(base, [base]):
            if len(b) == 1:
                sets.union(b + marks, ch)
                sets.union(unicodedata.normalize("NFC", b + marks), ch)
    for code in range(0xAC00, 0xD7A4):  # Hangul syllables and their conjoining letters
        sets.union(unicodedata.normalize("NFD", chr(code)), chr(code))
        if (code - 0xAC00) % 28:  # an open syllable and a final letter
            sets.union(chr(code - (code - 0xAC00) % 28) + chr(0x11A7 + (code - 0xAC00) % 28), chr(code))
    return [c for c in sets.classes() if len(c) > 1]


def representatives(counts: dict[str, int]) -> dict[str, str]:
    """{member: representative} of the classes with an observed member: its observed code points that aren't it, and all of
    its sequences, as a sequence may only come about when a character within it is taken out.

    A sequence that represents its class stands in the rules, so that the longest match keeps it whole.

    The representative is the member most often stored; ties go to the shortest, then the smallest code points. A
    class that holds the empty string is represented by it.
    """
    out = {}
    for members in lookalike_classes():
        seen = [m for m in members if counts.get(m)]
        if not seen:
            continue
        best = "" if "" in members else min(seen, key=lambda m: (-counts[m], len(m), m))
        out.update({m: best for m in members if len(m) > 1 or m != best and counts.get(m)})
    return out


def _automaton(words: Iterator[str] | list[str]) -> ahocorasick.Automaton:
    tree = ahocorasick.Automaton()
    for w in words:
        if w:
            tree.add_word(w, w)
    tree.make_automaton()
    return tree


def rewrite(text: str, rules: dict[str, str], tree: ahocorasick.Automaton) -> str:
    """Replace, from the left, the longest member that starts there, until nothing changes."""
    for _ in range(len(text) + 1):
        out, at = [], 0
        for end, word in tree.iter_long(text):
            out += [text[at : end - len(word) + 1], rules[word]]
            at = end + 1
        new = "".join(out) + text[at:]
        if new == text or not out:
            return new
        text = new
    return text


@lru_cache(maxsize=1)
def _sequences() -> tuple[dict[str, int], frozenset[str]]:
    """The members of more than one code point, and the code points at which they go on after the first."""
    words = {m: 1 for c in lookalike_classes() for m in c if len(m) > 1}
    return words, frozenset(ch for w in words for ch in w[1:])


def count_members(texts: DataFrame, column: str) -> dict[str, int]:
    """Occurrences of every class member over all rows of ``texts``.

    Each task sends the counts of its distinct code points and sequences, so what is gathered is bounded by the
    alphabet, not by the rows.
    """

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, later = _sequences()
        members = {m for c in lookalike_classes() for m in c}
        trie, total = None, Counter()
        for batch in found:
            column_of_text = [t for t in batch.column(0).to_pylist() if t]
            singles = Counter("".join(column_of_text))
            total.update({ch: n for ch, n in singles.items() if ch in members})
            if not later.isdisjoint(singles):
                trie = trie or _automaton(words)
                for t in column_of_text:
                    if not t.isascii() and not later.isdisjoint(t):
                        for _, word in trie.iter_long(t):
                            total[word] += 1
        yield pa.RecordBatch.from_pydict({"m": pa.array(list(total), pa.string()), "n": pa.array(list(total.values()), pa.int64())})

    rows = texts.select(column).filter(F.col(column).isNotNull()).mapInArrow(run, "m string, n bigint")
    return {r["m"]: r["n"] for r in rows.groupBy("m").agg(F.sum("n").alias("n")).collect()}


def trigger_pattern(rules: dict[str, str]) -> str:
    """A Java pattern that finds every text in which a rule could apply: a changed code point or one that goes on a sequence."""
    marks = {w[0] if len(w) == 1 else w[-1] for w in rules}
    return "[" + "".join(f"\\x{{{ord(ch):x}}}" for ch in sorted(marks)) + "]" if marks else "(?!)"


def consistent_form(df: DataFrame, column: str, rules: dict[str, str]) -> Column:
    """Expression: ``column`` with every look-alike replaced by its class's representative. Null stays null."""
    shared = df.sparkSession.sparkContext.broadcast(rules)  # bounded by the alphabet

    @F.arrow_udf("string")
    def apply(texts: pa.Array) -> pa.Array:
        own = shared.value
        # What prints nothing goes first, as it may stand within a sequence.
        erased = {ord(w): None for w, to in own.items() if not to}
        tree = _automaton(list(own))
        memo: dict[str, str] = {}
        out = []
        for t in texts.to_pylist():
            if t is not None and t not in memo:
                memo[t] = rewrite(t.translate(erased), own, tree)
            out.append(None if t is None else memo[t])
        return pa.array(out, pa.string())

    return apply(F.col(column)) if rules else F.col(column)


def find_variants(rows: DataFrame, rules: dict[str, str]) -> DataFrame:
    """(src, row_id_a, row_id_b): rows whose text is a variant of plainly stored text of their scope, with its first row.

    ``rows`` has src, row_id, scope BINARY (the rows among which texts are compared) and text. Only rows in which a
    rule may apply go to Python; the others are plain as they are. Null scopes and texts that become blank give no
    case. Plain texts are reduced to their smallest id before the shuffle, and the join is balanced by the number of
    variants of each text.
    """
    rows = rows.filter(F.col("text").isNotNull() & F.col("scope").isNotNull())
    changed = F.col("text").rlike(trigger_pattern(rules))
    key = lambda text: F.unhex(F.md5(F.concat(F.hex("scope"), F.lit("\u0001"), text)))
    plain = rows.filter(~changed).select("src", "row_id", key(F.col("text")).alias("key"), F.lit(0).alias("variant"))
    # The rewriter's one pass is stored, as what it gives is read several times below.
    maybe = materialize(rows.filter(changed).select("src", "row_id", "scope", "text", consistent_form(rows, "text", rules).alias("form")), "forms")
    maybe = maybe.select("src", "row_id", F.when(F.trim("form") != "", key(F.col("form"))).alias("key"), (F.col("form") != F.col("text")).cast("int").alias("variant"))
    both = plain.unionByName(maybe).filter(F.col("key").isNotNull())
    stored = both.groupBy("key").agg(F.min(F.when(F.col("variant") == 0, F.col("row_id"))).alias("first"), F.sum("variant").alias("n")).filter("first IS NOT NULL AND n > 0")
    found = skew_safe_join(maybe.filter("key IS NOT NULL AND variant = 1").select("src", "row_id", "key"), stored, "key", "n")
    return found.select("src", F.least("row_id", "first").alias("row_id_a"), F.greatest("row_id", "first").alias("row_id_b"))
