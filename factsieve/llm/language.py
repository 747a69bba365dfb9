"""Document and line languages by string kernels with Nyström landmarks and kernel ridge regression (problem 10)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LANGUAGES = ["ko", "en", "ja", "zh", "de", "fr", "es"]
#: Other spellings of a language in a label, in lower case.
SPELLINGS = {
    "ko": "ko kor korean 한국어 국문 한글",
    "en": "en eng english 영어 영문",
    "ja": "ja jp jpn japanese 日本語 일본어",
    "zh": "zh zho chi cn chinese 中文 중국어",
    "de": "de deu ger german deutsch 독일어",
    "fr": "fr fra fre french français francais 프랑스어",
    "es": "es spa spanish español espanol 스페인어",
}
#: Hashed dimensions of the n-gram space; n-grams of one to MAX_N characters count by presence.
DIMENSIONS = 1 << 15
MAX_N = 3
#: Documents with a recognised label that the classifier is fitted on, at most (in expectation), and landmarks a language.
MAX_TRAINING_DOCUMENTS = 3000
#: Training texts: so many whole lines of a document at most, chosen by hash over the whole text.
TRAINING_LINES = 6
LANDMARKS = 40
RIDGE = 1e-2
#: Lines without a letter take the language of their document.
MIN_LETTERS = 1


def label_language(label: Column) -> Column:
    """The language a label names, however spelled; null where it names none."""
    names = {w: lang for lang, words in SPELLINGS.items() for w in words.split()}
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    key = F.lower(F.trim(label))
    return F.coalesce(F.element_at(table, key), F.element_at(table, F.regexp_extract(key, "^([a-z]{2,3})[-_]", 1)))


_KEEP: np.ndarray | None = None


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, one after another, and the number of the text each belongs to.

    Lower case, digits as one sign and any run of other signs as one space, a space before and after each text.
    """
    global _KEEP
    if _KEEP is None:
        table = np.full(0x110000, 32, dtype=np.uint32)
        for i in range(0x110000):
            ch = chr(i)
            if ch.isalpha() and not 0xD800 <= i < 0xE000:
                low = ch.lower()
                table[i] = ord(low) if len(low) == 1 else i
            elif ch.isdigit():
                table[i] = 48
        _KEEP = table
    joined = " " + "  ".join(texts) + " "
    codes = _KEEP[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)].astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), [len(t) + 2 for t in texts])
    repeated = (codes[1:] == codes[:-1]) & ((codes[1:] == 32) | (codes[1:] == 48)) & (owner[1:] == owner[:-1])
    keep = np.concatenate(([True], ~repeated))
    return codes[keep], owner[keep]


def features(texts: list[str], block: int = 256) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Presence features of a batch as rows of a sparse matrix: (indices, starts, letters per text)."""
    indices, sizes, letters = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at in range(0, len(texts), block):
        part = texts[at : at + block]
        c, owner = _codes(part)
        present = np.zeros(len(part) * DIMENSIONS, bool)
        for n in range(1, MAX_N + 1):
            if len(c) < n:
                break
            inside = owner[: len(c) - n + 1] == owner[n - 1 :]
            h = np.zeros(len(c) - n + 1, dtype=np.uint64)
            for i in range(n):
                h = h * np.uint64(0x100000001B3) + c[i : len(c) - n + 1 + i]
            ids = ((h + np.uint64(n if n > 1 else 0)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - 15)).astype(np.int64)
            present[(owner[: len(ids)] * DIMENSIONS + ids)[inside]] = True
        flat = np.flatnonzero(present)
        indices.append(flat % DIMENSIONS)
        sizes.append(np.bincount(flat // DIMENSIONS, minlength=len(part)))
        letters.append(np.bincount(owner[(c != 32) & (c != 48)], minlength=len(part)))
    size = np.concatenate(sizes)
    return np.concatenate(indices), np.concatenate(([0], np.cumsum(size)[:-1])).astype(np.int64) if len(size) else size, np.concatenate(letters)


def _dense(texts: list[str]) -> np.ndarray:
    ids, starts, _ = features(texts)
    sizes = np.diff(np.append(starts, len(ids)))
    x = np.zeros((len(texts), DIMENSIONS), dtype=np.float32)
    x[np.repeat(np.arange(len(texts)), sizes), ids] = 1
    return x / np.sqrt(sizes)[:, None].astype(np.float32)


@dataclass(frozen=True)
class LanguageModel:
    """Weights (dimensions x languages): the landmarks' dual coefficients carried over to the n-gram space; and the slope
    and intercept of the calibrated confidence."""

    weights: np.ndarray
    slope: float = 4.0
    intercept: float = 0.0

    def confidence(self, lead: np.ndarray) -> np.ndarray:
        """Probability that the best language is right, from its lead over the second."""
        return 1 / (1 + np.exp(-np.clip(self.slope * lead + self.intercept, -500, 500)))

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """One-versus-rest scores of a batch by one product of its sparse presence matrix, and letters per text."""
        if not texts:
            return np.zeros((0, len(LANGUAGES))), np.zeros(0, np.int64)
        ids, starts, letters = features(texts)
        sizes = np.diff(np.append(starts, len(ids)))
        return np.add.reduceat(self.weights[ids], starts, axis=0) / np.sqrt(sizes)[:, None], letters


def fit(texts: list[str], labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE, seed: int = 5) -> LanguageModel:
    """Kernel ridge regression on Nyström features, one language against the rest, classes weighted alike.

    The confidence is calibrated on every fifth text, scored by a model of the others.

    The kernel of two texts is the number of n-grams both have over the geometric mean of their numbers. A first fit
    finds the training texts whose label it contradicts; the second is made without them, so wrong labels don't count.
    """
    rng = np.random.default_rng(seed)
    y = np.array([LANGUAGES.index(v) for v in labels])
    ids, starts, _ = features(texts)
    ends = np.append(starts, len(ids))[1:]

    def products(rows: np.ndarray, matrix: np.ndarray) -> np.ndarray:
        """The sparse rows of some texts, of length one, times a dense matrix, in blocks."""
        out = np.zeros((len(rows), matrix.shape[1]), np.float32)
        for at in range(0, len(rows), 64):
            part = rows[at : at + 64]
            sizes = ends[part] - starts[part]
            flat = np.concatenate([ids[a:b] for a, b in zip(starts[part], ends[part])])
            out[at : at + 64] = np.add.reduceat(matrix[flat], np.concatenate(([0], np.cumsum(sizes)[:-1])), axis=0) / np.sqrt(sizes)[:, None]
        return out

    def solve(rows: np.ndarray) -> LanguageModel:
        present = np.unique(y[rows])
        chosen = np.concatenate([rng.permutation(rows[y[rows] == i])[:landmarks] for i in present])
        z = _dense([texts[i] for i in chosen])
        values, vectors = np.linalg.eigh((z @ z.T).astype(np.float64))
        inverse_root = vectors / np.sqrt(np.maximum(values, 1e-8)) @ vectors.T
        # Kernel rows against the landmarks are sparse products: only the landmarks' own matrix is held whole.
        phi = products(rows, np.ascontiguousarray(z.T)).astype(np.float64) @ inverse_root
        target = np.where(y[rows][:, None] == np.arange(len(LANGUAGES)), 1.0, -1.0)
        per_class = np.bincount(y[rows], minlength=len(LANGUAGES))
        weight = (len(rows) / np.maximum(per_class, 1) / len(present))[y[rows]][:, None]
        dual = np.linalg.solve(phi.T @ (weight * phi) + ridge * len(rows) * np.eye(phi.shape[1]), phi.T @ (weight * target))
        return LanguageModel((z.T @ (inverse_root @ dual).astype(np.float32)).astype(np.float32))

    if not texts:
        return LanguageModel(np.zeros((DIMENSIONS, len(LANGUAGES)), np.float32))
    everything = np.arange(len(y))
    first = solve(everything)
    best = products(everything, first.weights).argmax(1)
    agreed = everything[best == y] if (best == y).any() else everything
    held = agreed[np.arange(len(agreed)) % 5 == 0]
    kept = np.setdiff1d(agreed, held)
    final = solve(agreed)
    if not len(kept) or len(np.unique(y[kept])) < 2:
        return final
    part = solve(kept)
    scores = products(held, part.weights)
    ranked = np.sort(scores, axis=1)
    return LanguageModel(final.weights, *_calibrate(ranked[:, -1] - ranked[:, -2], scores.argmax(1) == y[held]))


def _calibrate(lead: np.ndarray, hit: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and intercept of the logistic regression of hits on leads, by Newton's method.

    Two made-up pairs of a hit and a miss with no lead keep it finite where every text was a hit.
    """
    x = np.column_stack([np.append(lead, np.zeros(4)), np.ones(len(lead) + 4)])
    target = np.append(hit.astype(float), [1, 0, 1, 0])
    beta = np.array([4.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -500, 500)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (target - p) - 1e-3 * beta)
        beta = beta + np.clip(step, -5, 5)
        if abs(step).max() < 1e-6:
            break
    return float(max(beta[0], 0.0)), float(beta[1])


def fit_on(documents: DataFrame, max_documents: int = MAX_TRAINING_DOCUMENTS) -> LanguageModel:
    """Fit on lines of a bounded sample of the documents with a recognised label, evenly over the languages.

    The documents of a language are taken by the smallest hash of their id up to a seventh of the bound, whatever the
    size of the corpus; the training texts are at most TRAINING_LINES whole lines with six letters or more, those of the
    smallest hash wherever in the document they stand. The counts read no text, so the texts are read once here.
    """
    labelled = documents.select("doc_id", label_language(F.col("lang")).alias("label"), "text").filter(F.col("label").isNotNull())
    counts = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}  # at most seven rows
    each = max_documents // len(LANGUAGES)
    share = F.create_map(*[F.lit(x) for l, n in counts.items() for x in (l, min(1.0, each / n) * 1e6)])  # noqa: E741
    sample = labelled.filter(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_000)) < F.element_at(share, F.col("label"))) if counts else labelled
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"(?:\p{L}[^\p{L}]*){6}"))
    chosen = F.slice(F.array_sort(F.transform(lines, lambda x, i: F.struct(F.xxhash64(x, i).alias("h"), x.alias("line")))), 1, TRAINING_LINES)
    rows = sample.filter(F.col("text").isNotNull()).select("doc_id", "label", chosen["line"].alias("lines")).orderBy("doc_id").collect()  # bounded above
    texts = [line for r in rows for line in r["lines"]]
    labels = [r["label"] for r in rows for _ in r["lines"]]
    return fit(texts, labels)


def label_lines(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, seg INT, lang, confidence DOUBLE): seg 0 the whole document, then its non-blank lines in order.

    Every line of the whole text is scored. A document's language is the one with most letters over its lines; lines
    without a letter, and with them empty documents, follow it; where no line has letters the language is null with
    confidence 0. Confidence is the calibrated logistic of the lead over the second language, for a document weighted by
    letters.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)  # a matrix of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(ids), 256):
                yield _label(own, ids[at : at + 256], texts[at : at + 256])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id bigint, seg int, lang string, confidence double")


def _label(model: LanguageModel, ids: list[int], texts: list[str | None]) -> pa.RecordBatch:
    lines, owner = [], []
    for i, text in enumerate(texts):
        for line in (text or "").splitlines():
            if line.strip():
                lines.append(line)
                owner.append(i)
    scores, letters = model.scores(lines)
    order = np.argsort(scores, axis=1) if len(lines) else np.zeros((0, 2), int)
    every = np.arange(len(lines))
    sure = model.confidence(scores[every, order[:, -1]] - scores[every, order[:, -2]])
    out: dict[str, list] = {"doc_id": [], "seg": [], "lang": [], "confidence": []}
    at = 0
    for i, doc in enumerate(ids):
        mine = []
        while at < len(lines) and owner[at] == i:
            mine.append(at)
            at += 1
        total = np.zeros(len(LANGUAGES))
        for k in mine:
            if letters[k] >= MIN_LETTERS:
                total[order[k, -1]] += letters[k]
        main = int(total.argmax()) if total.any() else None
        rows = []
        for seg, k in enumerate(mine, 1):
            if letters[k] >= MIN_LETTERS or main is None:
                rows.append((seg, None if main is None else LANGUAGES[order[k, -1]], 0.0 if main is None else float(sure[k])))
            else:
                rows.append((seg, LANGUAGES[main], 0.5))
        whole = float(sum(c * letters[k] for (_, l, c), k in zip(rows, mine) if main is not None and l == LANGUAGES[main]) / max(total.sum(), 1))  # noqa: E741
        for seg, lang, confidence in [(0, None if main is None else LANGUAGES[main], whole), *rows]:
            out["doc_id"].append(doc)
            out["seg"].append(seg)
            out["lang"].append(lang)
            out["confidence"].append(confidence)
    return pa.RecordBatch.from_arrays([pa.array(out["doc_id"], pa.int64()), pa.array(out["seg"], pa.int32()), pa.array(out["lang"], pa.string()), pa.array(out["confidence"], pa.float64())], names=list(out))
