"""Filling fixed-capacity containers: bounded-space online best-fit of documents into training sequences (problem 8)."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factsieve.functions.storage import materialize

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
CAPACITY = 2048
#: Open bins a lane; when one more is needed, the fullest closes.
OPEN_BINS = 64
#: Tokens a lane packs; the number of lanes grows with the corpus, the work of one lane does not.
LANE_TOKENS = 4_000_000


def token_counts(documents: DataFrame, id_col: str, text_col: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """(id, n_tokens BIGINT) of whole texts under a byte-level tokenizer read from ``vocabulary``; null text has none.

    The driver reads the vocabulary, a file of fixed size, and sends it to the executors once.
    """
    import public_tokenizers

    with open(vocabulary, "rb") as f:
        shared = documents.sparkSession.sparkContext.broadcast((f.read(), public_tokenizers.PATTERN))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        content, pattern = shared.value
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
        encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            sizes = [len(encoding.encode_ordinary(t)) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], names=["id", "n_tokens"])

    return documents.select(F.col(id_col).cast("bigint").alias("id"), text_col).mapInArrow(run, "id bigint, n_tokens bigint")


def best_fit(sizes: list[int], capacity: int, open_bins: int) -> tuple[list[int], list[int]]:
    """Bin number and offset of each item, none above ``capacity``, placed in the order given.

    Open bins are found by a bitset of their free space: the lowest set bit at or above an item's size is the tightest
    bin that takes it. With ``open_bins`` bins open and none that fits, the fullest one closes; an item that fills its
    own bin needs no open one and closes none.
    """
    free_bits, at_free, n_open, n_bins = 0, {}, 0, 0
    bins, offsets = [], []
    for size in sizes:
        fitting = free_bits >> size
        if fitting:
            free = (fitting & -fitting).bit_length() - 1 + size
            number = at_free[free].pop()
            if not at_free[free]:
                free_bits ^= 1 << free
            n_open -= 1
        else:
            if n_open == open_bins and size < capacity:
                fullest = (free_bits & -free_bits).bit_length() - 1
                at_free[fullest].pop()
                if not at_free[fullest]:
                    free_bits ^= 1 << fullest
                n_open -= 1
            free, number = capacity, n_bins
            n_bins += 1
        bins.append(number)
        offsets.append(capacity - free)
        left = free - size
        if left or not size:
            at_free.setdefault(left, []).append(number)
            free_bits |= 1 << left
            n_open += 1
    return bins, offsets


def pack(sizes: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, lane_tokens: int = LANE_TOKENS) -> DataFrame:
    """(id, piece INT, n_tokens, sequence_id BIGINT, offset INT): each document's place in the sequences.

    Only a document above ``capacity`` is cut: into full sequences of its own and a rest that is packed like any other
    item. Items go to lanes by the hash of id and piece, in numbers that follow the total of tokens, and a lane packs
    its items in order of their hash; so the result depends on neither the partitioning nor a retried task. A document
    without tokens takes a place of size zero. Repeated ids are packed each for itself.
    """
    total = sizes.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    lanes = max(1, round(total / lane_tokens))
    pieces = sizes.select("id", "n_tokens", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.col("n_tokens") - 1) / capacity).cast("int")))).alias("piece"))
    pieces = pieces.select("id", "piece", F.least(F.lit(capacity).cast("bigint"), F.col("n_tokens") - F.col("piece") * F.lit(capacity)).cast("int").alias("n_tokens"))
    pieces = pieces.withColumn("lane", F.pmod(F.xxhash64("id", "piece"), F.lit(lanes)).cast("int"))

    def fill(lane: pd.DataFrame) -> pd.DataFrame:
        lane = lane.sort_values(["order", "id", "piece"], kind="stable")
        bins, offsets = best_fit(lane["n_tokens"].tolist(), capacity, open_bins)
        return pd.DataFrame({"id": lane["id"], "piece": lane["piece"], "n_tokens": lane["n_tokens"], "sequence_id": [int(lane["lane"].iloc[0]) * 2**32 + b for b in bins], "offset": offsets})

    return pieces.withColumn("order", F.xxhash64("piece", "id")).groupBy("lane").applyInPandas(fill, "id bigint, piece int, n_tokens int, sequence_id bigint, offset int")


def packed_documents(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Token counts of ``documents`` (doc_id, text), kept once, and their places; the texts themselves aren't shuffled."""
    return pack(materialize(token_counts(documents, "doc_id", "text", vocabulary), "sizes"))
