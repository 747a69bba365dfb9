"""Duplicates hidden by formatting: canonical keys and an incremental ledger of their counts (problem 1)."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factsieve.functions.joins import skew_safe_join
from factsieve.functions.storage import remove, shared_dir

#: White space, punctuation, ASCII symbols and list bullets: what formatting changes.
FORMATTING = r"[\s\p{Z}\p{P}\p{Punct}■-◿]+"
SEPARATOR, NULL_MARK = "\u0001", "\u0002"
_NUMBER = r"^[+-]?[0-9]+(?:\.[0-9]+)?$"


def record_key(texts: list[str], others: list[str]) -> Column:
    """128-bit key of a record: ``texts`` but for case, spaces and punctuation, ``others`` exactly; null equals null only.

    The texts are joined first, so that lower case and one pattern pass serve all of them. An empty text differs from
    a null one.
    """
    joined = F.concat_ws(SEPARATOR, *[F.coalesce(F.col(c), F.lit(NULL_MARK)) for c in texts])
    exact = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARK)) for c in others]
    return F.unhex(F.md5(F.concat_ws(SEPARATOR, F.regexp_replace(F.lower(joined), FORMATTING, ""), *exact)))


def payload_key(payload: Column, leading: list[str]) -> Column:
    """128-bit key of a JSON object in text, whatever its field order, spacing and notation of numbers.

    A name with a null value is as good as absent. Text that is no JSON object counts as one text; null stays apart.
    """
    entries = F.map_entries(F.from_json(payload, "map<string,string>"))

    def value(raw: Column) -> Column:
        digits = F.regexp_replace(raw, r"[,\s\p{Z}]+", "")
        bare = F.regexp_replace(F.lower(raw), FORMATTING, "")
        number = F.when(digits.rlike(_NUMBER), digits).when(bare.rlike("^[0-9]+$"), bare)
        return F.coalesce(number.try_cast("double").cast("string"), bare)

    kept = F.filter(entries, lambda e: e["value"].isNotNull())
    pairs = F.array_sort(F.transform(kept, lambda e: F.concat(F.regexp_replace(F.lower(e["key"]), FORMATTING, ""), F.lit("\u0003"), value(e["value"]))))
    body = F.when(payload.isNull(), F.lit(NULL_MARK)).otherwise(F.coalesce(F.array_join(pairs, SEPARATOR), F.regexp_replace(F.lower(payload), FORMATTING, "")))
    return F.unhex(F.md5(F.concat_ws(SEPARATOR, *[F.coalesce(F.col(c), F.lit(NULL_MARK)) for c in leading], body)))


#: Rows of the first batch that a bucket of a new ledger is made for.
BUCKET_ROWS = 4_000_000


class CopyLedger:
    """Counts of canonical keys, kept in buckets on disk and brought up to date batch by batch.

    Each generation is a table bucketed by key. A batch is aggregated (partly before its shuffle, so a key that holds
    a third of the rows sends one row a task), full-outer-joined to the generation bucket by bucket without moving the
    ledger, the counts are added and the earliest representative is kept. The file that names a generation and its batch
    is renamed into place once the generation is whole; so a failed batch changes nothing, and a batch whose id the ledger
    has already taken in is passed over. The former generation is then deleted: a table() taken before is void.

    A ledger with a ``name`` is found again under it in the shared folder, by any later session; without one it is new.
    """

    def __init__(self, spark: SparkSession, name: str | None = None, buckets: int | None = None) -> None:
        self.spark = spark
        self.name = name or uuid.uuid4().hex
        self.folder = f"{shared_dir(spark)}/copy-ledger-{self.name}"
        self.buckets, self.generation = buckets, 0
        for generation, kept, _ in self._states():
            if generation > self.generation:
                self.generation, self.buckets = generation, kept

    def _files(self) -> tuple[object, object]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/states")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _states(self) -> list[tuple[int, int, str]]:
        """(generation, buckets, hash of the batch's id) of every generation ever completed."""
        files, path = self._files()
        if not files.exists(path):
            return []
        names = [f.getPath().getName() for f in files.listStatus(path)]
        parts = [n.split("-") for n in names if n.startswith("done-")]
        return [(int(g), int(b), h) for _, g, b, h in parts]

    def table(self) -> DataFrame:
        """(key BINARY, n BIGINT, first_id BIGINT), one row per record; empty before the first batch."""
        if not self.generation:
            return self.spark.createDataFrame([], "key BINARY, n BIGINT, first_id BIGINT")
        self._register(self.generation)
        return self.spark.table(self._table(self.generation))

    def _table(self, generation: int) -> str:
        return f"`copy_ledger_{hashlib.md5(self.folder.encode()).hexdigest()}_{generation}`"

    def _register(self, generation: int) -> None:
        """Make the catalog know a generation that another session has written."""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self._table(generation)} (key BINARY, n BIGINT, first_id BIGINT) USING parquet CLUSTERED BY (key) INTO {self.buckets} BUCKETS LOCATION '{self.folder}/{generation}'")

    def absorb(self, batch: DataFrame, batch_id: str | None = None) -> bool:
        """Add a batch with columns key and id; False where its ``batch_id`` was taken in before.

        Empty batches and repeated ids are allowed (each row is a copy); null keys are left out.
        """
        tag = hashlib.sha1((batch_id or uuid.uuid4().hex).encode()).hexdigest()
        if any(tag == known for *_, known in self._states()):
            return False
        if not self.buckets:
            self.buckets = max(self.spark.sparkContext.defaultParallelism, batch.count() // BUCKET_ROWS)
        target = self.generation + 1
        remove(self.spark, f"{self.folder}/{target}")  # what a failed attempt may have left
        partitions = self.spark.conf.get("spark.sql.shuffle.partitions")
        try:
            # The batch is shuffled into as many partitions as there are buckets, so the join needs no further exchange.
            self.spark.conf.set("spark.sql.shuffle.partitions", str(self.buckets))
            merged = batch.filter(F.col("key").isNotNull()).groupBy("key").agg(F.count("*").alias("n"), F.min("id").cast("bigint").alias("first_id"))
            if self.generation:
                new = merged.select("key", F.col("n").alias("_n"), F.col("first_id").alias("_first"))
                merged = self.table().join(new, "key", "full_outer").select("key", (F.coalesce("n", F.lit(0)) + F.coalesce("_n", F.lit(0))).alias("n"), F.least("first_id", "_first").alias("first_id"))
            merged.write.mode("overwrite").bucketBy(self.buckets, "key").option("path", f"{self.folder}/{target}").option("compression", "zstd").saveAsTable(self._table(target))
        finally:
            self.spark.conf.set("spark.sql.shuffle.partitions", partitions)
        files, states = self._files()
        path = lambda name: self.spark._jvm.org.apache.hadoop.fs.Path(states, name)
        files.create(path(f"open-{target}"), True).close()
        files.rename(path(f"open-{target}"), path(f"done-{target}-{self.buckets}-{tag}"))
        if self.generation:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(self.generation)}")
            remove(self.spark, f"{self.folder}/{self.generation}")
        self.generation = target
        return True


def batches(df: DataFrame, id_col: str, count: int) -> list[Column]:
    """Conditions that cut ``df`` into ``count`` ranges of its ids, which are in order of arrival."""
    lo, hi = df.agg(F.min(id_col), F.max(id_col)).first()
    if lo is None:
        return [F.lit(True)]
    step = (hi - lo) // count + 1
    return [(F.col(id_col) >= lo + i * step) & (F.col(id_col) < lo + (i + 1) * step) for i in range(count)]


def find_copies(keyed: DataFrame, ledger: CopyLedger, deliveries: int = 3) -> DataFrame:
    """(…, first_id): the rows of ``keyed`` (key, id, …) that repeat an earlier one, with their record's smallest id.

    ``keyed`` passes through the ledger in ``deliveries`` batches; then the ledger's records with several copies are
    joined back, balanced by their known counts.
    """
    for i, part in enumerate(batches(keyed, "id", deliveries)):
        ledger.absorb(keyed.filter(part), f"delivery {i}")
    repeated = ledger.table().filter("n > 1")
    return skew_safe_join(keyed, repeated, "key", "n").filter(F.col("id") != F.col("first_id"))
