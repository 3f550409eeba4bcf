"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from envlake.llm.common import free_name, give_back, slices, stored

ORDERS = (3, 4, 5)  # characters in an n-gram
HASH_BITS = 22
MAX_TRAINING_ROWS = 12_000
MAX_FEATURES = 3_000
MIN_DOCUMENTS = 4  # training documents that a feature must occur in
MIN_RATIO = 2.0  # least size of a feature's log-count ratio: long texts gather weak evidence by chance
SMOOTHING = 1.0
SLICE = 1 << 17  # bytes of text at once: their n-grams stay in the processor's cache
MOST_COUNTED = 65_535  # documents of one set of counts, which are 16-bit
RIDGE = 1e-4
STEPS = 200
_MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64
)


@dataclass(frozen=True)
class ToxicityModel:
    """Buckets of the kept n-grams and their final weights: as many of each as were asked for."""

    buckets: np.ndarray  # int32, ascending
    weights: np.ndarray  # float64: log-count ratio times learned weight
    bias: float

    def table(self) -> np.ndarray:
        """Number of each bucket's feature from 1, 0 where there is none."""
        found = np.zeros(1 << HASH_BITS, np.uint16 if len(self.buckets) < 65_535 else np.int32)
        found[self.buckets] = np.arange(1, len(self.buckets) + 1)
        return found


def _points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-case texts, each followed by a zero, and the texts' starts."""
    words = [(t or "").lower() for t in texts.to_pylist()]
    points = np.frombuffer(("\0".join(words) + "\0").encode("utf-32-le"), np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    return points, np.cumsum(lengths) - lengths


def ngram_buckets(points: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """For each order the bucket of the n-gram that begins at each code point.

    White space of any kind counts as a blank. Places where a text ends inside the n-gram are
    the caller's to leave out.
    """
    blank = (points == 32) | ((points >= 9) & (points <= 13)) | (points == 0xA0)
    p = np.where(blank, np.uint32(32), points).astype(np.uint64)
    total = p * _MULTIPLIERS[0]
    for n in range(2, max(ORDERS) + 1):
        if len(p) < n:
            return
        total = total[:-1] + p[n - 1 :] * _MULTIPLIERS[n - 1]
        if n in ORDERS:
            mixed = total ^ (total >> np.uint64(29))
            mixed = mixed * np.uint64(0xBF58476D1CE4E5B9 + 2 * n)
            yield (mixed >> np.uint64(64 - HASH_BITS)).astype(np.int32), n


def present(texts: pa.Array, table: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, bucket) pairs, or (text, feature) pairs where a table is given."""
    points, starts = _points(texts)
    ends = np.append(starts[1:], len(points)) - 1  # places of the zeros
    keys = []
    for buckets, n in ngram_buckets(points):
        if table is not None:
            feature = table[buckets]
            at = np.flatnonzero(feature)
            value = feature[at].astype(np.int64) - 1
        else:
            at, value = np.arange(len(buckets)), buckets.astype(np.int64)
        owner = np.searchsorted(starts, at, side="right") - 1
        inside = at + n <= ends[owner]
        keys.append((owner[inside] << 32) | value[inside])
    pairs = np.unique(np.concatenate(keys)) if keys else np.empty(0, np.int64)
    return pairs >> 32, pairs & 0xFFFFFFFF


def _count_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per bucket and class of one partition; several counts of a bucket if there are many documents."""
    counts = np.zeros((2, 1 << HASH_BITS), np.uint16)

    def counted() -> Iterator[pa.RecordBatch]:
        for low in range(0, 1 << HASH_BITS, 1 << 18):
            part = counts[:, low : low + (1 << 18)]
            b = np.flatnonzero(part[0] | part[1])
            yield pa.record_batch({"bucket": pa.array((b + low).astype(np.int32)), "n0": pa.array(part[0, b].astype(np.int64)), "n1": pa.array(part[1, b].astype(np.int64))})

    rows = 0
    for batch in slices(batches, "text", SLICE):
        if rows + batch.num_rows > MOST_COUNTED:
            yield from counted()
            counts[:], rows = 0, 0
        rows += batch.num_rows
        label = batch.column("label").to_numpy(zero_copy_only=False)
        owner, bucket = present(batch.column("text"))
        for c in (0, 1):
            np.add.at(counts[c], bucket[label[owner] == c], 1)
    yield from counted()
    del counts
    give_back()


def _kept_features(model: ToxicityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table()
        for batch in slices(batches, "text", SLICE):
            owner, feature = present(batch.column("text"), table)
            offsets = np.r_[0, np.cumsum(np.bincount(owner, minlength=batch.num_rows))].astype(np.int32)
            yield pa.record_batch({
                "label": batch.column("label"),
                "features": pa.ListArray.from_arrays(pa.array(offsets), pa.array(feature.astype(np.int32))),
            })

    return run


def _fit(ratios: np.ndarray):
    """Logistic regression with a ridge on ratio-scaled features, by conjugate-like descent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        label = table.column("label").to_numpy().astype(float)
        lists = table.column("features").combine_chunks()
        index = lists.flatten().to_numpy()
        row = np.repeat(np.arange(len(label)), np.asarray(lists.value_lengths()))
        x = ratios[index]
        weight, bias = np.ones(len(ratios)), -1.0
        m = np.zeros(len(ratios) + 1)
        v = np.zeros(len(ratios) + 1)
        for step in range(1, STEPS + 1):
            z = np.bincount(row, weights=x * weight[index], minlength=len(label)) + bias
            p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            error = (p - label) / len(label)
            slope = np.append(np.bincount(index, weights=error[row] * x, minlength=len(ratios)) + RIDGE * weight, error.sum())
            m = 0.9 * m + 0.1 * slope
            v = 0.99 * v + 0.01 * slope * slope
            move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
            weight, bias = weight - move[:-1], bias - move[-1]
        yield pa.record_batch({"weights": pa.array([weight.tolist()]), "bias": pa.array([float(bias)])})

    return run


def chosen_share(share: float) -> Column:
    """Whether a row is among this share of all rows, by a 64-bit hash of its id: exact however small the share."""
    bound = min(int(share * 2**64), 2**64) - 2**63  # hashes are signed
    return F.lit(True) if bound >= 2**63 else F.xxhash64(F.col("id"), F.lit("training")) < F.lit(bound)


def train_toxicity(
    labelled: DataFrame, max_rows: int = MAX_TRAINING_ROWS, max_features: int = MAX_FEATURES,
    min_ratio: float = MIN_RATIO, min_documents: int = MIN_DOCUMENTS,
) -> ToxicityModel:
    """Fit on ``labelled`` (id, text, label 0 or 1).

    At most about ``max_rows`` rows are used, chosen by a hash of the id: the bound makes
    the fit one small task at any size of the corpus. Features are the ``max_features`` hashed
    n-grams that tell the classes apart best, of those that occur in ``min_documents`` of the rows
    and whose log-count ratio is ``min_ratio`` or more either way; the README has held-out figures for
    other values. Rows with a null label or text are left out. Without rows of both classes the model has no features and its score is constant:
    0 without any rows, else near the only class.
    """
    usable = labelled.where("text is not null and label in (0, 1)")
    total = usable.count()
    share = min(1.0, max_rows / max(1, total))
    sample = stored(usable.where(chosen_share(share)).select("text", F.col("label").cast("int").alias("label")), "toxicity")
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    none = np.empty(0, np.int32), np.empty(0)
    if not sizes:
        return ToxicityModel(*none, -40.0)
    if len(sizes) == 1:
        n = sum(sizes.values())
        return ToxicityModel(*none, float(np.log(n + 1) * (1 if 1 in sizes else -1)))
    counts = (
        sample.mapInArrow(_count_documents, "bucket int, n0 long, n1 long")
        .groupBy("bucket")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        .where(F.col("n0") + F.col("n1") >= min_documents)
    )
    p1 = (F.col("n1") + SMOOTHING) / (sizes[1] + 2 * SMOOTHING)
    p0 = (F.col("n0") + SMOOTHING) / (sizes[0] + 2 * SMOOTHING)
    ratio = F.log(p1 / p0)
    best = (
        counts.withColumn("ratio", ratio)
        .where(F.abs("ratio") >= min_ratio)
        .withColumn("gain", F.abs(p1 - p0) * F.abs(ratio))
        .orderBy(F.desc("gain"), "bucket")
        .limit(max_features)
        .select("bucket", "ratio")
        .toPandas()
        .sort_values("bucket")
    )
    buckets, ratios = best["bucket"].to_numpy(np.int32), best["ratio"].to_numpy(float)
    bare = ToxicityModel(buckets, ratios, 0.0)
    fitted = (
        sample.mapInArrow(_kept_features(bare), "label int, features array<int>")
        .repartition(1)
        .mapInArrow(_fit(ratios), "weights array<double>, bias double")
        .first()
    )
    return ToxicityModel(buckets, ratios * np.array(fitted["weights"]), fitted["bias"])


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """The columns of ``docs`` and ``score`` between 0 and 1; at 0.5 or more a text is toxic.

    Each n-gram counts once per text however often it occurs, so a long text does not hide a
    few toxic words. Null and empty texts get the score of no evidence. Repeated rows get
    equal scores; an empty table gives an empty one. A column named ``score`` stays and the
    new one is ``_score``. Texts are read whole, some hundred kilobytes at a time.
    """
    name = free_name(docs.columns, "score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table()
        for batch in slices(batches, text, SLICE):
            owner, feature = present(batch.column(text), table)
            z = np.bincount(owner, weights=model.weights[feature], minlength=batch.num_rows) + model.bias
            score = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], [*batch.schema.names, name])
        give_back()

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, text, label) of the training rows: ids whose crc32, as text, is no multiple of 5.

    The label of an id with several rows is the greatest. The join reads texts of labelled
    documents only where Spark finds the labels small enough to broadcast; otherwise a hot id
    is split by adaptive execution.
    """
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    truth = labels.where("doc_id is not null").where(train).groupBy("doc_id").agg(F.max("toxic").alias("label"))
    rows = docs.select(F.col("doc_id").alias("id"), "text")
    return rows.join(truth, rows["id"] == truth["doc_id"]).select("id", "text", "label")
