"""Language identification with hyperdimensional profiles of letter trigrams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from envlake.llm.common import free_name, slices
from envlake.llm.shingles import mix

DIMENSIONS = 1024
ORDER = 3  # letters in an n-gram
UNKNOWN = "und"
_CHUNK = 4096  # n-gram vectors held at once


def letter_vectors(points: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """A random vector of -1 and 1 for each code point, the same in every process."""
    lanes = np.arange(dimensions // 64, dtype=np.uint64)
    words = mix(points.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + mix(lanes + np.uint64(1))[None, :])
    bits = np.unpackbits(np.ascontiguousarray(words, "<u8").view(np.uint8), axis=1, bitorder="little")
    return (bits.astype(np.int8) * 2 - 1).astype(np.float32)


def ngram_vectors(letters: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Letters are bound by products, each permuted (rotated) by its distance from the end."""
    out = letters[grams[:, -1]].copy()
    for back in range(1, grams.shape[1]):
        out *= np.roll(letters, back, axis=1)[grams[:, -1 - back]]
    return out


def _letters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case letters with one blank (number 0) around words: numbers, text of each, code points."""
    words = [(t or "").lower() for t in texts.to_pylist()]
    points = np.frombuffer((" " + " ".join(w + " " for w in words)).encode("utf-32-le"), np.uint32)
    # each text is followed by two blanks, of which the second begins the next one
    owner = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    points = points[: len(owner)]
    distinct, inverse = np.unique(points, return_inverse=True)
    is_letter = np.array([chr(c).isalpha() for c in distinct.tolist()], bool)
    alphabet = np.r_[np.uint32(32), distinct[is_letter]]
    number = np.zeros(len(distinct), np.int64)
    number[is_letter] = np.arange(1, is_letter.sum() + 1)
    numbers = number[inverse]
    first = np.r_[True, owner[1:] != owner[:-1]]
    keep = (numbers > 0) | first | np.r_[True, numbers[:-1] > 0]
    return numbers[keep], owner[keep], alphabet


def profile_counts(texts: pa.Array, group: np.ndarray, groups: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Counts (group x n-gram) and vectors (n-gram x dimension), some thousand n-grams at a time.

    ``group[i]`` is the row that text i counts for; texts with a negative one are left out.
    """
    numbers, owner, alphabet = _letters(texts)
    if len(numbers) < ORDER:
        return
    size = len(alphabet)
    code = np.zeros(len(numbers) - ORDER + 1, np.int64)
    for k in range(ORDER):
        code = code * size + numbers[k : len(numbers) - ORDER + 1 + k]
    whole = (owner[: len(code)] == owner[ORDER - 1 :]) & (group[owner[: len(code)]] >= 0)
    code, row = code[whole], group[owner[: len(whole)][whole]]
    if size**ORDER <= 1 << 24:
        used = np.zeros(size**ORDER, bool)
        used[code] = True
        grams = np.flatnonzero(used)
        place = (np.cumsum(used) - 1)[code]
    else:
        grams, place = np.unique(code, return_inverse=True)
    letters = letter_vectors(alphabet)
    for low in range(0, len(grams), _CHUNK):
        some = grams[low : low + _CHUNK]
        inside = (place >= low) & (place < low + _CHUNK)
        counts = np.bincount(row[inside] * len(some) + place[inside] - low, minlength=groups * len(some))
        parts = np.stack([some // size**k % size for k in range(ORDER - 1, -1, -1)], axis=1)
        yield counts.reshape(groups, len(some)).astype(np.float32), ngram_vectors(letters, parts)


def profiles(texts: pa.Array) -> np.ndarray:
    """The bundle, a sum of n-gram vectors, of each text; zero where there is no letter."""
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    for counts, vectors in profile_counts(texts, np.arange(len(texts)), len(texts)):
        out += counts @ vectors
    return out


def _bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in slices(batches, "text"):
        names, row = np.unique(np.array(batch.column("lang").to_pylist(), object).astype(str), return_inverse=True)
        for counts, vectors in profile_counts(batch.column("text"), row, len(names)):
            # whole numbers, so that sums do not depend on their order
            bundle = counts.astype(np.float64) @ vectors.astype(np.float64)
            for name, one in zip(names, bundle, strict=True):
                total[name] = total.get(name, 0) + one.astype(np.int64)
    if total:
        yield pa.record_batch({"lang": pa.array(list(total)), "bundle": pa.array([v.tolist() for v in total.values()], pa.list_(pa.int64()))})


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    prototypes: np.ndarray  # one row per language, of length 1


def train_languages(labelled: DataFrame) -> LanguageModel:
    """Prototypes from all rows of ``labelled`` (text, lang): the bundles of each language.

    Every partition sends one vector per language, and Spark adds them up; the driver gets
    one vector per language. Rows with a null text or language are left out.
    """
    bundles = labelled.where("text is not null and lang is not null").select("text", "lang")
    sums = (
        bundles.mapInArrow(_bundles, "lang string, bundle array<long>")
        .select("lang", F.posexplode("bundle").alias("at", "value"))
        .groupBy("lang", "at")
        .agg(F.sum("value").alias("value"))
        .groupBy("lang")
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "value"))), lambda x: x["value"]).alias("v"))
        .orderBy("lang")
        .collect()
    )
    vectors = np.array([r["v"] for r in sums], float).reshape(len(sums), DIMENSIONS)
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return LanguageModel([r["lang"] for r in sums], (vectors / np.maximum(norms, 1e-12)).astype(np.float32))


def identify_language(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The columns of ``docs`` with ``lang_pred`` and ``score``, the cosine to that prototype.

    Whole texts are compared, whatever their length. A null text or one without a letter is
    ``und`` with score 0, as is every text under a model without languages. Negative cosines
    count as 0; of equal ones the first language in order wins. Repeated rows get equal
    results, an empty table gives an empty one. Columns named like a new one stay and the
    new one gets a leading underscore.
    """
    lang, score = free_name(docs.columns, "lang_pred"), free_name(docs.columns, "score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            bundles = profiles(batch.column(text))
            norms = np.linalg.norm(bundles, axis=1)
            best, value = np.full(batch.num_rows, -1), np.zeros(batch.num_rows)
            if model.languages:
                cosines = bundles @ model.prototypes.T / np.maximum(norms, 1e-12)[:, None]
                best = np.where(norms > 0, cosines.argmax(axis=1), -1)
                value = np.where(best >= 0, np.clip(cosines.max(axis=1), 0.0, 1.0), 0.0)
            names = [model.languages[i] if i >= 0 else UNKNOWN for i in best.tolist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(value.astype(float))],
                [*batch.schema.names, lang, score],
            )

    fields = [*docs.schema.fields, StructField(lang, StringType()), StructField(score, DoubleType())]
    return docs.mapInArrow(run, StructType(fields))
