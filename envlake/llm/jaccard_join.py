"""N-gram Jaccard join: MinHash candidates, Bayesian pruning, exact verification."""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envlake.llm.common import components, dropped, free_name, give_back, maybe_in, slices, stored
from envlake.llm.shingles import mix, shingles, signatures

SHINGLE = 5  # words
THRESHOLD = 0.8
BANDS, ROWS = 64, 8  # a pair at the threshold shares no band with a chance of 8 in a million
COMPARED = 128  # MinHash values of a pair that are compared, 16 at a time
STEP = 16
TOLERANCE = 1e-6  # a pair is dropped when it reaches the threshold with less than this chance
BLOCK_WORDS, BLOCK_TEXTS = 1_000_000, 2048  # what one side of a comparing task holds, about
TILE = 512


def least_matches(threshold: float, tolerance: float, compared: int = COMPARED, step: int = STEP) -> list[tuple[int, int]]:
    """(values compared, least matches) after each step for which a pair is kept.

    With a uniform prior the similarity given m matches of n has a Beta(m + 1, n - m + 1)
    posterior, and its chance to be at least t is that of at most m successes in n + 1 trials
    of probability t. A pair is kept while that chance is at least ``tolerance``.
    """
    out = []
    for n in range(step, compared + 1, step):
        chance, m = 0.0, -1
        while chance < tolerance and m < n:
            m += 1
            chance += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append((n, m))
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests and band hashes of each text; a text without words has no bands."""
    lanes = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)).reshape(BANDS, ROWS) | np.uint64(1)
    for batch in slices(batches, "text", 1 << 19):
        hashes, per_text, d1, d2 = shingles(batch.column("text"), SHINGLE)
        values = signatures(hashes, per_text, BANDS * ROWS).reshape(-1, BANDS, ROWS).astype(np.uint64)
        bands = mix((values * lanes).sum(axis=2, dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64) * lanes[:, 0])
        some = per_text > 0
        offsets = np.r_[0, np.cumsum(np.where(some, BANDS, 0))].astype(np.int32)
        yield pa.record_batch({
            **{c: batch.column(c) for c in ("id", "row", "key1", "key2")},
            "d1": pa.array(d1.view(np.int64)), "d2": pa.array(d2.view(np.int64)),
            "shingles": pa.array(per_text.astype(np.int64)),
            "bands": pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands[some].reshape(-1).view(np.int64))),
        })
    give_back()


def _local_roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least text linked with each, directly or over others."""
    root = np.arange(n)
    while len(left):
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        root = root[root]
        if (root == before).all():
            break
    return root


def _exact(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs (left[i], right[i]); left is ascending."""
    out = np.zeros(len(left), np.int64)
    for at, to in _runs(left):
        one, others = sets[left[at]], [sets[j] for j in right[at:to]]
        flat = np.concatenate(others)
        where = np.minimum(np.searchsorted(one, flat), len(one) - 1)
        ends = np.cumsum([len(x) for x in others])
        hits = np.r_[0, np.cumsum(one[where] == flat)]
        out[at:to] = np.diff(hits[np.r_[0, ends]])
    return out


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    edges = np.flatnonzero(np.r_[True, values[1:] != values[:-1], True])
    return zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)


class _Dense:
    """Intersections of many pairs of one group at once, by products of incidence matrices."""

    WIDTH = 4096

    def __init__(self, sets: list[np.ndarray]):
        values, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = np.cumsum(counts > 1) - 1  # shingles of one text alone meet nothing
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        use = counts[inverse] > 1
        self.owner, self.feature = owner[use], shared[inverse[use]]
        self.features = int((counts > 1).sum())
        self.edges = np.searchsorted(self.owner, np.arange(len(sets) + 1))

    def matrix(self, a: int, b: int, low: int) -> np.ndarray:
        out = np.zeros((b - a, min(self.WIDTH, self.features - low)), np.float32)
        owner, feature = (x[self.edges[a] : self.edges[b]] for x in (self.owner, self.feature))
        use = (feature >= low) & (feature < low + self.WIDTH)
        out[owner[use] - a, feature[use] - low] = 1
        return out

    def product(self, a: int, b: int, c: int, d: int) -> np.ndarray:
        total = np.zeros((b - a, d - c), np.float32)
        for low in range(0, self.features, self.WIDTH):
            total += self.matrix(a, b, low) @ self.matrix(c, d, low).T
        return total


def linked_pairs(texts: pa.Array, n_left: int, same: bool, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of texts whose shingle sets have at least the threshold in common.

    The first ``n_left`` texts are compared with the others, or with each other if ``same``.
    """
    hashes, per_text, _, _ = shingles(texts, SHINGLE)
    ends = np.cumsum(per_text)
    sets = [np.unique(hashes[e - n : e]) for e, n in zip(ends, per_text, strict=True)]
    sizes = np.array([len(s) for s in sets], np.int64)
    values = signatures(hashes, per_text, COMPARED)
    steps = least_matches(threshold, tolerance)
    right_from = 0 if same else n_left
    over, under = _fraction(threshold)
    dense = None
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for a in range(0, n_left, TILE):
        b = min(a + TILE, n_left)
        for c in range(a if same else right_from, len(sets), 4 * TILE):
            d = min(c + 4 * TILE, len(sets))
            matches = np.zeros((b - a, d - c), np.uint8)
            for k in range(STEP):
                matches += values[a:b, k, None] == values[None, c:d, k]
            open_ = matches >= steps[0][1]
            small, large = np.minimum.outer(sizes[a:b], sizes[c:d]), np.maximum.outer(sizes[a:b], sizes[c:d])
            open_ &= (small * under >= large * over) & (small > 0)
            i, j = np.nonzero(open_)
            count = matches[i, j].astype(np.int64)
            i, j = i + a, j + c
            if same:
                use = i < j
                i, j, count = i[use], j[use], count[use]
            for n, least in steps[1:]:
                if not len(i):
                    break
                for at in range(0, len(i), 1 << 18):
                    s = slice(at, at + (1 << 18))
                    count[s] += (values[i[s], n - STEP : n] == values[j[s], n - STEP : n]).sum(axis=1)
                use = count >= least
                i, j, count = i[use], j[use], count[use]
            if not len(i):
                continue
            if len(i) > 20_000:
                dense = dense or _Dense(sets)
                common = dense.product(a, b, c, d)[i - a, j - c].astype(np.int64)
            else:
                common = _exact(sets, i, j)
            use = common * under >= (sizes[i] + sizes[j] - common) * over
            found.append((i[use], j[use]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _fraction(threshold: float) -> tuple[int, int]:
    """The threshold as a fraction, so that sets are compared in whole numbers."""
    over, under = round(threshold * 1000), 1000
    return over, under


def _compare(threshold: float, tolerance: float):
    def run(table: pa.Table) -> pa.Table:
        # a group is one pair of blocks; its texts come in any order
        blocks = table.column("block").to_numpy()
        left = table.column("low")[0].as_py()
        order = np.lexsort((table.column("node").to_numpy(), blocks != left))
        table = table.take(pa.array(order))
        same = bool(table.column("low")[0].as_py() == table.column("high")[0].as_py())
        n_left = table.num_rows if same else int((blocks == left).sum())
        node, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        i, j = linked_pairs(table.column("text").combine_chunks(), n_left, same, threshold, tolerance)
        root = _local_roots(len(node), i, j)
        links = np.bincount(i, weights=copies[j], minlength=len(node)) + np.bincount(j, weights=copies[i], minlength=len(node))
        use = links > 0
        return pa.table({
            "node": pa.array(node[use]), "root": pa.array(node[root][use]),
            "links": pa.array(links[use].astype(np.int64)),
        })

    return run


def jaccard_classes(
    docs: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    threshold: float = THRESHOLD,
    tolerance: float = TOLERANCE,
    row: str | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``class_id``, ``n_links``, ``first_of_class``.

    Two texts are linked if the sets of their five-word shingles have a Jaccard similarity of
    at least ``threshold``; a text of one to four words is one shingle, one without words
    (also null) is linked with nothing. A class is a connected component of links; its id is
    the least ``id_col`` in it, ``n_links`` the number of other rows that a row is linked
    with, copies included. One row of each class is ``first_of_class``: that of the least id.

    Copies (equal words in equal order) are compared once, through one representative. Texts
    that share a band of MinHash values form components of candidates; inside one, values are
    compared 16 at a time and a pair is dropped when the posterior chance of reaching the
    threshold falls below ``tolerance``. What is left is verified on the shingle sets. Large
    components are cut into blocks and each pair of blocks is a task of bounded size, which
    returns a spanning forest and counts, never its pairs.

    Repeated and null ids are allowed, an empty table gives an empty one, and other columns
    may have any name; they are not returned. ``row`` names a column of different whole
    numbers, if there is one; it is returned too.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(
        F.col(id_col).alias("id"), body.alias("text"),
        F.xxhash64(F.col(id_col), body).alias("key1"), F.hash(body, F.col(id_col)).alias("key2"),
        (F.col(row) if row else F.monotonically_increasing_id()).alias("row"),
    )
    id_type = docs.schema[id_col].dataType.simpleString()
    sketch = stored(
        keyed.mapInArrow(
            _sketch,
            f"id {id_type}, row long, key1 long, key2 int, d1 long, d2 long, shingles long, bands array<long>",
        ),
        "sketch",
    )
    classes = sketch.groupBy("d1", "d2").agg(F.min("row").alias("node"), F.count("*").alias("copies"))
    classes = stored(classes, "copies")
    bands = sketch.join(classes.select(F.col("node").alias("row")), "row", "left_semi").select(
        F.col("row").alias("node"), F.explode("bands").alias("band")
    )
    buckets = (
        bands.groupBy("band").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least != most")
    )
    buckets = stored(buckets.select("band", "least"), "buckets")
    near, flag = maybe_in(bands, "band", buckets)
    edges = (
        near.where(flag).select("node", "band").join(buckets, "band")
        .select(F.col("node").alias("u"), F.col("least").alias("v")).where("u != v").distinct()
    )
    groups = components(edges, "candidates")

    members = (
        groups.join(classes, "node")
        .join(sketch.select(F.col("row").alias("node"), "key1", "key2", "shingles"), "node")
    )
    members = stored(members, "members")
    parts = members.groupBy("root").agg(
        F.ceil(F.greatest(F.sum("shingles") / BLOCK_WORDS, F.count("*") / BLOCK_TEXTS)).cast("int").alias("parts")
    )
    parts = stored(parts, "parts")  # written, so that the join with a hot root can be split
    wanted = members.join(parts, "root").withColumn("block", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    there, flag = maybe_in(keyed, "key1", members)
    texts = (
        there.where(flag).select("key1", "key2", "text")
        .join(wanted, ["key1", "key2"])
        .dropDuplicates(["node"])
    )
    pairs = texts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "root", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "block", "node", "copies", "text",
    )
    links = stored(
        pairs.groupBy("root", "low", "high").applyInArrow(
            _compare(threshold, tolerance), "node long, root long, links long"
        ),
        "links",
    )
    joined = components(links.select(F.col("node").alias("u"), F.col("root").alias("v")), "classes")
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))

    placed = classes.join(joined, "node", "left").join(counts, "node", "left")
    placed = placed.select(
        "d1", "d2", F.coalesce("root", "node").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    silent = F.col("shingles") == 0  # texts without words are no copies of each other here
    rows = (
        sketch.select("id", "row", "d1", "d2", "shingles").join(placed, ["d1", "d2"])
        .withColumn("root", F.when(silent, F.col("row")).otherwise(F.col("root")))
        .withColumn("n_links", F.when(silent, F.lit(0).cast("long")).otherwise(F.col("n_links")))
    )
    rows = stored(rows.select("id", "row", "root", "n_links"), "placed")
    for done in (sketch, classes, buckets, members, parts, links):
        dropped(done)
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("row"))
    first = stored(rows.groupBy("root").agg(F.min(order).alias("first")), "first")  # as parts
    done = rows.join(first, "root").select(
        F.col("row"), F.col("id"), F.col("first.id").alias("class_id"), "n_links",
        (F.col("first.row") == F.col("row")).alias("first_of_class"),
    )
    kept = [F.col("row").alias(row)] if row else []
    return done.select(F.col("id").alias(id_col), "class_id", "n_links", "first_of_class", *kept)


def drop_near_duplicates(docs: DataFrame, text: str = "text", id_col: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are first of their class in :func:`jaccard_classes`.

    First is the least id, null ids last, then the first row; of repeated rows one stays. Texts
    without words, null ones among them, are in no class and all stay. An empty table gives an empty one, and
    columns may have any names.
    Rows are numbered and written once. Of those that go, only keys are shuffled; the others
    pass without a shuffle, bar the few that share a bit of the prefilter with one that goes.
    """
    row = free_name([*docs.columns, "class_id", "n_links", "first_of_class"], "row")
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    classes = jaccard_classes(numbered, text, id_col, threshold, row=row)
    gone = stored(classes.where(~F.col("first_of_class")).select(row), "gone")
    marked, maybe = maybe_in(numbered, row, gone)
    kept = marked.where(~F.col(maybe)).union(marked.where(maybe).join(gone, row, "left_anti").select(*marked.columns))
    return kept.select(*docs.columns)
