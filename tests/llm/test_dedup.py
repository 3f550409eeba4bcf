"""Exact dedup, the Jaccard join and line dedup against plain answers."""

import random
from datetime import date
from difflib import SequenceMatcher
from math import comb

import numpy as np
import pyarrow as pa
import pytest

from envlake.llm import jaccard_join, registered
from envlake.llm.common import components, maybe_in
from envlake.llm.exact_dedup import QuotientFilter, exact_dedup, repeated_fingerprints
from envlake.llm.jaccard_join import _Dense, _exact, drop_near_duplicates, jaccard_classes, least_matches, linked_pairs
from envlake.llm.line_dedup import aligned, line_dedup, longest_common, patience, without_lines
from envlake.llm.shingles import shingles, signatures
from tests.llm.helpers import ODD, SF_DIR, docs, documents, words


# --- shared pieces ------------------------------------------------------------------------


def test_components_of_random_graphs(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5000, 5000 + i) for i in range(1, 60)]
    parent = {n: n for e in edges for n in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    linked = {n for e in edges if e[0] != e[1] for n in e}
    assert got == {n: find(n) for n in linked}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_prefilter_never_misses(spark):
    frame = spark.range(2000).selectExpr("id AS k", "id AS maybe")
    marked, flag = maybe_in(frame, "k", spark.range(0, 2000, 7).selectExpr("id AS k"))
    rows = marked.collect()
    assert flag == "_maybe" and marked.columns == ["k", "maybe", "_maybe"]
    assert all(r[flag] for r in rows if r["k"] % 7 == 0) and sum(r[flag] for r in rows) < 320


# --- exact dedup --------------------------------------------------------------------------


def test_quotient_filters_merge_losslessly():
    rng = np.random.default_rng(1)
    parts = [rng.integers(0, 1 << 12, 500).astype(np.uint64) for _ in range(4)] + [np.empty(0, np.uint64)]
    merged = QuotientFilter.merge([QuotientFilter.unpack(QuotientFilter.build(p, 5).pack(), 5) for p in parts])
    whole = QuotientFilter.build(np.concatenate(parts), 5)
    for name in ("quotient", "run_length", "remainder", "count"):
        assert np.array_equal(getattr(merged, name), getattr(whole, name))
    values, counts = np.unique(np.concatenate(parts), return_counts=True)
    assert np.array_equal(merged.fingerprints(), values) and np.array_equal(merged.count, counts)


def test_repeated_fingerprints(spark):
    values = [1, 1, 2, 3, 3, 3, 4 << 50, 4 << 50, 5]
    frame = spark.createDataFrame([(v,) for v in values], "f long").repartition(3)
    got = {tuple(r) for r in repeated_fingerprints(frame, "f").collect()}
    assert got == {(1, 2), (3, 3), (4 << 50, 2)}
    many = spark.range(4000).selectExpr("xxhash64(id % 3000) & 1152921504606846975 AS f").repartition(5)
    got = repeated_fingerprints(many, "f", rows_per_segment=100)
    assert got.count() == 1000 and {r["n"] for r in got.collect()} == {2}


def plain_groups(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault("".join(words(t)), []).append((-(len(t or "")), i is None, i))
    return {n: (min(g)[2], len(g)) for n, g in groups.items()}


@pytest.mark.parametrize("bits", [60, 9])
def test_exact_dedup_of_odd_texts(spark, bits):
    texts = [*ODD, " one", "o n e", "on\ne ", "two  words ", *[f"text {i}" for i in range(60)], "text 5"]
    frame = docs(spark, texts)
    want = plain_groups(list(enumerate(texts)))
    rows = exact_dedup(frame, bits=bits).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r["keep_id"], r["group_size"]) == want["".join(words(r["text"]))]
        assert r["kept"] == (r["doc_id"] == r["keep_id"])


def test_exact_dedup_of_repeated_rows_and_null_ids(spark):
    frame = docs(spark, ["a b", "a b", "a b", "c", "c"], [7, 7, None, None, None])
    frame = frame.selectExpr("*", "1 AS kept", "2 AS KEEP_ID", "3 AS first_row", "4 AS norm", "5 AS bucket", "null AS untyped")
    rows = exact_dedup(frame).collect()
    assert sorted((r["text"], r["_keep_id"], r["group_size"]) for r in rows if r["_kept"]) == [("a b", 7, 3), ("c", None, 2)]
    assert len(rows) == 5 and exact_dedup(docs(spark, [])).count() == 0


# --- Jaccard ------------------------------------------------------------------------------


def shingle_set(text):
    w = words(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


def plain_classes(rows, over=4, under=5):
    sets = {i: shingle_set(t) for i, t in rows}
    root, links = {i: i for i in sets}, dict.fromkeys(sets, 0)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a]:
                common = len(sets[a] & sets[b])
                if common and under * common >= over * (len(sets[a]) + len(sets[b]) - common):
                    links[a] += 1
                    links[b] += 1
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: (find(i), links[i]) for i in ids}


def test_pruning_table_is_the_beta_posterior():
    # P(J >= t | m of n) under a uniform prior, by integration
    x = (np.arange(200_000) + 0.5) / 200_000
    for n, least in least_matches(0.8, 1e-6, 64, 16):
        for m, keeps in ((least, True), (least - 1, False)):
            if m >= 0:
                density = comb(n, m) * x**m * (1 - x) ** (n - m) * (n + 1)
                assert (density[x >= 0.8].mean() * (x >= 0.8).mean() >= 1e-6) == keeps


def test_shingles_and_signatures():
    texts = [None, "", "a b", " x\ny\tz  w v u ", "a b c d e a b c d e"]
    hashes, counts, d1, _ = shingles(pa.array(texts), 5)
    assert counts.tolist() == [0, 0, 1, 2, 6]
    assert hashes[3] == hashes[8] and len(set(hashes.tolist())) == 8
    again = shingles(pa.array(["x y z w v u"]), 5)
    assert again[2][0] == d1[3] and again[0].tolist() == hashes[1:3].tolist()
    values = signatures(hashes, counts, 16)
    assert (values[0] == 0xFFFFFFFF).all() and values.shape == (5, 16)


def near_copies(seed, n, groups):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    bases = [[rng.choice(vocabulary) for _ in range(120)] for _ in range(groups)]
    out = []
    for i in range(n):
        text = list(bases[i % groups])
        for _ in range(rng.randrange(4)):
            text[rng.randrange(len(text))] = rng.choice(vocabulary)
        out.append(" ".join(text))
    return out


def test_classes_match_brute_force(spark):
    texts = [t for t in ODD if t is None or len(t) < 5000] + near_copies(5, 150, 9)
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard_classes(docs(spark, texts)).collect()}
    assert got == plain_classes(list(enumerate(texts)))


def test_large_components_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_TEXTS", 8)
    texts = near_copies(6, 120, 2) + ["a b c d e f"] * 50
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard_classes(docs(spark, texts)).collect()}
    assert got == plain_classes(list(enumerate(texts)))


def test_jaccard_query_matches_brute_force(spark):
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in registered()["op1_jaccard_join"](spark, SF_DIR).collect()}
    assert got == plain_classes(list(documents().items()))


def test_blocks_and_products_agree_with_pairs():
    texts = near_copies(8, 80, 3)
    i, j = linked_pairs(pa.array(texts), len(texts), True)
    pairs = set(zip(i.tolist(), j.tolist(), strict=True))
    a, b = linked_pairs(pa.array(texts), 30, False)
    across = set(zip(a.tolist(), b.tolist(), strict=True))
    assert across == {(x, y) for x, y in pairs if x < 30 <= y}
    hashes, counts, _, _ = shingles(pa.array(texts), 5)
    ends = np.cumsum(counts)
    sets = [np.unique(hashes[e - n : e]) for e, n in zip(ends, counts, strict=True)]
    product = _Dense(sets).product(0, 80, 0, 80)
    left, right = np.triu_indices(80, 1)
    assert np.array_equal(_exact(sets, left, right), product[left, right].astype(int))


def test_near_duplicates_that_stay(spark):
    texts = ["", None, *near_copies(2, 40, 4)]
    frame = docs(spark, texts).selectExpr("*", "doc_id AS row", "1 AS class_id")
    kept = drop_near_duplicates(frame)
    want = {root for root, _ in plain_classes(list(enumerate(texts))).values()}
    assert kept.columns == frame.columns and {r["doc_id"] for r in kept.collect()} == want
    assert drop_near_duplicates(docs(spark, [])).count() == 0


def test_repeated_rows_and_null_ids(spark):
    frame = docs(spark, ["a b c d e f"] * 3 + ["z"], [4, 4, None, None])
    rows = jaccard_classes(frame).collect()
    assert sorted((r["class_id"], r["n_links"], r["first_of_class"]) for r in rows if r["class_id"] is not None) == [(4, 2, False), (4, 2, False), (4, 2, True)]
    assert drop_near_duplicates(frame).count() == 2


# --- lines --------------------------------------------------------------------------------


def test_patience():
    assert patience([]) == []
    assert patience([(0, 5), (1, 1), (2, 2), (3, 3)]) == [(1, 1), (2, 2), (3, 3)]
    assert patience([(0, 0), (1, 1), (4, 0)]) == [(1, 1)]  # a line that occurs twice is no anchor


def test_lines_of_odd_texts(spark):
    passage = "\n".join(" ".join(f"p{k}w{i}" for i in range(15)) for k in range(4))
    texts = [*ODD, "intro\n" + passage + "\nend", passage, "other\n\n" + passage.replace("\n", "\n\n") + "\ntail", "p0w0 p0w1", "short\nline", "short\nline"]
    frame = docs(spark, texts).selectExpr("*", "0 AS removed", "1 AS Row")
    rows = {r["doc_id"]: r for r in line_dedup(frame).collect()}
    want = dict(enumerate(shared_places(list(enumerate(texts)))))
    assert {i: (r["_removed"], r["text"]) for i, r in rows.items()} == {
        i: (gone, without_lines(texts[i], gone) if gone else texts[i]) for i, gone in want.items()
    }
    n = len(ODD)
    assert rows[n]["text"] == texts[n] and rows[n + 1]["text"] == "" and "p0w0" not in rows[n + 2]["text"]
    assert line_dedup(docs(spark, [])).count() == 0


def test_no_line_is_lost(spark):
    kept = set()
    for r in line_dedup(docs(spark, list(documents().values()))).collect():
        kept |= {x for x in (r["text"] or "").split("\n") if words(x)}
    assert kept == {x for t in documents().values() for x in (t or "").split("\n") if words(x)}


def test_block_is_shared_with_one_document(spark):
    x, y, z = (" ".join(f"{c}{i}" for i in range(12)) for c in "xyz")
    # lines of two documents, or apart in one, are no common passage of 20 words
    texts = [f"{x}\n{z}", y, f"{x}\n{y}", f"{y}\n{z}\n{x}", f"{x}\n{z}\nend"]
    removed = {r["doc_id"]: r["removed"] for r in line_dedup(docs(spark, texts)).collect()}
    assert removed == {0: [], 1: [], 2: [], 3: [], 4: [0, 1]}


def test_alignment_of_repeated_lines():
    rng = random.Random(5)
    for _ in range(500):
        a, b = ([rng.randrange(size) for _ in range(rng.randrange(16))] for size in (rng.choice([2, 4, 40]),) * 2)
        pairs = aligned(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p < q and r < s for (p, r), (q, s) in zip(pairs, pairs[1:], strict=False))
        length = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, j in np.ndindex(len(a), len(b)):
            length[i + 1][j + 1] = length[i][j] + 1 if a[i] == b[j] else max(length[i][j + 1], length[i + 1][j])
        assert len(longest_common(a, b)) == length[-1][-1] >= len(pairs)
        same = SequenceMatcher(None, a, a, autojunk=False).get_matching_blocks()[0]
        assert aligned(a, a) == [(same.a + k, same.b + k) for k in range(same.size)]


def test_copies_with_repeated_lines_lose_every_line(spark):
    x, y = (" ".join(f"{c}{i}" for i in range(12)) for c in "xy")
    texts = ["\n".join(t) for t in ([x, y, x, y], [x, y, x, y], ["start", x, x, x, "end"], ["start", x, x, x, "end"])]
    removed = {r["doc_id"]: r["removed"] for r in line_dedup(docs(spark, texts)).collect()}
    assert removed[1] == [0, 1, 2, 3] and removed[3] == [0, 1, 2, 3, 4]


def shared_places(rows, min_words=20):
    """Places in passages of so many words that an earlier document has in a row, by comparing all documents."""
    lines = [[x for x in (t or "").split("\n") if words(x)] for _, t in sorted(rows)]
    out = []
    for n, here in enumerate(lines):
        found = set()
        for there in lines[:n]:
            run = {}  # words of the common run up to a place there, and its first line here
            for i, x in enumerate(here):
                now = {}
                for j in (j for j, y in enumerate(there) if x == y):
                    size, start = run.get(j - 1, (0, i))
                    now[j] = size + len(words(x)), start
                    if now[j][0] >= min_words:
                        found |= set(range(start, i + 1))
                run = now
        out.append(sorted(found))
    return out


def test_line_query_removes_all_shared_passages(spark):
    got = {r["doc_id"]: r["removed"] for r in registered()["op4_line_dedup"](spark, SF_DIR).collect()}
    want = dict(zip(sorted(documents()), shared_places(documents().items()), strict=True))
    assert any(want.values()) and got == {i: ",".join(map(str, gone)) for i, gone in want.items()}


def test_lines_scattered_over_earlier_documents(spark):
    rng = random.Random(8)
    some = [" ".join(f"{c}{i}" for i in range(n)) for c, n in zip("abcdefgh", (11, 10, 3, 25, 30, 6, 12, 8), strict=True)]
    a, b, _, long, longer, *_ = some
    texts = ["\n".join(t) for t in ([a], [b], [a, b, a], [a, b, a], [longer, long], [long, longer], [long, longer])]
    texts += ["\n".join(rng.choice(some) for _ in range(rng.randrange(1, 7))) for _ in range(60)]
    texts += texts[-60:]
    removed = [r["removed"] for r in line_dedup(docs(spark, texts)).orderBy("doc_id").collect()]
    assert removed[2] == [] and removed[3] == [0, 1, 2] and removed[6] == [0, 1]
    for n, (gone, shared) in enumerate(zip(removed, shared_places(list(enumerate(texts))), strict=True)):
        assert set(gone) <= set(shared)
        if n >= len(texts) - 60:
            assert gone == shared


@pytest.mark.parametrize(("kind", "ids"), [
    ("string", ["b", "a", None, "c", "a", "é", ""]), ("long", [7, -(2**63), None, 2**63 - 1, -(2**63), 0, -1]),
    ("date", [date(2020, 1, 2), date(2019, 1, 1), None, date(2021, 1, 1), date(2019, 1, 1), date(1, 1, 1), date(2020, 1, 1)]),
])
def test_exact_dedup_with_ids_of_any_type(spark, kind, ids):
    texts = ["x y", "xy ", " xy", "x  y", "z", "z", None]
    frame = spark.createDataFrame(list(zip(ids, texts, strict=True)), f"doc_id {kind}, text string")
    got = exact_dedup(frame).collect()
    want = {}
    for i, t in zip(ids, texts, strict=True):
        norm = "".join((t or "").split())
        rank = (-len(t or ""), i is None, i if i is not None else ids[0])
        want[norm] = min(want.get(norm, (rank, i)), (rank, i), key=lambda x: x[0])
    assert len(got) == len(ids) and sum(r["kept"] for r in got) == len(want)
    for r in got:
        assert r["keep_id"] == want["".join((r["text"] or "").split())][1]


def test_a_hub_is_split_over_tasks(spark):
    """Both sides of the joins of components are written tables, whose hot keys adaptive execution splits."""
    edges = spark.range(20_000).selectExpr("id + 1 AS u", "0L AS v").union(spark.createDataFrame([(20_001, 20_002), (20_002, 20_003)], "u long, v long"))
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    assert got == {i: 0 for i in range(20_001)} | {i: 20_001 for i in (20_001, 20_002, 20_003)}
