"""Quality rules, language identification and toxicity."""

import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from envlake.llm import expected_sql, registered, toxicity
from envlake.llm.language_id import DIMENSIONS, LanguageModel, identify_language, letter_vectors, ngram_vectors, profiles, train_languages
from envlake.llm.quality_rules import Rule, quality_rules
from envlake.llm.toxicity import ToxicityModel, chosen_share, labelled_texts, ngram_buckets, present, score_toxicity, train_toxicity
from tests.compare import differences, duck
from tests.llm.helpers import ODD, SF_DIR, docs, documents, table, words


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def base_counts(text):
    w, t = words(text), text or ""
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    times = Counter(windows)
    repeated = {i + k for i, x in enumerate(windows) if times[x] > 1 for k in range(5)}
    lines = [x for x in t.split("\n") if words(x)]
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t),
        len(lines) - len(set(lines)), len(repeated),
    )


@pytest.mark.parametrize("name", sorted(expected_sql()))
def test_query_matches_sql(spark, name):
    assert differences(registered()[name](spark, SF_DIR), duck(SF_DIR), expected_sql()[name]) == ""


def test_quality_counts_of_odd_texts(spark):
    texts = [t for t in ODD if t is None or len(t) < 5000] + [
        "a b c d e a b c d e", "a b c d e f a b c d e f", "r r r r r r r r", "x\nx\n\nx y\nx", "#1 & 2 | 3 < 4 > $ % *",
    ]
    rows = {r["doc_id"]: r["quality"] for r in quality_rules(docs(spark, texts)).collect()}
    for i, text in enumerate(texts):
        q = rows[i]
        counts = base_counts(text)
        assert (q["n_words"], q["word_chars"], q["n_symbols"], q["n_dup_lines"], q["n_repeat_words"]) == counts, text
        assert q["base_failed"] == (counts[0] < 10 or 100 * counts[4] > 20 * counts[0])
        assert not (q["base_failed"] and q["kept"])


def test_quality_long_text_and_threshold_table(spark):
    frame = docs(spark, ["the cat and a dog of the house is in it " * 3000, " ".join(f"word{i} the" for i in range(40)), "& $ " * 20])
    assert [r["quality"]["kept"] for r in quality_rules(frame).orderBy("doc_id").collect()] == [False, True, False]
    strict = quality_rules(frame, rules=[Rule("n_words", None, 10)])
    assert not any(r["quality"]["kept"] for r in strict.collect())


def test_quality_filter_may_be_pushed_down(spark):
    judged = quality_rules(docs(spark, [" ".join(f"word{i} the" for i in range(2000))])).where("quality.kept").select("doc_id")
    assert judged.count() == 1


def test_empty_tables_and_clashing_columns(spark):
    none = docs(spark, [])
    assert quality_rules(none).count() == 0
    model = LanguageModel([], np.zeros((0, 1024), np.float32))
    assert identify_language(none, model).count() == 0
    blank = ToxicityModel(np.empty(0, np.int32), np.empty(0), -40.0)
    assert score_toxicity(none, blank).count() == 0
    clash = docs(spark, ["x"]).selectExpr("doc_id", "text", "1 AS quality", "2 AS Score", "3 AS lang_pred")
    assert quality_rules(clash).columns == [*clash.columns, "_quality"]
    assert score_toxicity(clash, blank).columns == [*clash.columns, "_score"]
    row = identify_language(clash, model).first()
    assert (row["_lang_pred"], row["_score"], row["Score"]) == ("und", 0.0, 2)


def test_profiles_bind_and_bundle():
    letters = letter_vectors(np.frombuffer(" ab".encode("utf-32-le"), np.uint32))
    grams = [(0, 1, 2), (1, 2, 0)]  # " ab", "ab "
    want = sum(np.roll(letters[a], 2) * np.roll(letters[b], 1) * letters[c] for a, b, c in grams)
    assert np.array_equal(profiles(pa.array(["ab"]))[0], want)
    assert np.array_equal(ngram_vectors(letters, np.array(grams)).sum(axis=0), want)
    one, many = profiles(pa.array(["Ab, ab!"])), profiles(pa.array([None, "ab ab", "", "7 !"]))
    assert np.array_equal(one[0], many[1])
    assert not many[[0, 2, 3]].any()


def test_language_query_is_accurate_on_held_out_rows(spark):
    lang = {r[0]: r[2] for r in table("documents", "/root/testdata/sf0.01")}
    texts = documents("/root/testdata/sf0.01")
    rows = registered()["op8_language_id"](spark, "/root/testdata/sf0.01").collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(lang)
    assert all(r["held_out"] == (crc(r["doc_id"]) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert all((r["lang_pred"] == "und") == (not any(c.isalpha() for c in texts[r["doc_id"]] or "")) for r in rows)
    held = [r for r in rows if r["held_out"] and lang[r["doc_id"]]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.95


def test_languages_of_odd_texts(spark):
    train = spark.createDataFrame([("the cat and the hat", "en"), ("der hund und die katze", "de"), (None, "en"), ("le chat", None)], "text string, lang string")
    model = train_languages(train)
    assert model.languages == ["de", "en"]
    got = {r["doc_id"]: r for r in identify_language(docs(spark, ODD + ["the hat", "die katze"]), model).collect()}
    assert [got[i]["lang_pred"] for i in (0, 1, 2)] == ["und"] * 3
    assert [got[i]["lang_pred"] for i in (len(ODD), len(ODD) + 1)] == ["en", "de"]
    assert got[3]["score"] == got[4]["score"]
    assert train_languages(train.limit(0)).languages == []


def test_ngram_buckets_stay_inside_texts():
    owner, bucket = present(pa.array(["abcd", "", None, "ABCD", "ab"]))
    assert set(owner.tolist()) == {0, 3}
    assert sorted(bucket[owner == 0]) == sorted(bucket[owner == 3]) and (owner == 0).sum() == 3
    points = np.frombuffer("ab\tcd".encode("utf-32-le"), np.uint32)
    same = np.frombuffer("ab cd".encode("utf-32-le"), np.uint32)
    assert all((a == b).all() for (a, _), (b, _) in zip(ngram_buckets(points), ngram_buckets(same), strict=True))


def test_toxicity_counts_hold_little_at_once(monkeypatch):
    """A task's counts of all buckets are 16 MB; they start again before they might overflow."""
    texts = [f"some words {n} of document {n % 5}" for n in range(40)]
    batch = pa.record_batch({"text": pa.array(texts), "label": pa.array([n % 3 == 0 for n in range(40)], pa.bool_()).cast(pa.int32())})
    expected = Counter()
    for n, text in enumerate(texts):
        expected.update((b, n % 3 == 0) for b in present(pa.array([text]))[1].tolist())
    for most in (toxicity.MOST_COUNTED, 7):
        monkeypatch.setattr(toxicity, "MOST_COUNTED", most)
        got = Counter()
        tracemalloc.start()
        for out in toxicity._count_documents(iter([batch.slice(n, 5) for n in range(0, 40, 5)])):
            for b, n0, n1 in zip(*(c.to_pylist() for c in out.columns), strict=True):
                got.update({(b, False): n0, (b, True): n1})
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert +got == expected
        assert peak < 24e6


def test_toxicity_query_separates_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    toxic = {r[0]: r[2] for r in table("labels", sf)}
    rows = registered()["op9_toxicity"](spark, sf).collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.5) and r["held_out"] == (crc(r["doc_id"]) % 5 == 0) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in toxic]
    assert np.mean([r["predicted"] == toxic[r["doc_id"]] for r in held]) > 0.95


def test_toxicity_training_and_odd_texts(spark):
    texts = [f"some {w} words here {i}" for i in range(40) for w in ("kind", "nastyword")]
    frame = docs(spark, texts)
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(3, 1), (None, 1), (5, None)], "doc_id long, toxic int")
    train = labelled_texts(frame, labels)
    assert sorted(r["id"] for r in train.collect()) == [i for i in range(80) if crc(i) % 5]
    model = train_toxicity(train)
    got = {r["doc_id"]: r["score"] for r in score_toxicity(docs(spark, [*ODD, "a nastyword", "lorem " * 50_000 + "nastyword", "a kind"]), model).collect()}
    n = len(ODD)
    assert got[n] > 0.5 and got[n + 1] > 0.5 and got[n + 2] < 0.5
    assert got[0] == got[1] == got[2]
    assert train_toxicity(train.limit(0)).bias == -40.0
    assert train_toxicity(train.where("label = 0")).bias < 0 < train_toxicity(train.where("label = 1")).bias


def plain_bundle(text, known):
    """The sum of a text's trigram vectors, one trigram after the other."""
    spaced = " " + " ".join("".join(c if c.isalpha() else " " for c in (text or "").lower()).split()) + " "
    total = np.zeros(DIMENSIONS, np.int64)
    for gram, n in Counter(spaced[i : i + 3] for i in range(len(spaced) - 2)).items():
        a, b, c = (known.setdefault(x, letter_vectors(np.array([ord(x)], np.uint32))[0].astype(int)) for x in gram)
        total += n * np.roll(a, 2) * np.roll(b, 1) * c
    return total


def test_language_query_matches_brute_force(spark):
    known, sums, docs_ = {}, {}, table("documents")
    bundles = {r[0]: plain_bundle(r[1], known) for r in docs_}
    for i, text, lang, *_ in docs_:
        if crc(i) % 4 != 2 and text is not None and lang is not None:
            sums[lang] = sums.get(lang, 0) + bundles[i]
    names = sorted(sums)
    prototypes = np.array([sums[n] / np.linalg.norm(sums[n]) for n in names])
    for r in registered()["op8_language_id"](spark, SF_DIR).collect():
        b = bundles[r["doc_id"]]
        if not b.any():
            assert (r["lang_pred"], r["score"]) == ("und", 0)
            continue
        cosines = prototypes @ b / np.linalg.norm(b)
        assert abs(r["score"] - max(cosines.max(), 0)) < 1e-5
        assert cosines[names.index(r["lang_pred"])] > cosines.max() - 1e-5


def plain_buckets(text):
    """Hash buckets of all character 3- to 5-grams of a text."""
    factors = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD]
    points = [32 if c in " \t\n\x0b\x0c\r\xa0" else ord(c) for c in (text or "").lower()]
    out, mask = set(), 2**64 - 1
    for n in (3, 4, 5):
        for i in range(len(points) - n + 1):
            h = sum(p * f for p, f in zip(points[i : i + n], factors, strict=False)) & mask
            out.add(((h ^ (h >> 29)) * (0xBF58476D1CE4E5B9 + 2 * n) & mask) >> 42)
    return out


def plain_scores(train, texts, max_features=3_000, min_ratio=2.0, min_documents=4):
    """Scores of a classifier fitted on a dense table of all features."""
    sets, label = [plain_buckets(t) for t, _ in train], np.array([y for _, y in train], float)
    counts = [Counter(b for s, y in zip(sets, label, strict=True) if y == c for b in s) for c in (0, 1)]
    sizes = [(label == c).sum() for c in (0, 1)]
    features = []
    for b in counts[0].keys() | counts[1].keys():
        if counts[0][b] + counts[1][b] >= min_documents:
            p0, p1 = ((counts[c][b] + 1) / (sizes[c] + 2) for c in (0, 1))
            ratio = np.log(p1 / p0)
            if abs(ratio) >= min_ratio:
                features.append((-abs(p1 - p0) * abs(ratio), b, ratio))
    features = sorted(sorted(features)[:max_features], key=lambda f: f[1])
    ratios = np.array([f[2] for f in features])
    table_ = lambda some: np.array([[f[1] in s for f in features] for s in some], float) * ratios
    x = table_(sets)
    weight = np.r_[np.ones(len(ratios)), -1.0]
    m, v = np.zeros(len(weight)), np.zeros(len(weight))
    for step in range(1, 201):
        error = (1 / (1 + np.exp(-np.clip(x @ weight[:-1] + weight[-1], -40, 40))) - label) / len(label)
        slope = np.r_[x.T @ error + 1e-4 * weight[:-1], error.sum()]
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        weight = weight - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    z = table_([plain_buckets(t) for t in texts]) @ weight[:-1] + weight[-1]
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def test_toxicity_query_matches_a_plain_fit(spark):
    toxic, texts = {}, documents()
    for i, _, y in table("labels"):  # of ids with several labels the greatest
        if i is not None and y in (0, 1):
            toxic[i] = max(y, toxic.get(i, 0))
    train = [(t, toxic[i]) for i, t in texts.items() if i in toxic and t is not None and crc(i) % 5]
    want = dict(zip(texts, plain_scores(train, texts.values()), strict=True))
    got = {r["doc_id"]: r["score"] for r in registered()["op9_toxicity"](spark, SF_DIR).collect()}
    assert got.keys() == want.keys() and max(abs(got[i] - want[i]) for i in want) < 1e-6


def test_toxicity_with_ties_and_parameters(spark):
    """Ids with several labels, repeated rows, and every parameter of the fit."""
    texts = [f"{'bad mean' if i % 3 else 'good kind'} text {i % 7}" for i in range(60)]
    frame = docs(spark, texts).union(docs(spark, texts[:5]))
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(60)] + [(0, 1), (3, None)], "doc_id long, toxic int")
    train = labelled_texts(frame, labels)
    rows = [(r["text"], r["label"]) for r in train.collect()]
    for options in ({}, {"max_features": 7}, {"min_ratio": 0.5}, {"min_documents": 30}, {"max_features": 0}):
        model = train_toxicity(train, **options)
        got = [r["score"] for r in score_toxicity(docs(spark, [*texts[:6], None]), model).orderBy("doc_id").collect()]
        assert np.allclose(got, plain_scores(rows, [*texts[:6], None], **options), atol=1e-6)


def test_any_share_of_the_labelled_rows(spark):
    rows = spark.range(20_000_000)
    assert 1 <= rows.where(chosen_share(5e-7)).count() <= 40  # less than one in a million
    assert 900 < spark.range(10_000).where(chosen_share(0.1)).count() < 1100
    assert spark.range(100).where(chosen_share(1.0)).count() == 100 and spark.range(100).where(chosen_share(0.0)).count() == 0
