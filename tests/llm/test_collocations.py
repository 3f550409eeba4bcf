"""Phrase mining against brute force over all phrases."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from envlake.llm import collocations as c
from envlake.llm.collocations import Bitmap, bitmap, collocations
from tests.llm.helpers import ODD

DOCS = "text string, lang string, a int, key string, n long, word string, WS int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "k", 2, "w", 3) for r in rows], DOCS)


def brute(rows, least, top):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        often = {p: n for p, n in f.items() if n >= least}
        hidden = set()
        for p, n in often.items():
            for k in range(2, len(p)):
                hidden |= {p[i : i + k] for i in range(len(p) - k + 1) if 100 * n >= 100 * f[p[i : i + k]]}
        kept = []
        for p, a in often.items():
            if len(p) > 1 and p not in hidden:
                cuts = [(1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def corpus(seed, texts=300, size=40, words=60):
    """Frequent and rare words, some of them always together."""
    rng = random.Random(seed)
    names = [f"w{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    out = []
    for i in range(texts):
        some = rng.choices(names, weights, k=size)
        for at in range(0, size, 7):
            if rng.random() < 0.4:
                some[at : at + 3] = ["New", "york", rng.choice(["city", "times", "city"])]
        if rng.random() < 0.3:
            some += ["one", "two", "three", "four", "five", "six", "seven"]
        marks = [w + rng.choice(["", "", "", "", ",", "."]) for w in some]
        out.append(("  ".join(marks) if i % 5 == 0 else " ".join(marks), rng.choice(["en", "de", None, "und"])))
    return out


@pytest.mark.parametrize(("least", "top"), [(3, 2000), (8, 25), (1, 40)])
def test_matches_brute_force(spark, least, top):
    rows = corpus(least * 100 + top)
    got = collocations(frame(spark, rows), least, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, least, top)


def test_frontier_stops_early(spark, monkeypatch):
    """With few phrases asked for, common words are never first or last of a counted phrase."""
    seen = []
    grown = c._frequent
    monkeypatch.setattr(c, "_frequent", lambda *a: seen.append(a[1]) or grown(*a))
    rows = [(t, "en") for t, _ in corpus(1, 600)]
    got = sorted(map(tuple, collocations(frame(spark, rows), 5, 3).collect()))
    assert got == brute(rows, 5, 3)
    assert len(seen) < len(c.SHARES) * (c.LONGEST - 1)


def test_odd_texts(spark):
    rows = [(t, lang) for t in ODD for lang in ("fr", None)] + [("A\x00b A\x00b É É é", "x"), ("a.b,c", "x"), ("one " * 5000, "x"), ("q" * 70_000 + " z", "x")]
    rows += [("one two\rone two\x0bone two", "")] * 3
    got = collocations(frame(spark, rows), 2, 50)
    assert sorted(map(tuple, got.collect())) == brute(rows, 2, 50)


@pytest.mark.parametrize("rows", [[], [(None, None), ("", "en"), ("...", "en"), ("a b", "en")]])
def test_no_phrases(spark, rows):
    assert collocations(frame(spark, rows)).collect() == []


def test_words_that_share_a_key_get_others(spark, monkeypatch):
    """Equal keys of different words are noticed, and other keys taken."""
    right, seeds = c._words, []

    def poor(texts, langs, seed):
        out = list(right(texts, langs, seed))
        if seed == 0:
            out[4] = out[4] % np.uint64(7) + np.uint64(1)
        return tuple(out)

    monkeypatch.setattr(c, "_words", poor)
    monkeypatch.setattr(c, "_encode", lambda seed, b, f=c._encode: seeds.append(seed) or f(seed, b))
    rows = corpus(3, 100)
    assert sorted(map(tuple, collocations(frame(spark, rows), 3, 50).collect())) == brute(rows, 3, 50)
    assert seeds == [1]


def test_bitmap_holds_its_keys(spark):
    rng = np.random.default_rng(2)
    pairs = rng.integers(-(2**62), 2**62, (5000, 2))
    found = bitmap(spark.createDataFrame([(p.tolist(),) for p in pairs], "ws array<long>"), 2)
    flat = pairs.astype(np.int64).view(np.uint64).ravel()
    assert found.has(c.phrase_keys(flat, 2)[::2]).all()
    other = rng.integers(-(2**62), 2**62, 20_000).view(np.uint64)
    assert found.has(c.phrase_keys(other, 2)).mean() < 0.02
    assert isinstance(found, Bitmap) and found.cells.nbytes == 1 << 17
