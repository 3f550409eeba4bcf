"""Sharding, packing, token files and SentencePiece against plain answers."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from tokenizers import Tokenizer

from envlake.llm import registered
from envlake.llm.packing import CAPACITY, fitted_counts, layout, pack_documents, patterns
from envlake.llm.sentencepiece_scan import (
    Chunk, Lattice, border_states, combined, decode_pieces, default_model, encode_pieces, max_plus, prepared,
)
from envlake.llm import sentencepiece_scan, sharding, tokens
from envlake.llm.sharding import feistel_shards, halves, permuted
from envlake.llm.token_files import read_lengths, read_tokens, token_index, write_token_files
from envlake.llm.tokens import MOST_REMEMBERED, Encoder, default_tokenizer, encoder
from envlake.sources.scratch import scratch_dir
from tests.llm.helpers import ODD, SF_DIR, docs, documents

TOKENIZER = Tokenizer.from_file(default_tokenizer())
PIECES = sentencepiece.SentencePieceProcessor(model_file=default_model())


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


# --- sharding -----------------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 3, 7, 10, 97, 100, 1000])
def test_permutation_is_one(n):
    a, b = halves(n)
    assert a * b >= n and a * b - n < max(a, 2)
    assert sorted(permuted(i, n, 5) for i in range(n)) == list(range(n))


@pytest.mark.parametrize("n", [0, 1, 5, 97, 1003])
def test_shards(spark, n):
    frame = spark.range(n).selectExpr("id AS doc_id", "id * 2 AS size", "1 AS shard")
    rows = feistel_shards(frame, 4, seed=9).collect()
    assert len(rows) == n
    for r in rows:
        p = permuted(r["row_number"], n, 9)
        assert (r["_shard"], r["slot"]) == (p % 4, p // 4)
    for shard in range(4):
        slots = sorted(r["slot"] for r in rows if r["_shard"] == shard)
        assert slots == list(range(len(range(shard, n, 4))))


def test_shards_do_not_depend_on_layout_and_take_repeated_rows(spark):
    rows = [(i % 50, None if i % 3 else i) for i in range(300)] + [(None, None)] * 20_000
    frame = spark.createDataFrame(rows, "a long, b long")

    def placed(f):
        return sorted(map(tuple, feistel_shards(f, 8).collect()), key=lambda r: r[2])

    one = placed(frame.repartition(1))
    assert one == placed(frame.repartition(7, "b")) and [r[2] for r in one] == list(range(len(rows)))


def test_sharding_query(spark):
    frame = registered()["op5_feistel_sharding"](spark, SF_DIR)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "ExistingRDD", "CartesianProduct"))
    rows, texts = frame.collect(), documents()
    assert len(rows) == len(texts)
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "rows", None)


def plain_place(number, n, seed=0):
    """Where the shuffle puts a row: six rounds on a pair of digits, again until the place is one of n."""
    prime, state, keys = 2**31 - 1, (2 * seed + 1) % (2**31 - 1) or 1, []
    for _ in range(12):
        state = (state * 48_271 + 11) % prime
        keys.append(state or 1)
    wide = int((n - 1) ** 0.5) + 1
    narrow = -(-n // wide)
    while True:
        pair = [number // narrow, number % narrow]
        for i in range(6):
            a, b = keys[2 * i], keys[2 * i + 1]
            x = pair[1 - i % 2] % prime
            y = ((x * a + b) % prime) ** 2 + b
            pair[i % 2] = (pair[i % 2] + ((y % prime * a + x) % prime) ** 2 % prime) % (narrow if i % 2 else wide)
        number = pair[0] * narrow + pair[1]
        if number < n:
            return number


@pytest.mark.parametrize("cell_rows", [sharding.CELL_ROWS, 3])
def test_sharding_query_matches_a_plain_permutation(spark, monkeypatch, cell_rows):
    """Shard and slot of every row, also where rows are numbered in many cells."""
    monkeypatch.setattr(sharding, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(sharding, "CELLS_TOGETHER", 7)
    rows = registered()["op5_feistel_sharding"](spark, SF_DIR).collect()
    n = len(rows)
    assert n == len(documents()) and sorted(r["row_number"] for r in rows) == list(range(n))
    for r in rows:
        assert (r["slot"], r["shard"]) == divmod(plain_place(r["row_number"], n), 8)
    sizes = Counter(r["shard"] for r in rows)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1


# --- byte-level BPE -----------------------------------------------------------------------


def check_encoder(encoder, texts):
    ids, offsets = encoder.encode(pa.array(texts, pa.string()))
    for t, a, b in zip(texts, offsets[:-1], offsets[1:], strict=True):
        assert ids[a:b].tolist() == ids_of(t), t


def test_encoder_matches_the_library():
    encoder = Encoder(default_tokenizer())
    spaces = ["a  b", "a \n b", "\n\n x  ", "x\n\ny", "x\n\n\ny", "\n \n a", "  \n", "a×b ÷c", "x\x1c y \x85 z", "<|endoftext|> hi", "a\0b", "12ab 3.5é"]
    check_encoder(encoder, [*ODD, *spaces])
    check_encoder(encoder, [""])
    rng = random.Random(1)
    for _ in range(60):
        check_encoder(encoder, ["".join(rng.choice("ab1 \n.,éß×'\tĀ Ж") for _ in range(rng.randrange(14))) for _ in range(20)])


def test_encoder_forgets():
    encoder = Encoder(default_tokenizer())
    encoder.most = 300
    letters = "abcdefghij"
    texts = [" ".join(f"w{letters[i // 10]}{letters[i % 10]}{a}{b}" for a in letters[:6] for b in letters[:6]) for i in range(30)]
    for at in range(0, 30, 3):
        check_encoder(encoder, texts[at : at + 3])
    assert encoder.generation > 0


# --- packing ------------------------------------------------------------------------------


def test_patterns_and_fit():
    shapes = patterns(12, 3)
    assert len(shapes) == len({tuple(s) for s in shapes.tolist()}) and (shapes.sum(axis=1) == 12).all()
    assert len(shapes) == 1 + 6 + 12
    want = np.zeros(len(shapes))
    want[[0, 3, 8]] = [5, 40, 17]
    histogram = np.zeros(13)
    for s, n in zip(shapes, want, strict=True):
        for c in s[s > 0]:
            histogram[c] += n
    x = fitted_counts(histogram, shapes)
    fitted = np.zeros(13)
    for s, n in zip(shapes, x, strict=True):
        for c in s[s > 0]:
            fitted[c] += n
    assert (x >= 0).all() and np.abs(fitted - histogram).max() < 2


def best_fit(lengths, capacity):
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in room if r >= n]
        if fits:
            room.remove(min(fits))
            room.append(min(fits) - n)
        else:
            room.append(capacity - n)
    return len(room)


@pytest.mark.parametrize("seed", range(6))
def test_layout_is_valid_and_tight(seed):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(rng.lognormal(5, 1.2, [0, 1, 50, 400, 3000, 3000][seed]).astype(int) + 1, 512)
    histogram = np.bincount(lengths, minlength=513)
    plan = layout(histogram, 512, 64)
    used, filled = np.zeros(513, int), {}
    for n, rank, count, sequence, offset in zip(plan.length, plan.rank, plan.count, plan.sequence, plan.offset, strict=True):
        assert rank == used[n]
        used[n] += count
        for k in range(count):
            filled.setdefault(sequence + k, []).append((offset, n))
    assert (used == histogram).all() and sorted(filled) == list(range(plan.sequences))
    for parts in filled.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 512
    assert plan.sequences <= best_fit(lengths.tolist(), 512) * 1.01 + 1


def check_packing(rows, texts):
    sequences, pieces = {}, {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        pieces.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for i, text in texts.items():
        ids, at = ids_of(text), 0
        for k, (piece, start, length, check) in enumerate(sorted(pieces.pop(i))):
            assert (piece, start) == (k, at) and check == crc(ids[at : at + length])
            assert length == CAPACITY or k == 0
            at += length
        assert at == len(ids)
    assert not pieces
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= CAPACITY


def test_packing_query(spark):
    check_packing(registered()["op2_best_fit_packing"](spark, SF_DIR).collect(), documents())


def test_packing_that_remembers_little(spark, monkeypatch):
    texts = docs(spark, [f"one word {n} {n % 7} of some {'x' * (n % 11)}" for n in range(300)]).coalesce(1)
    rows = [sorted(r[:5] for r in pack_documents(texts, remembered=most).collect()) for most in (4, MOST_REMEMBERED)]
    assert rows[0] == rows[1] and len(rows[0]) == 300
    path = default_tokenizer()
    monkeypatch.setattr(tokens, "SOME", 8)
    memo, plain = encoder(path, 4), Encoder(path)
    for n in range(50):
        some = pa.array([f"word{n} other {n} words{n} and more and others than are remembered, {n * n} of them"])
        assert memo.encode(some)[0].tolist() == plain.encode(some)[0].tolist()
        assert len(memo.known) <= 8
    assert encoder(path).most == MOST_REMEMBERED


def test_packing_of_odd_texts(spark):
    texts = dict(enumerate([*ODD, "word " * 2047, "word " * 2048]))
    rows = pack_documents(docs(spark, list(texts.values())).selectExpr("*", "1 AS length", "2 AS id").repartition(3)).collect()
    check_packing(rows, texts)
    assert all(crc(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == r["length"] for r in rows)
    assert pack_documents(docs(spark, [])).count() == 0
    again = pack_documents(docs(spark, ["a", "a", None], [None, 3, 3])).collect()
    assert len(again) == 3 and {r["sequence_id"] for r in again} == {0}


# --- token files --------------------------------------------------------------------------


def check_index(rows, texts):
    at = 0
    for r in sorted(rows, key=lambda r: r["start"]):
        ids = ids_of(texts[r["doc_id"]])
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), crc(ids))
        at += len(ids)
    starts = [r["start"] for r in sorted(rows, key=lambda r: r["doc_id"])]
    assert starts == sorted(starts) and len(rows) == len(texts)


def test_token_files_query(spark):
    check_index(registered()["op10_token_files"](spark, SF_DIR).collect(), documents())


def test_token_files_of_odd_texts_and_selective_reads(spark):
    texts = dict(enumerate(ODD * 3))
    path = scratch_dir(spark, "test-tokens")
    write_token_files(docs(spark, list(texts.values())).selectExpr("*", "1 AS ids", "2 AS tie").repartition(4), path)
    check_index(token_index(spark, path).collect(), texts)
    some = read_tokens(spark, path, 5, 7)
    assert {r["doc_id"]: r["ids"] for r in some.collect()} == {i: ids_of(texts[i]) for i in (5, 6, 7)}
    assert "GreaterThanOrEqual(doc_id,5)" in some._jdf.queryExecution().executedPlan().toString()
    lengths = read_lengths(spark, path)
    assert "ids" not in lengths._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    files = [f.removeprefix("file:") for f in spark.read.parquet(path).inputFiles()]
    for file in files:
        group = pq.ParquetFile(file).metadata.row_group(0)
        by_name = {group.column(c).path_in_schema: group.column(c) for c in range(group.num_columns)}
        assert "DELTA_BINARY_PACKED" in by_name["doc_id"].encodings
        assert "RLE_DICTIONARY" in by_name["ids.list.element"].encodings
        assert all(c.has_offset_index for c in by_name.values())
        assert by_name["doc_id"].has_column_index
    empty = scratch_dir(spark, "test-tokens")
    write_token_files(docs(spark, []), empty)
    assert token_index(spark, empty).count() == 0


# --- SentencePiece ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    return Lattice(default_model())


def test_units_match_the_library(model):
    rng = random.Random(2)
    texts = [t or "" for t in ODD] + ["".join(rng.choice("  \n.,etaonhé▁日本語😀ab1:;()//--==__\0") for _ in range(rng.randrange(25))) for _ in range(1500)]
    ids, counts = model.encode_units(pa.array([prepared(t) for t in texts]))
    ends = np.cumsum(counts)
    for t, a, b in zip(texts, ends - counts, ends, strict=True):
        assert ids[a:b].tolist() == PIECES.encode(t), t


def chunks(model, text, size):
    p = prepared(text)
    return [Chunk(model, p[max(0, i - model.longest) : i], p[i : i + size], p[i + size : i + size + model.longest]) for i in range(0, len(p), size)]


def test_scan_of_chunks_matches_the_library(model):
    rng = random.Random(4)
    for _ in range(250):
        text = "".join(rng.choice(rng.choice([" ", "ab", " a", "thein ", "====--", "日本", "etaonish"])) for _ in range(rng.randint(40, 90)))
        some = chunks(model, text, rng.choice([16, 20, 33]))
        matrices = [c.matrix() for c in some]
        states = border_states(matrices)
        ids = [i for c, a, b in zip(some, states, states[1:], strict=False) for i in c.ids(a, b).tolist()]
        assert ids == PIECES.encode(text), text
        if len(matrices) > 2:
            left = max_plus(max_plus(*matrices[:2]), matrices[2])
            right = max_plus(matrices[0], max_plus(*matrices[1:3]))
            assert left[:2] == right[:2] and np.array_equal(left[2], right[2])
            assert combined(matrices)[2].shape == (1, 1)


def test_encode_and_decode(spark):
    texts = [t for t in ODD if t is None or "▁" not in t] + list(documents().values())[:60]
    frame = docs(spark, texts).selectExpr("*", "1 AS ids", "2 AS row")
    for chunk in (64, 32_768):
        encoded = encode_pieces(frame, chunk=chunk)
        assert encoded.columns == ["doc_id", "ids"]
        rows = decode_pieces(encoded).collect()
        assert len(rows) == len(texts)
        for r in rows:
            assert r["ids"] == PIECES.encode(texts[r["doc_id"]] or "")
            assert r["text"] == (texts[r["doc_id"]] or "")
    assert encode_pieces(docs(spark, [])).count() == 0
    assert [len(r["ids"]) for r in encode_pieces(docs(spark, ["a b", "a b"], [None, None])).collect()] == [2, 2]
    assert decode_pieces(encoded.selectExpr("cast(null AS array<int>) AS ids", "1 AS text")).first()["_text"] == ""


def test_sentencepiece_query(spark):
    texts = documents()
    rows = registered()["op3_sentencepiece_scan"](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        raw, ids = (texts[r["doc_id"]] or "").encode(), PIECES.encode(texts[r["doc_id"]] or "")
        assert (r["n_pieces"], r["ids_crc32"], r["decoded_bytes"], r["decoded_crc32"]) == (len(ids), crc(ids), len(raw), zlib.crc32(raw))


def test_strings_of_special_tokens_as_the_library_encodes_them():
    plain = Tokenizer.from_file(default_tokenizer())
    texts = ["see <|endoftext|> here", "<|endoft", "ext|>", "", None, "a  <|endoftext|>  b\n<|endoftext|><|endoftext|>", "été 日本 <|endoftext|>", "plain words <|endoftext"]
    ids, offsets = Encoder(default_tokenizer()).encode(pa.array(texts))
    for n, text in enumerate(texts):
        want = [*plain.encode(text or "", add_special_tokens=False).ids, 0]
        assert ids[offsets[n] : offsets[n + 1]].tolist() == want
    assert 50256 in ids[: offsets[1]]


@pytest.mark.parametrize("together", [2, 3])
def test_border_states_are_combined_in_a_tree(spark, monkeypatch, together):
    """Texts of very different numbers of chunks, over several levels, equal to the library."""
    monkeypatch.setattr(sentencepiece_scan, "TOGETHER", together)
    some = "the quick brown fox, été ñandú and internationalization of 日本語 " * 6
    texts = [some[:n] for n in (0, 10, 39, 40, 41, 80, 121, 200, 330)] + ["=" * 150, "x" * 90 + " y" * 60, None]
    got = {r["doc_id"]: r["ids"] for r in encode_pieces(docs(spark, texts), chunk=20).collect()}
    assert got == {i: PIECES.encode(t or "") for i, t in enumerate(texts)}
    assert {r["text"] for r in decode_pieces(encode_pieces(docs(spark, texts), chunk=20)).collect()} == {t or "" for t in texts}
