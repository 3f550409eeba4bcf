"""The pipeline against its stages' plain answers."""

import os

import corpus_pipeline
import pytest

import __spark_entry__ as entry
from tests.llm.helpers import ODD, documents, table, words
from tests.llm.test_dedup import plain_classes, plain_groups
from tests.llm.test_files import check_packing
from tests.llm.test_filters import base_counts

SF_DIR = "/root/testdata/sf0.01"  # large enough to train the classifier


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returned, by name of its function."""
    at, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    for _, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / stage.__name__)
        frame = stage(spark, at, SF_DIR)
        if stage is not corpus_pipeline.packing:
            assert frame.schema.names == at.schema.names
        frame.write.parquet(path)
        at = spark.read.parquet(path)
        out[stage.__name__] = at.collect()
    return out


def test_every_stage_takes_effect(stages):
    texts, toxic = documents(SF_DIR), {r[0]: r[2] for r in table("labels", SF_DIR)}
    quality = {r["doc_id"] for r in stages["quality"]}
    failed = {i for i, t in texts.items() if (c := base_counts(t))[0] < 10 or 100 * c[4] > 20 * c[0]}
    assert quality and not quality & failed
    calm = {r["doc_id"]: r["text"] for r in stages["toxicity"]}
    bad = [i for i in quality if toxic.get(i)]
    assert set(calm) <= quality and sum(i in calm for i in bad) <= 0.05 * len(bad)
    good = [i for i in quality if toxic.get(i) == 0]  # few labels train the classifier here
    assert sum(i not in calm for i in good) <= 0.02 * len(good)
    different = {r["doc_id"]: r["text"] for r in stages["copies"]}
    assert set(different) == {i for i, _ in plain_groups(list(calm.items())).values()}
    apart = {r["doc_id"]: r["text"] for r in stages["near_duplicates"]}
    assert set(apart) == {root for root, _ in plain_classes(list(different.items())).values()}
    check_packing(stages["packing"], apart)
    assert all(words(t) for t in apart.values())


def test_run_is_the_stages_in_a_row(spark, stages):
    got = corpus_pipeline.run(spark, SF_DIR)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(tuple(r[k] for k in key) for r in got.collect()) == sorted(tuple(r[k] for k in key) for r in stages["packing"])


def test_registered():
    names = entry.queries()
    assert "pipeline" in names and {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names}
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in entry.oracle_sql()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "toxicity", "exact dedup", "n-gram Jaccard join", "best-fit packing"]
    assert os.path.exists(corpus_pipeline.__file__)


def odd_documents(spark):
    """Null, empty and long texts, ties, repeated rows, null ids, and columns named like the stages' own."""
    prose = [f"the people of town {i} and the river walk to the old market with bread and wine for {i % 3} days" for i in range(12)]
    texts = [*ODD, *prose, prose[0], prose[0] + " ", "the " + " ".join(f"long word{i % 5000}" for i in range(60_000)), "<|endoftext|> and the end of the text of the day is here now"]
    rows = [(i, t, None if i % 4 else "en") for i, t in enumerate(texts)] + [(None, prose[1], None), (None, None, None), (3, texts[3], "en"), (3, texts[3], "en")]
    clash = ["quality", "kept", "score", "label", "keep_id", "class_id", "n_links", "row", "text_sha256", "maybe", "bucket", "fingerprint", "chars", "features"]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return frame.selectExpr("*", *[f"'x' AS {c}" for c in clash])


@pytest.mark.parametrize("empty", [False, True])
def test_stages_take_odd_input(spark, tmp_path, empty):
    at = odd_documents(spark).limit(0) if empty else odd_documents(spark)
    # the stages on all rows, whatever an earlier one would have kept
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, at, SF_DIR)
        path = str(tmp_path / stage.__name__)
        out.write.parquet(path)
        rows = spark.read.parquet(path)
        if stage is not corpus_pipeline.packing:
            assert rows.columns == at.columns
        assert rows.isEmpty() == empty
        if stage in (corpus_pipeline.copies, corpus_pipeline.near_duplicates) and not empty:
            texts = [r["text"] for r in rows.collect()]
            key = (lambda t: "".join((t or "").split())) if stage is corpus_pipeline.copies else (lambda t: tuple(words(t)))
            some = [key(t) for t in texts if words(t)]
            assert len(some) == len(set(some))
            assert {key(r["text"]) for r in at.collect() if words(r["text"])} >= set(some)
        if stage is corpus_pipeline.packing and not empty:
            assert {r["doc_id"] for r in rows.collect()} == {r["doc_id"] for r in at.collect()}
