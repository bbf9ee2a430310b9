"""The five stages, each against brute force on the rows it got."""

import pytest

import corpus_pipeline
from tests.llm.conftest import prose
from tests.llm.test_documents import base_counts, check_pieces, components_of
from vitrine.llm import fuzzy_lines, robust_quality
from vitrine.llm.common import folded_words


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """(name, input, output) of each stage, written and read as the runner does."""
    out, docs = [], spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.written(stage(spark, docs, sf_dir), name)
        out.append((name, docs, after))
        docs = after
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns(stages):
    assert [name for name, _, _ in stages] == ["quality", "line_dedup", "near_dedup", "decontaminate", "pack"]
    for _, before, after in stages[:-1]:
        assert after.dtypes == before.dtypes


def test_quality_stage(stages):
    _, before, after = stages[0]
    want = {r["doc_id"] for r in robust_quality.judge_documents(before).filter("kept").collect()}
    assert texts(after) == {i: t for i, t in texts(before).items() if i in want}
    assert all(base_counts(t)[0] >= 50 for t in texts(after).values())


def test_line_stage(stages):
    _, before, after = stages[1]
    gone = {(r["doc_id"], r["at"]) for r in fuzzy_lines.line_decisions(before).filter("not kept").collect()}
    want = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in texts(before).items()}
    assert texts(after) == {i: t for i, t in want.items() if t.split()}
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())


def test_near_stage(stages):
    _, before, after = stages[2]
    found = components_of(texts(before).items(), corpus_pipeline.NEAR_PERCENT)
    assert set(texts(after)) == {i for i, (_, root) in found.items() if i == root}


def test_leak_stage(spark, sf_dir, stages):
    _, before, after = stages[3]
    items = [b" ".join(folded_words(r["text"].encode())) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaked = {i for i, t in texts(before).items() if any(q in b" ".join(folded_words(t.encode())) for q in items)}
    assert not leaked & set(texts(after))
    assert len(texts(before)) - len(texts(after)) - len(leaked) <= 1


def test_pack_stage(stages):
    _, before, after = stages[4]
    check_pieces(after.collect(), list(texts(before).items()))


def test_odd_rows_pass_every_stage(spark, sf_dir, odd, empty):
    for docs in (odd, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = corpus_pipeline.written(stage(spark, docs, sf_dir), name)
            assert name == "pack" or out.columns == docs.columns
    near = corpus_pipeline.near_dedup(spark, odd, sf_dir).collect()
    assert sorted(r["doc_id"] for r in near if r["doc_id"] is not None) == [0, 1, 2, 3, 4, 5, 7, 8, 9, 10]


def test_near_stage_where_ids_clash(spark, sf_dir):
    """Each text of an id is judged on its own; a null digest (no text) too, and of equal rows one stays."""
    a, b, c = (prose(i, 80) for i in (401, 402, 403))
    near = a.rsplit(" ", 1)[0]
    rows = [(5, a, "x"), (5, b, "x"), (5, b, "w"), (3, near, "x"), (7, c, "x"), (7, None, "x"), (7, None, "x"), (None, a, "x"), (None, a, "x"), (9, c, "x"), (2, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = corpus_pipeline.near_dedup(spark, docs, sf_dir)
    want = [(3, near, "x"), (5, b, "w"), (7, c, "x"), (7, None, "x"), (None, a, "x"), (None, a, "x"), (2, "", "x")]
    assert got.columns == docs.columns and sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
