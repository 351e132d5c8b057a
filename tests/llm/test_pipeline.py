"""The stages over the smallest tables, each against what it should do with its own input."""

import re
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from lakeferry.llm import queries

SF_DIR = "/root/testdata/sf0.001"


def test_queries_are_registered():
    found = entry_point.queries()
    assert queries.QUERIES.keys() <= found.keys() and "pipeline" in found
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in queries.QUERIES) == [*range(1, 14)]


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of each stage, as lists of rows."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    steps = [("documents", docs.collect())]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_DIR)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        rows = out.collect()
        steps.append((name, rows))
        docs = spark.createDataFrame(rows, docs.schema) if k < len(corpus_pipeline.STAGES) - 1 else None
    return steps


def test_stages_only_take_documents_away(stages):
    for (_, before), (name, after) in zip(stages, stages[1:]):
        ids = {r["doc_id"] for r in before}
        assert len(after) <= len(before) and {r["doc_id"] for r in after} <= ids, name
    assert [n for n, _ in stages[1:]] == ["quality", "near_duplicates", "decontamination", "source_mixing", "token_files"]
    assert len(stages[1][1]) < len(stages[0][1]) and len(stages[2][1]) < len(stages[1][1])
    texts = [r["text"] for r in stages[2][1]]
    assert len(texts) == len(set(texts))


def test_clean_documents_stay(spark, stages):
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    clean = {k for k, r in labels.items() if r["quality"] == 1 and r["toxic"] == 0}
    steps = dict(stages)
    for name, before in (("quality", "documents"), ("source_mixing", "decontamination")):
        had = clean & {r["doc_id"] for r in steps[before]}
        kept = had & {r["doc_id"] for r in steps[name]}
        assert len(kept) >= 0.97 * len(had), name


def test_the_last_stage_covers_the_kept_documents(stages):
    kept, out = stages[-2][1], stages[-1][1]
    assert sorted(r["doc_id"] for r in kept) == sorted(r["doc_id"] for r in out)
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start, got = 0, {r["doc_id"]: r for r in out}
    for r in sorted(kept, key=lambda r: r["doc_id"]):
        ids = [*tokenizer.encode(r["text"], add_special_tokens=False).ids, 1]
        row = got[r["doc_id"]]
        assert (row["start"], row["n_tokens"]) == (start, len(ids))
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_run_gives_the_stages_rows(spark, stages):
    got = sorted(r["doc_id"] for r in corpus_pipeline.run(spark, SF_DIR).collect())
    assert got == sorted(r["doc_id"] for r in stages[-1][1])


def test_empty_tables(spark, tmp_path):
    for name in ("documents", "labels", "benchmark", "pages", "embeddings"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    for name, query in {**queries.QUERIES, "pipeline": corpus_pipeline.run}.items():
        assert query(spark, str(tmp_path)).count() == 0, name
