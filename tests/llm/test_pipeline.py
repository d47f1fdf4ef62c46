"""The five stages one by one, and together."""

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from courtstats.llm import bpe, decontaminate, line_dedup, quality_model, simhash
from courtstats.llm.common import read

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage."""
    out, docs = [], read(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, SF).persist()
        out.append((name, docs, made))
        docs = made
    return out


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


def test_stages_keep_the_columns(stages):
    assert len(stages) == 5
    for _, docs, made in stages[:-1]:
        assert made.columns == docs.columns and made.dtypes == docs.dtypes


def test_each_stage_does_what_its_operator_says(spark, stages):
    quality, lines, copies, leaks, tokens = stages
    model = quality_model.fit(quality[1], read(spark, SF, "labels"))
    scored = quality_model.score(quality[1], model)
    assert ids(quality[2]) == ids(scored.where(f"fm_score >= {quality_model.THRESHOLD}"))
    cut = {r.doc_id: r.text for r in line_dedup.dedup_lines(lines[1]).collect()}
    assert {r.doc_id: r.text for r in lines[2].collect()} == cut
    assert lines[2].where("n_chars <> char_length(text)").count() == lines[1].where("n_chars <> char_length(text)").count()
    named = simhash.near_duplicates(copies[1]).where("doc_id = component")
    assert ids(copies[2]) == ids(named)
    found = decontaminate.find_leaks(leaks[1], read(spark, SF, "benchmark")).select("doc_id").distinct()
    assert ids(leaks[2]) == sorted(set(ids(leaks[1])) - set(ids(found)))
    path = bpe.multi_path()
    ranks = bpe.load_ranks(path)
    token = {rank: piece for piece, rank in ranks.items()}
    texts = {r.doc_id: r.text for r in tokens[1].collect()}
    for r in tokens[2].collect():
        raw = b"".join(token[i] for i in np.frombuffer(r.token_ids, "<u4").tolist())
        assert raw.decode() == texts[r.doc_id] and r.n_tokens == len(r.token_ids) // 4


def test_run_equals_the_stages(spark, stages):
    rows = {r.doc_id: bytes(r.token_ids) for r in corpus_pipeline.run(spark, SF).collect()}
    assert rows == {r.doc_id: bytes(r.token_ids) for r in stages[-1][2].collect()}


def test_stages_bear_odd_rows(spark, docs, empty):
    for table in (docs, empty):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, table, SF).count() <= table.count()


def test_queries_are_registered():
    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert len([q for q in names if q.startswith(f"op{n}_")]) == 1
