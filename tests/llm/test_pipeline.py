"""The pipeline's stages, each on its own input, against brute force."""

import hashlib

import numpy as np
import pytest

import corpus_pipeline
from trialframe.llm import byte_cnn, decontam, line_quality
from trialframe.llm.common import fold_is

from .test_ngram_join import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output rows of every stage at sf0.001."""
    sf, base = "/root/testdata/sf0.001", str(tmp_path_factory.mktemp("stages"))
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{base}/{name}")
        after = spark.read.parquet(f"{base}/{name}")
        out[name] = (docs, after)
        docs = after
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_order_and_columns(stages):
    assert list(stages) == ["quality_rules", "quality_classifier", "near_duplicates", "decontamination", "encoding"]
    for name, (_, after) in list(stages.items())[:-1]:
        assert after.columns == COLUMNS, name
        assert 0 < after.count()


def test_quality_rules(stages):
    before, after = stages["quality_rules"]
    verdicts = {r.doc_id: r for r in line_quality.judge(before).collect()}
    assert ids(after) == sorted(i for i, r in verdicts.items() if r.kept)
    texts = {r.doc_id: r.text for r in before.collect()}
    for r in after.collect():
        gone = set(verdicts[r.doc_id].removed_lines)
        lines = [x for x in texts[r.doc_id].split("\n") if not x.split() or line_quality.line_key(x.encode()) not in gone]
        assert r.text == "\n".join(lines) and r.n_chars == len(r.text)


def test_classifier(stages, spark):
    before, after = stages["quality_classifier"]
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = byte_cnn.fit(before, labels, "quality", ~fold_is("doc_id", 0))
    assert ids(after) == sorted(r.doc_id for r in before.collect() if byte_cnn.probability(model, r.text) >= corpus_pipeline.MIN_QUALITY)


def test_near_duplicates(stages):
    before, after = stages["near_duplicates"]
    found = brute([(r.doc_id, r.text) for r in before.collect()], 5, 80)
    assert ids(after) == sorted({c for _, c in found.values()})


def test_decontamination(stages, spark):
    before, after = stages["decontamination"]
    items = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    holds = {r.doc_id for r in before.collect() for t in items
             if " ".join(decontam.words_of(t)) in " ".join(decontam.words_of(r.text))}
    assert ids(after) == sorted(set(ids(before)) - holds)


def test_encoding(stages):
    import public_tokenizers as P
    import tiktoken

    from trialframe.llm.bpe import load_ranks
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={},
                                mergeable_ranks=load_ranks(P.path("byte_bpe_multi_50k.tiktoken")))
    before, after = stages["encoding"]
    texts = {r.doc_id: r.text for r in before.collect()}
    assert ids(after) == sorted(texts)
    for r in after.collect():
        want = np.array(library.encode_ordinary(texts[r.doc_id]), dtype="<u4").tobytes()
        assert bytes(r.ids) == want and r.n_tokens == len(want) // 4 and r.ids_sha256 == hashlib.sha256(want).hexdigest()


def test_encoder_and_decoder_do_not_run_side_by_side(stages, spark):
    plan = corpus_pipeline.encoding(spark, stages["encoding"][0], "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_run_gives_the_last_stage(stages, spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, stages["encoding"][1].collect()))


def test_stages_on_edges(spark, edge_docs, no_docs):
    sf = "/root/testdata/sf0.001"
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, edge_docs, sf).columns == edge_docs.columns, name
        assert stage(spark, edge_docs, sf).count() <= edge_docs.count()
        assert stage(spark, no_docs, sf).count() == 0
    assert corpus_pipeline.encoding(spark, edge_docs, sf).count() == edge_docs.count()
    assert corpus_pipeline.encoding(spark, no_docs, sf).count() == 0
