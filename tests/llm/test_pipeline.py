import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline as C
from tests.llm.test_jaccard import brute
from tests.llm.test_secrets import slow_base
from tributary.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The rows after every stage, each written and read again."""
    out, docs = [spark.read.parquet(f"{SF}/documents.parquet")], None
    for name, stage in C.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_columns(steps):
    for df in steps[:-1]:
        assert df.columns == COLUMNS
    assert {"doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(steps[-1].columns)


def test_quality_stage_drops_what_is_rejected(spark, steps):
    predicted = {r.doc_id: r.predicted for r in QUERIES["op4_quality"](spark, SF).collect()}
    kept = {r.doc_id for r in steps[1].collect()}
    assert kept == {i for i, p in predicted.items() if p == 1}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert sum(i in kept for i, q in labels.items() if q == 1) >= 0.97 * sum(q == 1 for q in labels.values())


def test_one_document_of_each_group_stays(steps):
    before = [(r.doc_id, r.text) for r in steps[1].collect()]
    assert sorted(r.doc_id for r in steps[2].collect()) == sorted({c for _, c, _ in brute(before)})


def test_secrets_are_gone_and_nothing_else(steps):
    before, after = {r.doc_id: r for r in steps[2].collect()}, {r.doc_id: r for r in steps[3].collect()}
    assert before.keys() == after.keys()
    for i, r in after.items():
        assert not slow_base(r.text or "")
        if not slow_base(before[i].text or "") and "[SECRET]" not in r.text:
            assert r == before[i]


def test_mixture_takes_whole_turns(steps):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    before = {r.doc_id: r for r in steps[3].collect()}
    taken, cut = Counter(), Counter()
    for r in steps[4].collect():
        whole = before[r.doc_id]
        taken[r.source] += size(r.text)
        assert whole.text.startswith(r.text) or whole.text.lstrip().startswith(r.text)
        cut[r.source] += size(r.text) < size(whole.text)
    total = sum(size(r.text) for r in before.values())
    assert max(cut.values()) <= 1 and abs(sum(taken.values()) - total) <= len(taken)


def test_encoding_is_the_library_s(steps):
    processor = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = Counter((r.doc_id, tuple(processor.encode(r.text))) for r in steps[4].collect())
    assert Counter((r.doc_id, tuple(r.ids)) for r in steps[5].collect()) == want


def test_run_gives_the_same_rows(spark, steps):
    key = lambda df: Counter((r.doc_id, r.ids_sha256) for r in df.collect())
    assert key(C.run(spark, SF)) == key(steps[-1])


def test_stages_on_an_empty_table(spark, steps):
    docs = steps[0].limit(0)
    for _, stage in C.STAGES:
        docs = stage(spark, docs, SF) if docs.columns == COLUMNS else docs
        assert docs.count() == 0


def test_crc_fold_is_the_contract_s(spark):
    got = {r.doc_id: r.held_out for r in QUERIES["op4_quality"](spark, SF).collect()}
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in got.items())
