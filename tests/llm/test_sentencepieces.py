import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from tributary.llm import sentencepieces as S
from tributary.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", " ", "a", "  two  spaces ", "Hé\n\tb ▁ x 😀\x00z 1", "ｆｕｌｌ ①ﬁ é", "x" * 5000, "ab " * 3000, "　wide ", "لا ١"]


def test_query_equals_the_library(spark, sf_dir):
    processor = sentencepiece.SentencePieceProcessor(model_file=PATH)
    got = {r.doc_id: r for r in QUERIES["op9_sentencepiece"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = processor.encode(d.text or "")
        r = got[d.doc_id]
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(processor.decode(ids).encode()).hexdigest()
        assert r.span_bytes == len((d.text or "").encode())
        # the pieces' own texts, after the blank that is put in front, lie end to end in the text
        if not any(map(processor.is_byte, ids)):
            ends = np.cumsum([len(processor.id_to_piece(i).replace("▁", " ").encode()) for i in ids]) - 1
            begins = np.concatenate([[0], ends[:-1]])[: len(ids)]
            raw = begins.astype("<i4").tobytes() + ends.astype("<i4").tobytes()
            assert r.spans_sha256 == hashlib.sha256(raw).hexdigest()


def test_spans_of_edge_cases(spark):
    rows = [(k, t, "extra") for k, t in enumerate(TEXTS)] + [(None, None, "x"), (1, " ", "again"), (1, " ", "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = S.encoded(df, PATH).collect()
    assert len(got) == len(rows)
    processor = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for r in got:
        text = TEXTS[r.doc_id] if r.doc_id is not None else ""
        assert r.ids == processor.encode(text) and r.decoded == processor.decode(r.ids)
        raw = text.encode()
        assert b"".join(raw[a:b] for a, b in zip(r.begins, r.ends)) == raw
    assert S.encoded(df.limit(0), PATH).count() == 0


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
@pytest.mark.parametrize("strip", [True, False])
def test_normalisation_equals_the_library(rule, strip):
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=strip)
    rules = S.rules_of(library.serialized_model_proto())
    assert bool(len(rules.units)) == (rule != "identity")
    for text in TEXTS:
        want, starts = library.normalize(text, with_offsets=True)
        got, origin = S.normalised(rules, text.encode())
        assert got.decode() == want
        characters = [0]
        for c in text:
            characters.append(characters[-1] + len(c.encode()))
        places = [0]
        for c in want:
            places.append(places[-1] + len(c.encode()))
        assert [characters[s] for s in starts] == [int(origin[p]) for p in places]


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
@pytest.mark.parametrize("strip", [True, False])
def test_a_model_with_a_character_map(spark, tmp_path, rule, strip):
    """The given vocabulary under another normaliser: ids as the library gives them, spans by the map's alignment."""
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=strip)
    raw = open(PATH, "rb").read()
    spec = dict(S.fields(library.serialized_model_proto()))[3]
    path = tmp_path / "mapped.model"
    path.write_bytes(S.message([(n, v) for n, v in S.fields(raw) if n != 3] + [(3, spec)]))
    processor = sentencepiece.SentencePieceProcessor(model_file=str(path))
    got = {r.doc_id: r for r in S.encoded(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string"), str(path)).collect()}
    for k, text in enumerate(TEXTS):
        r, source = got[k], text.encode()
        assert r.ids == processor.encode(text) and r.decoded == processor.decode(r.ids)
        want, origin = S.normalised(S.rules_of(path.read_bytes()), source)
        assert all(0 <= a <= b <= len(source) for a, b in zip(r.begins, r.ends)) and r.begins[1:] == r.ends[:-1]
        # the text between two cuts of the source normalises to the pieces between them
        at = 0
        for i, begin in zip(r.ids, r.begins):
            assert origin[at] == begin
            at += 1 if processor.is_byte(i) else len(processor.id_to_piece(i).encode())
        assert at == len(want)
