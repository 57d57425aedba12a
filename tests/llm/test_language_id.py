"""Language identification against all segmentations, and held-out accuracy."""

import math
import zlib

import numpy as np
import public_tokenizers
import sentencepiece
from cases import documents, prose, trouble
from conftest import TESTDATA

from marketbars.llm.language_id import Scorer, identify, language_of_documents, learn
from marketbars.llm.shared import table as read_table

PATH = public_tokenizers.path("piece_bpe_32k.model")


def test_words_are_summed_over_all_segmentations():
    processor = sentencepiece.SentencePieceProcessor(model_file=PATH)
    size = processor.get_piece_size()
    rng = np.random.default_rng(1)
    model = {lang: (p := rng.random(size)) / p.sum() for lang in ("a", "b")}
    ids = {processor.id_to_piece(i): i for i in range(size)}
    singles = {i for i in range(size) if processor.is_byte(i) or processor.is_control(i) or processor.is_unknown(i)}

    def total(text, p):
        if not text:
            return 1.0
        found = 0.0
        for n in range(1, len(text) + 1):
            piece = ids.get(text[:n])
            if piece is not None and piece not in singles:
                found += p[piece] * total(text[n:], p)
            elif n == 1:
                spelled = math.prod(p[ids[f"<0x{b:02X}>"]] for b in text[0].encode())
                found += max(spelled, 1e-60) * total(text[1:], p)
        return found

    scorer = Scorer(PATH, model)
    for word in ("the", "ñandú", "straße", "漢字", "ᚠx", "abcdefg"):
        one = [math.log(total("▁" + word, p)) for p in model.values()]
        assert np.allclose(scorer.word(word), one)
        scorer.score([word])
        assert np.allclose(scorer._logs[scorer._row[word]], one)


def test_very_long_words_do_not_vanish():
    size = sentencepiece.SentencePieceProcessor(model_file=PATH).get_piece_size()
    scorer = Scorer(PATH, {"a": np.full(size, 1 / size)})
    assert np.isclose(scorer.word("xq" * 3000)[0] / scorer.word("xq" * 1500)[0], 2, rtol=0.01)


def test_held_out_accuracy(spark):
    table = read_table(spark, str(TESTDATA / "sf0.01"), "documents")
    found = language_of_documents(table, PATH).join(table.select("doc_id", "lang"), "doc_id").collect()
    held_out = [r for r in found if r.held_out]
    assert len(found) == table.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    assert sum(r.lang == r.lang_pred for r in held_out) >= 0.95 * len(held_out)


def test_trouble(spark):
    found = language_of_documents(documents(spark, trouble()), PATH).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(i) for i, _ in trouble())
    for r in found:
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (r.doc_id in (5, 6, 7, 15) or (r.doc_id is None and r.score == 0))


def test_nothing_to_learn_from(spark):
    unlabelled = documents(spark, [(1, "some text"), (2, None)], lang=None)
    assert {(r.lang_pred, r.score) for r in language_of_documents(unlabelled, PATH).collect()} == {("und", 0.0)}
    assert language_of_documents(documents(spark, []), PATH).collect() == []


def test_identify_keeps_all_columns(spark):
    table = documents(spark, [(1, prose(1, 20)), (2, None)])
    found = identify(table, learn(table, PATH), PATH, ("language", "certainty"))
    assert found.columns == [*table.columns, "language", "certainty"]
    assert sorted(map(str, found.select(*table.columns).collect())) == sorted(map(str, table.collect()))
