"""Token ids, the files that hold them, and packing."""

import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import regex
from cases import documents, prose, trouble
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marketbars.llm import packing, queries, tokens
from marketbars.llm.packing import pack_documents
from marketbars.llm.sequence_files import SequenceReader, binary_output, write_sequences
from marketbars.llm.shared import batches_by_size
from marketbars.llm.tokens import ByteLevelEncoder, encoder
from marketbars.storage import new_folder

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
LIBRARY.encode_special_tokens = True


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=400, deadline=None)
@given(
    st.text(
        st.one_of(st.sampled_from(list("ab 'sre\n\t  .,!1é²½　\x85\0")), st.characters(exclude_categories=["Cs"])),
        max_size=25,
    )
)
def test_ids_are_the_library_s(text):
    assert encoder(PATH).ids(text).tolist() == ids_of(text)


DEFAULTS = Tokenizer.from_file(PATH)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|endof", "text|>", " ", "  ", "a", " b.", "\n", "é", "'s"]), max_size=9))
def test_added_tokens_are_the_library_s(parts):
    text = "".join(parts)
    ids = DEFAULTS.encode(text, add_special_tokens=False).ids
    assert encoder(PATH, True).ids(text).tolist() == ids


LETTERS = st.one_of(
    st.sampled_from(list("ab  \n\n 'sre\t\r.,!1é²½　\x85\x1c\0")), st.characters(exclude_categories=["Cs"])
)
MARKED = ["<|endoftext|>", "<|endof", " ", "\n", "a", " b.", "\n\n", "é", "'s"]


@settings(max_examples=400, deadline=None)
@given(
    st.lists(st.one_of(st.none(), st.text(LETTERS, max_size=25)), max_size=6),
    st.sampled_from([pa.string(), pa.large_string()]),
)
def test_ids_of_many_texts_are_the_library_s(texts, kind):
    found = encoder(PATH).encode_all(pa.array(["dropped", *texts], kind).slice(1))
    assert [ids.tolist() for ids in found] == [ids_of(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(MARKED), max_size=9), max_size=4))
def test_added_tokens_of_many_texts_are_the_library_s(parts):
    texts = ["".join(p) for p in parts]
    found = encoder(PATH, True).encode_all(pa.array(texts, pa.string()))
    expected = [DEFAULTS.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids.tolist() for ids in found] == expected


def test_white_space_is_the_split_s():
    shown = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    held = pc.match_substring_regex(pa.array(shown), f"[{tokens._WHITE}]").to_pylist()
    assert held == [bool(regex.match(r"\s", c)) for c in shown]


def test_words_at_a_line_s_ends_are_two():
    encode = ByteLevelEncoder(PATH)
    ends, starts = ([f"{side}{c}{d}" for c in "abcdefgh" for d in "abcdefgh"] for side in "xy")
    texts = [f"a {e}.\n{s} b" for e in ends for s in starts]
    found = encode.encode_all(pa.array(texts))
    assert [i.tolist() for i in found[::97]] == [ids_of(t) for t in texts[::97]]
    # Not one for each pair of them, of which there are 4096.
    assert len(encode._words) + len(encode._pieces) < 300


def test_batches_by_size():
    texts = ["a" * n for n in (3, 3, 3, 50, 0, 0, 10)] + [None, "b"]
    batch = pa.record_batch([pa.array(range(9)), pa.array(texts)], names=["doc_id", "text"])
    cut = [b.column(1).to_pylist() for b in batches_by_size(iter([batch, batch.slice(9)]), 1, 10)]
    assert cut == [texts[:3], texts[3:4], texts[4:8], texts[8:]]


def test_index_scores_by_brute_force():
    rng = np.random.default_rng(3)
    tails = [rng.choice([5, 7, 9, 300, 65534, 65535], n).astype("<u2") for n in (1, 4, 9, 30, 30)]
    idf, mean = rng.random(1 << 16), 14.8
    for seed, own in enumerate(tails):
        expected = []
        for tail in tails:
            count = np.array([(tail == t).sum() for t in np.unique(own)])
            norm = 1.2 * (0.25 + 0.75 * len(tail) / mean)
            expected.append((idf[np.unique(own)] * count * 2.2 / (count + norm)).sum())
        assert packing._Shard(tails, idf, mean).scores(seed) == pytest.approx(expected)


def test_queries_find_added_tokens(spark, tmp_path):
    rows = [(1, "a<|endoftext|>b"), (2, "plain text"), (3, "x <|endoftext|><|endoftext|> y")]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    expected = [DEFAULTS.encode(t, add_special_tokens=False).ids for _, t in rows]
    found = sorted(queries.op10_sequence_files(spark, str(tmp_path)).collect(), key=lambda r: r.doc_id)
    assert [(r.n_tokens, r.ids_crc32) for r in found] == [(len(e) + 1, crc([*e, 2])) for e in expected]
    assert [r.start for r in found] == [0, len(expected[0]) + 1, len(expected[0]) + len(expected[1]) + 2]
    for packed in (
        queries.op6_packing(spark, str(tmp_path)),
        corpus_pipeline.pack(spark, documents(spark, rows), str(tmp_path)),
    ):
        assert {(r.doc_id, r.doc_tokens) for r in packed.collect()} == {
            (i, len(e) + 1) for (i, _), e in zip(rows, expected, strict=True)
        }


def test_sequence_files(spark):
    rows = trouble() + [(200 + i, prose(i, 50)) for i in range(60)]
    found = binary_output(documents(spark, rows), PATH).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    expected, start = [], 0
    for i, t in order:
        ids = [*ids_of(t), 2]
        expected.append((str(i), start, len(ids), crc(ids)))
        start += len(ids)
    got = [(str(r.doc_id), r.start, r.n_tokens, r.ids_crc32) for r in found]
    assert sorted(got) == sorted(expected)


def test_sequences_and_masks(spark):
    text = prose(5, 700)
    folder = new_folder(spark)
    (file,) = write_sequences(documents(spark, [(1, text)]), folder, PATH, 2, 64).collect()
    ids = [*ids_of(text), 2]
    assert (file.n_docs, file.n_ids) == (1, len(ids))
    with SequenceReader(file.path) as reader:
        whole, mask = reader.sequence(3)
        assert whole.tolist() == ids[192:256] and mask.all()
        last, mask = reader.sequence(len(ids) // 64)
        assert last[mask].tolist() == ids[len(ids) // 64 * 64 :]
        assert np.concatenate(reader.ids(10, 500)).tolist() == ids[10:510]
        assert not reader.batch(0)[0].flags.owndata


def test_empty_tables(spark):
    assert binary_output(documents(spark, []), PATH).collect() == []
    assert pack_documents(documents(spark, []), PATH).collect() == []


@pytest.mark.parametrize("shard", [2048, 8])
def test_packing(spark, monkeypatch, shard):
    monkeypatch.setattr(packing, "_SHARD_ROWS", shard)
    rows = [r for r in trouble() if r[0] is not None and r[0] not in (2, 9)]
    rows += [(300 + i, prose(i, 20 + i * 3)) for i in range(80)]
    found = pack_documents(documents(spark, rows), PATH, window=256).collect()
    pieces = {}
    for r in sorted(found, key=lambda r: r.start):
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == {i for i, _ in rows}
    for i, t in rows:
        ids, at = [*ids_of(t), 1], 0
        for r in pieces[i]:
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == crc(ids[at : at + r.length])
            at += r.length
        assert at == len(ids)
    sequences = {}
    for r in sorted(found, key=lambda r: r.offset):
        held = sequences.setdefault(r.sequence_id, 0)
        assert r.offset == held
        sequences[r.sequence_id] += r.length
    # Full, or of a length that needs no padding.
    assert all(n == 256 or n & (n - 1) == 0 for n in sequences.values())


def test_a_window_holds_its_seed_s_neighbours():
    rng = np.random.default_rng(0)
    topics = [rng.integers(k * 500, k * 500 + 60, size=(12, 100)) for k in range(3)]
    tails = [t.astype("<u2") for topic in topics for t in topic]
    idf = np.ones(1600)
    windows = packing.fill_windows(tails, idf, 100.0, 400)
    for window in windows[:6]:
        assert len({unit // 12 for unit, _, _ in window}) == 1


def test_repeated_and_missing_ids_are_packed(spark):
    rows = [(None, "a b"), (1, "x"), (1, "x"), (None, None)]
    found = pack_documents(documents(spark, rows), PATH).collect()
    assert sum(r.length for r in found) == sum(len(ids_of(t)) + 1 for _, t in rows)
