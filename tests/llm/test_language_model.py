"""Scoring by prediction by partial matching, against a trie of dictionaries."""

import math
import zlib
from collections import Counter, defaultdict

import pytest
from cases import documents, prose, trouble

from marketbars.llm.lm_scoring import score_documents


def learned_from(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 != 2


def data_of(text):
    return (text or "").encode().lower()


def trie(texts, order):
    nodes = [defaultdict(Counter) for _ in range(order + 1)]
    for t in texts:
        marked = b"\xfe" * order + data_of(t) + b"\xff"
        for p in range(order, len(marked)):
            for k in range(order + 1):
                nodes[k][marked[p - k : p]][marked[p]] += 1
    return nodes


def log_probability(nodes, text, order):
    marked, total = b"\xfe" * order + data_of(text) + b"\xff", 0.0
    for p in range(order, len(marked)):
        excluded = set()
        for k in range(order, -1, -1):
            seen = nodes[k].get(marked[p - k : p], {})
            left = {s: n for s, n in seen.items() if s not in excluded}
            if left:
                if marked[p] in left:
                    total += math.log10((left[marked[p]] - 0.5) / sum(left.values()))
                    break
                total += math.log10(len(left) / 2 / sum(left.values()))
            excluded |= set(seen)
        else:
            total -= math.log10(255 - len(excluded))
    return total


@pytest.mark.parametrize("order", [2, 5])
def test_scores(spark, order):
    rows = trouble() + [(100 + i, prose(i, 40)) for i in range(20)]
    rows = [(i, t) for i, t in rows if t is None or len(t) < 20_000]
    train = [t for i, t in rows if learned_from(i)]
    counts = Counter(w for t in train for w in [*data_of(t).split(), None])
    nodes = trie(train, order)
    below = counts.total() + len(counts) + 1
    expected = []
    for i, t in rows:
        words = [*data_of(t).split(), None]
        base = sum(math.log10((counts[w] + 1) / below) for w in words)
        known = sum(counts[w] > 0 for w in words)
        score = log_probability(nodes, t, order)
        expected.append((str(i), not learned_from(i), len(words), known, counts.total(), round(base, 6), round(score, 6)))
    found = score_documents(documents(spark, rows), order).collect()
    got = [
        (str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
        for r in found
    ]
    assert sorted(got) == sorted(expected)


def test_probabilities_add_up_to_one():
    import numpy as np

    from marketbars.llm.lm_scoring import _count_events, _Counts, code_lengths, lower_orders

    counts = _Counts()
    _count_events(counts, [b"abracadabra", b"banana band"], np.array([True, True]), 3)
    orders = lower_orders(*counts.merged(), 3)
    for context in (b"bra", b"zzz", b"an\xfe", b"\xfe\xfe\xfe"):
        newest_first = int.from_bytes(context[::-1], "big")
        keys = np.array([newest_first << 8 | s for s in range(256) if s != 0xFE], np.uint64)
        assert np.isclose((10.0 ** code_lengths(keys, orders)).sum(), 1)


def test_runs_of_any_size_score_alike(spark, monkeypatch):
    """Pairs are worked off in runs of whole contexts of three bytes."""
    from marketbars.llm import lm_scoring

    rows = [(i, t) for i, t in trouble() if i is not None]
    scores = []
    for size in (1 << 20, 40, 1):
        monkeypatch.setattr(lm_scoring, "_RUN", size)
        scores.append(sorted((r.doc_id, r.score) for r in score_documents(documents(spark, rows)).collect()))
    assert scores[0] == scores[1] == scores[2]
    with pytest.raises(ValueError, match="order"):
        score_documents(documents(spark, rows), 1)


def test_without_training_texts(spark):
    held_out = next(i for i in range(100) if not learned_from(i))
    (row,) = score_documents(documents(spark, [(held_out, "abc")])).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (2, 0, 0, 0)
    assert math.isclose(row.score, -4 * math.log10(255))


def test_an_empty_table(spark):
    assert score_documents(documents(spark, [])).collect() == []


def test_long_texts_are_cut_without_loss(spark, monkeypatch):
    from marketbars.llm import lm_scoring

    rows = [(i, prose(i, 300)) for i in range(12)]
    whole = {r.doc_id: round(r.score, 6) for r in score_documents(documents(spark, rows)).collect()}
    import numpy as np

    monkeypatch.setattr(lm_scoring, "_SEGMENT", 64)
    counts = lm_scoring._Counts()
    train = np.array([learned_from(i) for i, _ in rows])
    lm_scoring._count_events(counts, [t.encode() for _, t in rows], train, 5)
    keys, n = counts.merged()
    lengths = lm_scoring.code_lengths(keys, lm_scoring.lower_orders(keys, n, 5))
    for i, t in rows:
        total = 0
        for _, parts in lm_scoring._segments([t.encode()], 5):
            event, _ = lm_scoring._events(parts, 5)
            total += lengths[np.searchsorted(keys, event)].sum()
        assert round(total, 6) == whole[i]
