"""The Jaccard join against all pairs."""

import random

import pytest
from cases import documents, edit, prose, trouble

from marketbars.llm import jaccard_join
from marketbars.llm.jaccard_join import link_documents


def shingles(text, n):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def expected(rows, n, percent):
    sets = [(i, shingles(t, n)) for i, t in rows]
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, x in sets:
        for b, y in sets:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                one, two = find(a), find(b)
                root[max(one, two)] = min(one, two)
    return sorted((str(i), len(s), str(find(i) if i is not None and s else i)) for i, s in sets)


def actual(frame):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in frame.collect())


def family(seed, size):
    base = prose(seed, 160, 3000)
    rng = random.Random(seed)
    return [edit(base, seed * 1000 + k, rng.choice([0, 1, 1, 2, 3, 4, 6])) for k in range(size)]


ROWS = [t for s, n in ((11, 30), (12, 12), (13, 3)) for t in family(s, n)]
ROWS += [prose(s, s % 70, 3000) for s in range(20, 50)]
ROWS = [(100 + i, t) for i, t in enumerate(ROWS)]


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (5, 80)])
def test_components(spark, words, percent):
    rows = [r for r in trouble() if r[0] != 9] + ROWS
    got = actual(link_documents(documents(spark, rows), words, percent))
    assert got == expected(rows, words, percent)


@pytest.mark.parametrize("percent", [80, 90])
def test_short_texts_less_words_at_an_end(spark, percent):
    rows = []
    for size in range(3, 31):
        for k in range(12):
            words = prose(size * 100 + k, size, 100_000).split(" ")
            rows += [words, words[1:] if k % 2 else words[:-1], words[2:]]
    rows = [(i, " ".join(w)) for i, w in enumerate(rows)]
    assert actual(link_documents(documents(spark, rows), 3, percent)) == expected(rows, 3, percent)


def test_a_wide_prefix_asks_for_no_more_than_any_partner_shares():
    for percent in (50, 73, 80, 90, 95, 100):
        for n in range(1, 1500):
            partners = range(-(-percent * n // 100), 100 * n // percent + 1)
            least = min(jaccard_join._wide_parts(m, percent)[1] for m in partners)
            assert jaccard_join.JaccardJoin(3, percent)._wide(n)[1] == least


def test_large_clusters(spark, monkeypatch):
    """The rounds for clusters that are too large for one task."""
    monkeypatch.setattr(jaccard_join, "_MOST_ITEMS", 2)
    monkeypatch.setattr(jaccard_join, "_BLOCK", 3)
    got = actual(link_documents(documents(spark, ROWS), 3, 90))
    assert got == expected(ROWS, 3, 90)


def test_repeated_rows_are_one_item(spark):
    base = prose(21, 40, 3000)
    own = jaccard_join._set_id(jaccard_join.shingles(base, 3))
    rows = documents(spark, [(1, base)] * 60 + [(1, prose(22, 40, 3000)), (2, base)])
    chosen = spark.createDataFrame([(1, own, 7, False)], "doc_id long, id long, cluster long, large boolean")
    join = jaccard_join.JaccardJoin(3, 90)
    (item,) = join._items(rows.select("doc_id", "text"), chosen).collect()
    assert (item.cluster, item.id, item.large) == (7, own, False)
    several = [(7, own, task) for task in (5, 3, 4)] + [(7, own + 1, 4)]
    found = join._once(spark.createDataFrame(several, "cluster long, id long, task int"))
    assert sorted(r.id for r in found.collect()) == [own, own + 1]


def test_an_empty_table(spark):
    assert link_documents(documents(spark, [])).collect() == []
    assert actual(link_documents(documents(spark, [(1, None), (2, "")]))) == [("1", 0, "1"), ("2", 0, "2")]


def test_components_of_a_graph(spark):
    from marketbars.llm.components import connected_components

    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 440)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        one, two = find(a), find(b)
        root[max(one, two)] = min(one, two)
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in connected_components(frame).collect()}
    alone = {a for a, b in edges if a == b} - {x for e in edges if e[0] != e[1] for x in e}
    assert got == {x: find(x) for x in root if x not in alone}
