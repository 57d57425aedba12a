"""Lines, URLs, quality and benchmark leaks."""

import itertools
import re
import time
from collections import Counter

import numpy as np
import pytest
from cases import documents, edit, prose, trouble
from conftest import TESTDATA
from oracle import assert_same, connect

from marketbars.llm import decontaminate, quality_rules
from marketbars.llm.decontaminate import find_leaks, plain_words, similarity
from marketbars.llm.line_dedup import LINE, _long_enough, dedup_units, normalise
from marketbars.llm.oracles import ORACLES
from marketbars.llm.quality_rules import count_text, judge_documents
from marketbars.llm.queries import QUERIES
from marketbars.llm.url_filters import judge_urls

SF = TESTDATA / "sf0.01"


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_against_sql(spark, name):
    con = connect(SF)
    assert_same(QUERIES[name](spark, str(SF)).toPandas(), con.execute(ORACLES[name]).df())
    con.close()


LINES = [
    (3, "A line of five good words\nshort one\nA  LINE of five, good words!\nlast line of the third text"),
    (1, "first\nThe same long line again here\n\n"),
    (2, "the same LONG line again here\nsomething of its own to say\n"),
    (2, "the same LONG line again here\nsomething of its own to say\n"),
    (None, "something of its own to say"),
]


SENTENCES = [
    (40, "One short. This sentence here has nine words, so it counts. Short. Another one of eight words is this one."),
    (41, "Begin! Not this. THIS sentence here has nine words; so it counts! And this is the end of it"),
    (42, "alone\nthis sentence here has nine words so it counts\n\nAnother one of eight words is this one. Ok. ok.\n"),
    (43, "漢字文章" * 11 + "。 " + "別文章" * 15 + "。\n" + "漢字文章" * 11 + "。"),
    (45, "... this is one sentence of more than eight words with signs beside it. ###\nshort"),
    (44, "ok. ok.\nhi\nhi\nme too\nx\nme, too"),
]


def units_by_hand(text, separator):
    """(first, length, words, key or None, key of its line or None) of each sentence."""
    out, at = [], 0
    parts = text.split(separator)
    lines = [p + separator for p in parts[:-1]] + ([parts[-1]] if parts[-1] else [])
    for line in lines:
        plain = normalise(line)
        whole = plain if plain and (len(plain.split()) >= 2 or len(plain) >= 6) else None
        ends = [m.end() for m in re.finditer(r"[.!?。！？]+[ \t-\r]*", line)]
        ends = ends if ends and ends[-1] == len(line) else [*ends, len(line)]
        for start, end in itertools.pairwise([0, *ends]):
            own = normalise(line[start:end])
            own = own if len(ends) > 1 and own != plain and (len(own.split()) >= 8 or len(own) >= 40) else None
            words = len(normalise(line[start:end]).split())
            out.append((at + start, end - start, words, own, whole, at))
        at += len(line)
    return out


def longest(flags, words, texts=None):
    """With texts, sentences that are too short to be compared count for nothing."""
    if texts:
        long = [f or len(t.split()) >= 8 or len(t) >= 40 for f, t in zip(flags, texts, strict=True)]
        flags, words = ([x for x, y in zip(v, long, strict=True) if y] for v in (flags, words))
    runs = itertools.groupby(zip(flags, words, strict=True), key=lambda x: x[0])
    return max((sum(n for _, n in run) for flag, run in runs if flag), default=0)


@pytest.mark.parametrize("separator", ["\n", "\n\n"])
def test_lines(spark, separator):
    rows = [r for r in trouble() if r[0] not in (2, 9)] + [(20 + (i or 9), t) for i, t in LINES[:3]]
    rows += [(None, "something of its own to say"), *SENTENCES]
    units = [units_by_hand(t or "", separator) for _, t in rows]
    places = {}
    for row, ((i, _), own) in enumerate(zip(rows, units, strict=True)):
        for first, _, _, key, line, start in own:
            for k, at in ((key, first), (line, start)):
                if k:
                    places.setdefault(k, set()).add((i is None, i or 0, at, row))
    expected = []
    for row, ((i, t), own) in enumerate(zip(rows, units, strict=True)):
        gone, again, spans, kept = [], [], [], ""
        for first, length, _, key, line, start in own:
            held = [(places[k], at) for k, at in ((key, first), (line, start)) if k]
            again.append(any(len(p) > 1 for p, _ in held))
            gone.append(any(min(p) != (i is None, i or 0, at, row) for p, at in held))
            if not gone[-1]:
                kept += t[first : first + length]
            elif spans and sum(spans[-1]) == first:
                spans[-1] = (spans[-1][0], spans[-1][1] + length)
            else:
                spans.append((first, length))
        words, plain = [u[2] for u in own], [normalise(t[u[0] : u[0] + u[1]]) for u in own]
        counts = len(own), sum(gone), sum(n for _, n in spans), longest(gone, words), longest(again, words, plain)
        expected.append((str(i), *counts, spans, None if t is None else kept))
    found = dedup_units(documents(spark, rows), separator).collect()
    got = [(str(r.doc_id), *r[1:6], [tuple(x) for x in r.removed], r.text) for r in found]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_a_text_of_many_lines(spark):
    """Work grows with the text, not with the square of its lines."""
    lines = [f"this is line number {i} of a long text" for i in range(200_000)]
    rows = [(1, "\n".join(lines)), (2, "\n".join([*lines[:5], "of its own", *lines[100_000:]]))]
    start = time.perf_counter()
    found = {r.doc_id: r for r in dedup_units(documents(spark, rows)).collect()}
    assert time.perf_counter() - start < 60
    assert found[1].n_removed == 0 and found[1].longest_repeated == 9 * 100_000
    assert (found[2].n_removed, found[2].text) == (100_005, "of its own\n")
    assert [x.first for x in found[2].removed] == [0, len("\n".join(lines[:5])) + len("\nof its own\n")]


def test_few_repeated_lines_are_too_short(spark):
    """Of lines that occur again, those below both bounds are under a twentieth."""
    texts = spark.read.parquet(str(SF / "documents.parquet")).select("text").collect()
    seen = Counter(normalise(line) for r in texts for line in (r.text or "").split("\n"))
    again = {k: n - 1 for k, n in seen.items() if k}
    short = sum(n for k, n in again.items() if not _long_enough(k, LINE))
    assert short < 0.05 * sum(again.values())


def test_repeated_rows_get_the_same_lines(spark):
    found = dedup_units(documents(spark, LINES)).collect()
    twice = [r for r in found if r.doc_id == 2]
    assert len(found) == 5 and len(twice) == 2 and twice[0] == twice[1]
    assert dedup_units(documents(spark, [])).collect() == []


RULES = [
    ("com", "/", "allow"),
    ("Example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/fr", "block"),
    ("b.net", "", "allow"),
    ("same.org", "/x", "allow"),
    ("same.org", "/x", "block"),
    (None, "/", "block"),
    ("null.path", None, "block"),
]
URLS = [
    "http://example.com/en/1", "https://www.EXAMPLE.com/en/", "http://a.www.example.com/en/x?y#z",
    "http://notexample.com/en/", "http://example.com", "http://example.com?/en/", "net://x.net/french",
    "http://b.net", "http://a.b.net/fr", "no scheme", None, "", "x://", "http://com/", "same.org://same.org/xy",
    "http://u:p@example.com:80/en/", "a://b://c.com/", "http://" + "a." * 300 + "com/", "http://ä.com/é",
    "http://example.com/en/\nx",
]


def test_urls(spark):
    rules = [(h.lower(), p, v) for h, p, v in RULES if h is not None and p is not None]
    expected = []
    for n, url in enumerate([*URLS, URLS[0]]):
        found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (found[1], found[2]) if found else ("", "")
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fits = [
            (len(h + p), v == "block", len(h), h + p, v)
            for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        best = max(fits, default=(0, 0, 0, None, "allow"))
        expected.append((n, host, path, *best[3:]))
    pages = spark.createDataFrame(
        [(n, u, "x", "y") for n, u in enumerate([*URLS, URLS[0]])], "page_id long, url string, host string, rule string"
    )
    given = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert sorted(map(tuple, judge_urls(pages, given).collect())) == sorted(expected, key=lambda r: r[0])
    none = judge_urls(pages, given.limit(0)).collect()
    assert len(none) == len(pages.collect()) and {r.verdict for r in none} == {"allow"}
    assert judge_urls(pages.limit(0), given).collect() == []


def test_urls_need_no_python(spark):
    given = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    text = judge_urls(pages, given)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", text)


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    again = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(again),
    )


def test_counts():
    texts = [t for _, t in trouble()] + ["a b c d e f a b c d e\nx\nx\n\n \nx", "é " * 30, "a b c d e a b c d e a b"]
    for text in texts:
        assert count_text(text)[:5] == brute_counts(text)


def test_base_rules_and_rows(spark):
    found = judge_documents(documents(spark, trouble())).collect()
    assert len(found) == len(trouble())
    expected = sorted(
        (str(i), *(c := brute_counts(t)), c[0] < 10 or 100 * c[4] > 20 * c[0]) for i, t in trouble()
    )
    got = sorted(
        (str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        for r in found
    )
    assert got == expected
    assert all(not (r.kept and r.base_failed) for r in found)
    assert judge_documents(documents(spark, [])).collect() == []


def test_outliers_go_and_clean_documents_stay(spark):
    clean = [(i, prose(i, 40 + i % 90)) for i in range(300)]
    junk = [(1000 + i, prose(i, 60).replace(" ", " ### $$$ ")) for i in range(9)]
    found = {r.doc_id: r for r in judge_documents(documents(spark, clean + junk)).collect()}
    assert all(found[i].kept for i, _ in clean)
    assert not any(found[i].kept for i, _ in junk)


NAMES = list(quality_rules._FEATURES)
FLOOR = np.diag([s * s for s in quality_rules._FEATURES.values()])


def estimates_in_memory(x, share=0.75):
    """(logdet, center, inverse) at the end of each start's concentration steps."""
    center = np.quantile(x, 0.5, axis=0, method="inverted_cdf")
    spread = np.quantile(np.abs(x - center), 0.5, axis=0, method="inverted_cdf")
    scale = 1.4826 * spread + np.array(list(quality_rules._FEATURES.values()))
    z = (x - center) / scale
    signs = z / np.sqrt((z * z).sum(1) + 1e-12)[:, None]
    starts = [np.diag(scale**2)]
    for u in (signs, np.tanh(z)):
        product = u.T @ u
        size = np.sqrt(np.maximum(np.diag(product), 1e-12))
        correlation = product / np.outer(size, size)
        np.fill_diagonal(correlation, 1)
        starts.append(np.outer(scale, scale) * correlation + FLOOR)
    out = []
    for covariance in starts:
        middle, last = center, None
        for _ in range(12):
            inverse = np.linalg.inv(covariance)
            d2 = np.einsum("ij,jk,ik->i", x - middle, inverse, x - middle)
            near = x[d2 <= np.quantile(d2, share, method="inverted_cdf")]
            middle = near.mean(axis=0)
            covariance = near.T @ near / len(near) - np.outer(middle, middle) + FLOOR
            logdet = np.linalg.slogdet(covariance)[1]
            if last is not None and logdet >= last - 1e-3:
                break
            last = logdet
        out.append((logdet, middle, np.linalg.inv(covariance)))
    return out


def test_the_estimate_against_concentration_steps_in_memory(spark):
    rows = [(i, prose(i, 40 + i % 90)) for i in range(200)]
    rows += [(500 + i, prose(i, 60).replace(" ", " ### ")) for i in range(20)]
    counted = quality_rules.count_documents(documents(spark, rows))
    features = counted.select("doc_id", *quality_rules._features()).toPandas()
    x = features[NAMES].to_numpy()
    _, center, inverse = min(estimates_in_memory(x), key=lambda e: e[0])
    d2 = np.einsum("ij,jk,ik->i", x - center, inverse, x - center) / quality_rules._consistency(0.75)
    found = {r.doc_id: r.distance2 for r in judge_documents(documents(spark, rows)).collect()}
    for i, expected in zip(features.doc_id, d2, strict=True):
        assert found[i] is None or np.isclose(found[i], expected, rtol=0.02)


def two_crowds(seed):
    """Crowds that are stretched in different directions: each is a place to end in."""
    rng = np.random.default_rng(seed)
    shape = 0.97 * np.ones((6, 6)) + 0.03 * np.eye(6)
    turned = shape * np.outer(*2 * [np.array([1, -1, 1, -1, 1, -1])])
    first = rng.multivariate_normal(np.zeros(6), 9 * shape, 330)
    return np.concatenate([first, rng.multivariate_normal(np.full(6, 3), 4 * turned, 270)])


def test_the_least_determinant_of_several_starts_is_kept(spark):
    """One start ends in a worse determinant than another, which is taken."""
    x = two_crowds(5)
    ends = [e[0] for e in estimates_in_memory(x, 0.5)]
    assert max(ends) > min(ends) + 0.5
    rows = spark.createDataFrame(
        [("en", "s", i, *map(float, v)) for i, v in enumerate(x)],
        "lang string, source string, row long, " + ", ".join(f"{n} double" for n in NAMES),
    )
    salted = rows.selectExpr("*", "'c' AS cell", "cast(row % 32 AS int) AS salt")
    found = quality_rules.robust_estimates(salted, 0.5, 50, 12).orderBy("start").collect()
    assert [r.logdet for r in found] == pytest.approx(ends, abs=0.05)
    best = estimates_in_memory(x, 0.5)[int(np.argmin(ends))]
    judged = quality_rules.robust_distances(rows, 0.5, 50, 12).orderBy("row").collect()
    d2 = np.einsum("ij,jk,ik->i", x - best[1], best[2], x - best[1])
    assert [r.distance2 for r in judged] == pytest.approx(
        (d2 / quality_rules._consistency(0.5)).tolist(), rel=0.05
    )


def leaks_by_hand(rows, items, percent=80):
    out = {}
    for (i, t), (k, item) in itertools.product(rows, items):
        words, plain = plain_words(t).split(b" "), plain_words(item)
        n = plain.count(b" ") + 1
        if not plain or n > len(words) or words == [b""]:
            continue
        scores = [similarity(b" ".join(words[s : s + n]), plain) for s in range(len(words) - n + 1)]
        best = max(scores)
        if best >= percent / 100:
            out[i, k] = (scores.index(best), n, round(best, 9))
    return out


def test_leaks(spark):
    items = [(k, prose(700 + k, 20 + 5 * k, 3000)) for k in range(8)] + [(20, None), (21, "  "), (22, "four rare words here")]
    items += [(3, items[3][1])]
    rows = [r for r in trouble() if r[0] not in (2, 9) and r[0] is not None]
    for k in range(8):
        text = items[k][1]
        rows.append((100 + k, prose(k, 80) + ". " + text.upper() + "! " + prose(50 + k, 30)))
        rows.append((200 + k, prose(k, 30) + " " + edit(text, k, 1) + " " + prose(50 + k, 70)))
        rows.append((300 + k, text[: len(text) // 2] + " " + prose(k, 60)))
    rows.append((400, "and Four rare, words here again"))
    table = spark.createDataFrame(items, "item_id long, text string")
    found = find_leaks(documents(spark, rows), table).collect()
    got = {(r.doc_id, r.item_id): (r.first_word, r.n_words, round(r.similarity, 9)) for r in found}
    expected = leaks_by_hand(rows, items)
    assert len(found) == len(got) and got == expected
    assert {(100 + k, k) for k in range(8)} | {(400, 22)} <= set(got)


def test_documents_shorter_than_an_item(spark):
    items = [(k, prose(800 + k, size, 3000)) for k, size in enumerate((16, 24, 59, 9, 5, 4))]
    rows = [(0, None), (1, "four words only here")]
    for k, text in items:
        words = text.split(" ")
        for less in range(1, 14):
            rows.append((1000 * k + 100 + less, " ".join(words[less:])))
            rows.append((1000 * k + 200 + less, " ".join(words[: len(words) - less])))
    expected = {}
    for (i, t), (k, item) in itertools.product(rows, items):
        whole, plain = plain_words(t), plain_words(item)
        score = similarity(whole, plain)
        if whole and len(whole.split()) < len(plain.split()) and score >= 0.8:
            expected[i, k] = (0, len(whole.split()), round(score, 9))
    table = spark.createDataFrame(items, "item_id long, text string")
    found = find_leaks(documents(spark, rows), table).collect()
    got = {(r.doc_id, r.item_id): (r.first_word, r.n_words, round(r.similarity, 9)) for r in found}
    assert len(found) == len(got) and got == expected
    assert {(101, 0), (201, 0), (2111, 2), (2211, 2), (3101, 3)} <= set(got)


def test_no_items_no_documents(spark):
    items = spark.createDataFrame([(1, "x y z")], "item_id long, text string")
    assert find_leaks(documents(spark, []), items).collect() == []
    assert find_leaks(documents(spark, trouble()), items.limit(0)).collect() == []


def test_blocks_guarantee_the_radius():
    for radius in (3, 16):
        blocks = decontaminate._blocks(radius)
        assert len(blocks) == radius + 1 and sum(bits for _, bits in blocks) == 64
