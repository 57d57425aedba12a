"""Quality rules: counts of each text, and robust outliers among the rest."""

from __future__ import annotations

import math
import statistics
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketbars.llm.shared import batches, saved

SYMBOLS = b"#*$%&|<>"
_WINDOW = 5

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper")
_COUNTED = "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in _COUNTS)

# Least spread of each statistic that counts as one: below it values are alike.
_FEATURES = {
    "log_words": 0.3,
    "word_length": 0.15,
    "symbols": 0.02,
    "dup_lines": 0.1,
    "repeats": 0.05,
    "upper": 0.05,
}
_P = len(_FEATURES)
_SALTS = 32


def _byte_table(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


_SPACE = _byte_table(b" \t\n\x0b\x0c\r")
_SYMBOL = _byte_table(SYMBOLS)
_UPPER = _byte_table(bytes(range(65, 91)))
# Bytes that begin a code point.
_BEGIN = (np.arange(256) & 0xC0) != 0x80


def _repeated_words(words: list[bytes]) -> int:
    """Words in windows of five that occur twice or more."""
    n = len(words) - _WINDOW + 1
    if n < 2:
        return 0
    code = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = np.zeros(n, np.uint64)
    for k in range(_WINDOW):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + code[k : k + n]
    order = np.sort(mixed)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    (at,) = np.nonzero(np.isin(mixed, twice))
    # Hashes only choose the windows; the words themselves decide.
    windows = [tuple(words[i : i + _WINDOW]) for i in at.tolist()]
    seen = Counter(windows)
    covered = np.zeros(len(words) + 1, np.int64)
    for i, window in zip(at.tolist(), windows, strict=True):
        if seen[window] > 1:
            covered[i] += 1
            covered[min(i + _WINDOW, len(words))] -= 1
    return int((np.cumsum(covered)[:-1] > 0).sum())


def count_text(text: str | None) -> tuple[int, ...]:
    """The counts of one text, in the order of the result's columns."""
    data = (text or "").encode("utf-8", "replace")
    words = data.split()
    code = np.frombuffer(data, np.uint8)
    chars = int((_BEGIN[code] & ~_SPACE[code]).sum())
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (
        len(words),
        chars,
        int(_SYMBOL[code].sum()),
        len(lines) - len(set(lines)),
        _repeated_words(words),
        int(_UPPER[code].sum()),
    )


def count_documents(documents: DataFrame) -> DataFrame:
    """`doc_id`, `lang`, `source` and the counts of every whole text."""

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, 1024):
            found = [count_text(t) for t in batch.column(3).to_pylist()]
            columns = [pa.array(c, pa.int64()) for c in zip(*found, strict=True)]
            yield pa.record_batch(
                [*batch.columns[:3], *columns], names=["doc_id", "lang", "source", *_COUNTS]
            )

    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        "text",
    )
    return docs.mapInArrow(count, _COUNTED)


def _features() -> list[Column]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    values = [
        F.log1p("n_words"),
        F.log(chars / words),
        F.sqrt(F.col("n_symbols") / chars),
        F.col("n_dup_lines") / (F.col("n_dup_lines") + 20),
        F.col("n_repeat_words") / words,
        F.sqrt(F.col("n_upper") / chars),
    ]
    return [v.cast("double").alias(n) for v, n in zip(values, _FEATURES, strict=True)]


def chi2_quantile(p: float, z: float) -> float:
    """The chi-square value at a normal deviate (Wilson and Hilferty)."""
    return p * (1 - 2 / (9 * p) + z * math.sqrt(2 / (9 * p))) ** 3


def _chi2_cdf(p: float, x: float) -> float:
    z = ((x / p) ** (1 / 3) - (1 - 2 / (9 * p))) / math.sqrt(2 / (9 * p))
    return 0.5 * (1 + math.erf(z / math.sqrt(2)))


def _consistency(share: float) -> float:
    """By how much the covariance of the nearest `share` falls short."""
    z = statistics.NormalDist().inv_cdf(share)
    return share / _chi2_cdf(_P + 2, chi2_quantile(_P, z))


def _distance() -> Column:
    """Squared Mahalanobis distance from a cell's `center` and `inverse`."""
    away = [F.col(n) - F.col("center")[i] for i, n in enumerate(_FEATURES)]
    return sum(
        (
            away[i] * away[j] * F.col("inverse")[i * _P + j] * (1 if i == j else 2)
            for i in range(_P)
            for j in range(i, _P)
        ),
        F.lit(0.0),
    )


_PLACES = [(i, j) for i in range(_P) for j in range(_P)]
_ESTIMATE = "cell string, start int, center array<double>, inverse array<double>, logdet double"


def _floor() -> np.ndarray:
    return np.diag([s * s for s in _FEATURES.values()])


def _estimates(rows: DataFrame, estimate: Callable[..., Iterator[tuple]]) -> DataFrame:
    """Rows of sums as estimates; `estimate` gets a row's values and gives
    (cell, start, center, covariance) tuples."""

    def read(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = pa.list_(pa.float64())
        kinds = (pa.string(), pa.int32(), lists, lists, pa.float64())
        names = [c.split()[0] for c in _ESTIMATE.split(", ")]
        for batch in batches_:
            out = []
            for values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for cell, start, center, covariance in estimate(*values):
                    whole = covariance + _floor()
                    inverse = np.linalg.inv(whole).ravel().tolist()
                    out.append((cell, start, list(center), inverse, np.linalg.slogdet(whole)[1]))
            columns = list(zip(*out, strict=True)) or [()] * len(kinds)
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names
            )

    return rows.mapInArrow(read, _ESTIMATE)


def _of_sums(cell: str, start: int, n: int, sums: list, products: list) -> Iterator[tuple]:
    mean = np.array(sums) / n
    yield cell, start, mean, np.array(products).reshape(_P, _P) / n - np.outer(mean, mean)


def _starts(cell: str, center: list, scale: list, signs: list, tanhs: list) -> Iterator[tuple]:
    """Medians and deviations alone; with spatial signs' and with tanh's correlations."""
    spread = np.diag(scale)
    yield cell, 0, center, spread @ spread - _floor()
    for start, products in enumerate((signs, tanhs), 1):
        product = np.array(products).reshape(_P, _P)
        size = np.sqrt(np.maximum(np.diag(product), 1e-12))
        correlation = product / np.outer(size, size)
        np.fill_diagonal(correlation, 1)
        yield cell, start, center, spread @ correlation @ spread


def _with(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Join by cell and salt, so that no cell's rows meet in one task."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))
    return rows.join(estimates.withColumn("salt", salts), ["cell", "salt"], "left")


def _median(column: Column, share: float = 0.5) -> Column:
    return F.percentile_approx(column, share, 10_000)


def with_cells(rows: DataFrame, least: int) -> DataFrame:
    """Adds `cell`: language and source, or what they are taken together to."""
    counts = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    large = F.col("n") >= least
    small = (
        counts.where(~large)
        .groupBy(F.col("lang").alias("small_lang"))
        .agg(F.sum("n").alias("small_n"))
    )
    # A null and any text stay apart.
    lang, source = (F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-")) for c in ("lang", "source"))
    cells = counts.join(small, F.col("lang").eqNullSafe(F.col("small_lang")), "left").select(
        F.col("lang").alias("cell_lang"),
        F.col("source").alias("cell_source"),
        F.when(large, F.concat_ws(" ", lang, source))
        .when(F.col("small_n") >= least, lang)
        .otherwise(F.lit("rest"))
        .alias("cell"),
    )
    same = F.col("lang").eqNullSafe(F.col("cell_lang")) & F.col("source").eqNullSafe(
        F.col("cell_source")
    )
    return rows.join(cells, same, "left").drop("cell_lang", "cell_source")


def _by_cell(estimates: DataFrame, *columns: str) -> DataFrame:
    """The estimates of a cell, three at most, as one row."""
    found = F.sort_array(F.collect_list(F.struct("start", *columns)))
    return estimates.groupBy("cell").agg(found.alias("starts"))


def _scored(rows: DataFrame, estimates: DataFrame, *more: str) -> DataFrame:
    """Each row once for each estimate of its cell, with the distance from it."""
    both = _with(rows, _by_cell(estimates, "center", "inverse", *more))
    each = both.withColumn("s", F.explode("starts")).select(*rows.columns, "s.*")
    return each.withColumn("d2", _distance()).drop("center", "inverse")


def _first_estimates(rows: DataFrame, least: int) -> DataFrame:
    """The starts of each cell of at least so many rows."""
    names = list(_FEATURES)
    medians = rows.groupBy("cell").agg(
        F.array(*[_median(F.col(n)) for n in names]).alias("center"), F.count("*").alias("n")
    )
    medians = saved(medians.where(F.col("n") >= least).drop("n"))
    away = [F.col(n) - F.col("center")[i] for i, n in enumerate(names)]
    spreads = (
        _with(rows, medians)
        .groupBy("cell")
        .agg(*[_median(F.abs(a)).alias(n) for a, n in zip(away, names, strict=True)])
    )
    scale = F.array(*[F.col(n) * 1.4826 + F.lit(s) for n, s in _FEATURES.items()])
    medians = saved(medians.join(spreads.select("cell", scale.alias("scale")), "cell"))
    z = [a / F.col("scale")[i] for i, a in enumerate(away)]
    length = F.sqrt(sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(_P)), F.lit(1e-12)))
    standard = _with(rows, medians).withColumns({f"z{i}": x for i, x in enumerate(z)})
    standard = standard.withColumn("length", length).where(F.col("center").isNotNull())

    def sums(value: Callable[[int], Column]) -> Column:
        return F.array(*[F.sum(value(i) * value(j)) for i, j in _PLACES])

    products = standard.groupBy("cell").agg(
        sums(lambda i: F.col(f"z{i}") / F.col("length")).alias("signs"),
        sums(lambda i: F.tanh(f"z{i}")).alias("tanhs"),
    )
    joined = medians.join(products, "cell").select("cell", "center", "scale", "signs", "tanhs")
    return saved(_estimates(joined, _starts))


def robust_estimates(rows: DataFrame, share: float, least: int, most_steps: int) -> DataFrame:
    """Where each start of each cell ends: `cell`, `start`, `center`, `inverse`, `logdet`.

    A concentration step keeps the `share` of a cell's rows that are nearest and
    takes their mean and covariance. Steps go on until no determinant falls any
    more, by a thousandth; all starts of all cells are in the same aggregates.
    """
    names = list(_FEATURES)
    estimates, before = _first_estimates(rows, least), None
    for _ in range(most_steps):
        scored = _scored(rows, estimates)
        cuts = scored.groupBy("cell", "start").agg(_median(F.col("d2"), share).alias("cut"))
        with_cuts = saved(estimates.join(cuts, ["cell", "start"]))
        near = _scored(rows, with_cuts, "cut").where(F.col("d2") <= F.col("cut"))
        products = [F.sum(F.col(names[i]) * F.col(names[j])) for i, j in _PLACES]
        sums = near.groupBy("cell", "start").agg(
            F.count("*").alias("n"),
            F.array(*[F.sum(n) for n in names]).alias("sums"),
            F.array(*products).alias("products"),
        )
        estimates = saved(_estimates(sums, _of_sums))
        if before is not None:
            old = before.select("cell", "start", F.col("logdet").alias("old"))
            falling = F.col("logdet") < F.col("old") - 1e-3
            if estimates.join(old, ["cell", "start"]).where(falling).isEmpty():
                break
        before = estimates
    return estimates


def robust_distances(rows: DataFrame, share: float, least: int, most_steps: int) -> DataFrame:
    """Adds `distance2`, from the minimum-covariance-determinant estimate of the row's cell.

    `rows` has `lang`, `source`, a number `row` and the statistics. A cell is a
    language and source; sources of fewer than `least` rows are taken together
    by language, and languages still smaller as one. The search for the least
    determinant starts from medians and median deviations, with no correlation,
    with that of spatial signs and with that of hyperbolic tangents, and goes
    down by concentration steps (see `robust_estimates`); of the ends the one of
    least determinant is the estimate. A fixed least spread is added to each
    statistic, so that those that hardly vary do no harm. Cells with fewer than
    `least` rows in the end have no estimate and distance null.

    Quantiles are Spark's bounded sketches and sums are added up by task before
    they are shuffled, so a cell may hold any number of rows.
    """
    salt = F.pmod(F.xxhash64("row"), F.lit(_SALTS)).cast("int")
    rows = saved(with_cells(rows, least).withColumn("salt", salt))
    ends = robust_estimates(rows, share, least, most_steps)
    best = F.min_by(F.struct("center", "inverse"), F.struct("logdet", "start")).alias("best")
    estimates = ends.groupBy("cell").agg(best).select("cell", "best.*")
    return _with(rows, estimates).withColumn("distance2", _distance() / _consistency(share))


def judge_documents(
    documents: DataFrame,
    share: float = 0.75,
    least: int = 50,
    most_steps: int = 12,
    deviate: float = 6.0,
) -> DataFrame:
    """Counts, the base rule, and whether a document is kept.

    Words are runs of bytes other than ASCII white space. The base rule fails a
    text of fewer than 10 words or with more than a fifth of its words in
    repeated five-word windows. The rest are held against the robust estimate
    of their language and source: a document goes if its squared distance is
    beyond the chi-square value at `deviate` standard deviations.

    Result: `doc_id`, `n_words`, `word_chars`, `n_symbols`, `n_dup_lines`,
    `n_repeat_words`, `base_failed`, `distance2`, `kept`, one row for each row.
    A null or empty text has no words and fails; null languages and sources are
    values of their own; repeated rows are judged alike; an empty table gives
    no row. Documents without an estimate (fewer than `least` to estimate from)
    are kept unless the base rule fails. Other columns are not looked at.
    """
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    counted = saved(count_documents(documents).withColumn("base_failed", failed))
    rows = counted.where(~F.col("base_failed")).withColumn("row", F.monotonically_increasing_id())
    shown = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    judged = robust_distances(rows.select("*", *_features()), share, least, most_steps)
    cutoff = chi2_quantile(_P, deviate)
    near = F.coalesce(F.col("distance2") <= cutoff, F.lit(True))
    return judged.select(*shown, "distance2", near.alias("kept")).unionByName(
        counted.where("base_failed").select(
            *shown, F.lit(None).cast("double").alias("distance2"), F.lit(False).alias("kept")
        )
    )
