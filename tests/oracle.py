"""Side-by-side check of a registered query with its SQL."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _date_text(value):
    """Dates come as date, timestamp or NaT, depending on the engine."""
    if value is None or value is pd.NaT:
        return None
    return str(value)[:10] if hasattr(value, "year") else value


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for column in frame.columns:
        if frame[column].dtype.kind in "OM":
            frame[column] = frame[column].map(_date_text)
    return frame.sort_values(list(frame.columns), na_position="first").reset_index(drop=True)


def assert_same(actual: pd.DataFrame, expected: pd.DataFrame) -> None:
    assert sorted(actual.columns) == sorted(expected.columns)
    pd.testing.assert_frame_equal(
        canonical(actual), canonical(expected), check_dtype=False, check_exact=True
    )
