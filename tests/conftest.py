import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TESTDATA = Path(os.environ.get("TESTDATA", "/root/testdata"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from marketbars.session import builder

    home = tmp_path_factory.mktemp("spark")
    session = (
        builder("marketbars-tests")
        .master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.warehouse.dir", str(home / "warehouse"))
        .config("spark.checkpoint.dir", str(home / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
