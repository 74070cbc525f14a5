from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
# Python workers import the package as well.
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH", "")]))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


def canonical_rows(pdf) -> list[str]:
    """Rows of a pandas frame as sorted text, with columns by name and numbers rounded."""
    import numpy as np
    import pandas as pd

    def text(v) -> str:
        if isinstance(v, (np.ndarray, list, tuple)):
            return "[" + ",".join(map(text, v)) + "]"
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, (float, np.floating)) and np.isnan(v)):
            return "-"
        if isinstance(v, (bool, np.bool_)):
            return str(bool(v))
        if isinstance(v, (int, float, np.integer, np.floating)) or type(v).__name__ == "Decimal":
            return repr(round(float(v), 6))
        return pd.Timestamp(v).isoformat() if hasattr(v, "isoformat") else str(v)

    return sorted("|".join(map(text, row)) for row in pdf[sorted(pdf.columns)].itertuples(index=False))


@pytest.fixture(scope="session")
def duck(data):
    import duckdb

    con = duckdb.connect()
    for path in Path(data).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con
