import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ["PYTHONPATH"] = f"{Path(__file__).resolve().parents[1]}:{os.environ.get('PYTHONPATH', '')}"

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g")
         .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ckpt-")).getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


def rows_of(df):
    """A pandas frame as a sorted list of plain tuples, columns by name."""
    import math

    import pandas as pd

    cols = sorted(df.columns)
    plain = lambda v: None if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)) else v if isinstance(v, (int, float)) else str(v)
    return cols, sorted((tuple(map(plain, r)) for r in df[cols].astype(object).itertuples(index=False, name=None)), key=repr)
