import datetime
import decimal
import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, os.environ.get("PYTHONPATH", "")) if x)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", f"file://{shared}").config("spark.driver.memory", "4g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def canonical(rows, columns):
    """Rows as sorted tuples in column-name order; floats rounded."""
    order = sorted(range(len(columns)), key=lambda k: columns[k])

    def plain(v):
        if isinstance(v, decimal.Decimal | float):
            return round(float(v), 6)
        if isinstance(v, datetime.datetime):
            return v.replace(tzinfo=None)
        return v

    return sorted(tuple(repr(plain(r[k])) for k in order) for r in rows)
