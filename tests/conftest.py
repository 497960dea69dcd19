import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from docketframe.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        8,
        "tests",
        **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def apply(spark):
    """Values of a text column expression on a list of texts."""
    from pyspark.sql import functions as F

    def run(expression, texts, kind="string"):
        rows = [(i, t) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, f"i int, t {kind}")
        out = df.select("i", expression(F.col("t")).alias("v")).collect()
        return [r["v"] for r in sorted(out)]

    return run
