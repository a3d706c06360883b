import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from leafmill.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
        "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def texts(spark):
    """``texts(["a", ...], expression)``: the values of a column expression over ``text``, in order."""
    from pyspark.sql import functions as F

    def evaluate(values, expression):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, text string")
        return [row[0] for row in df.orderBy("i").select(expression(F.col("text"))).collect()]

    return evaluate
