import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return oracle.session()


@pytest.fixture
def value(spark):
    """Evaluate expressions of one literal row: value(column) or value(column, {name: (value, type)})."""
    from pyspark.sql import functions as F

    def evaluate(column, **inputs):
        row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in inputs.items()]) if inputs else spark.range(1)
        return row.select(column.alias("v")).first()["v"]

    return evaluate


@pytest.fixture
def page(spark):
    """One page or several as a DataFrame."""
    def make(*htmls, url="https://www.x.com/p/q", **extra):
        rows = [(i, url, h, *extra.values()) for i, h in enumerate(htmls)]
        names = ["page_id bigint", "url string", "html string"] + [
            f"{k} {'map<string,string>' if isinstance(v, dict) else 'array<string>' if isinstance(v, list) else 'string'}"
            for k, v in extra.items()
        ]
        return spark.createDataFrame(rows, ", ".join(names))

    return make
