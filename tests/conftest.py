import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from docketry.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def values(spark):
    """Evaluate one expression over a list of texts, results in order."""
    from pyspark.sql import functions as F

    def run(expr, texts):
        rows = [(i, t) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, "i int, c string")
        out = df.select("i", expr(F.col("c")).alias("v")).orderBy("i").collect()
        return [r["v"] for r in out]

    return run


@pytest.fixture(scope="session")
def make_pages(spark):
    """Raw pages from (html, context) pairs or plain html texts."""
    from docketry.schemas import RAW_PAGES

    def build(items, url="https://site.example/cp/lista"):
        rows = []
        for i, item in enumerate(items):
            html, ctx = item if isinstance(item, tuple) else (item, {})
            context = tuple(ctx.get(k) for k in ("tipo", "busca", "numero", "cnpj", "page_idx", "endpoint", "req_id"))
            rows.append(
                (ctx.get("page_id", i), ctx.get("url", url), "GET", 200, {}, html, None, context, "2024-01-01T00:00:00", None)
            )
        return spark.createDataFrame(rows, RAW_PAGES)

    return build
