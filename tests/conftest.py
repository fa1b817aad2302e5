from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import DataFrame  # noqa: E402

from ledgerleaf import schemas  # noqa: E402
from ledgerleaf.operators import extract  # noqa: E402
from ledgerleaf.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests", "local[4]",
        spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__driver__memory="4g", spark__driver__host="127.0.0.1",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """rows("a int, b string", (1, "x"), ...) -> DataFrame"""

    def make(ddl: str, *data) -> DataFrame:
        return spark.createDataFrame(list(data), ddl)

    return make


ITEM_TYPE = (
    "source_id bigint, run_id bigint, page_number int, entry_pos int, url string, raw_content "
    + schemas.RAW_CONTENT.simpleString()
)


@pytest.fixture
def items(spark):
    """items((source_id, run_id, page, pos, url, content), ...) -> item frame"""

    def make(*data) -> DataFrame:
        return extract.items_from_struct(spark.createDataFrame(list(data), ITEM_TYPE))

    return make


@pytest.fixture
def json_items(spark):
    """json_items("{...}", ...) -> item frame, one entry per document in order"""

    def make(*docs) -> DataFrame:
        data = [(1, 1, 1, i, f"u{i}", d) for i, d in enumerate(docs)]
        ddl = "source_id bigint, run_id bigint, page_number int, entry_pos int, url string, raw_json string"
        return extract.items_from_json(spark.createDataFrame(data, ddl))

    return make


@pytest.fixture
def no_history(spark):
    return spark.createDataFrame([], "hash string")
