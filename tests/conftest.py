import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from simdex.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", 4, app_name="simdex-tests")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="simdex-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="simdex-test-")


def docs_df(spark, texts):
    """(doc_id, content) from {doc_id: text}."""
    from pyspark.sql import functions as F
    rows = [(int(k), v) for k, v in texts.items()]
    return spark.createDataFrame(rows, "doc_id bigint, text string") \
        .select("doc_id", F.encode("text", "UTF-8").alias("content"))
