import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from strata.session import build_session  # noqa: E402

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark():
    yield build_session("local[*]", app="strata-llm-tests", shuffle_partitions=8,
                        conf={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="strata-wh-")})


@pytest.fixture(scope="session")
def documents(spark):
    """A frame of documents from texts; ids count from 0, and extra columns bear clashing names."""

    def make(texts, ids=None):
        rows = [(i if ids is None else ids[i], t, "en", f"src{i % 3}", len(t or ""))
                for i, t in enumerate(texts)]
        frame = spark.createDataFrame(rows, DOCUMENTS) if rows else spark.createDataFrame([], DOCUMENTS)
        from pyspark.sql import functions as F
        clashing = ["key", "class", "kept", "host", "path", "value", "start", "n_words", "leak", "block", "spans", "terms"]
        return frame.select("*", *[F.lit(i).alias(c) for i, c in enumerate(clashing)])

    return make
