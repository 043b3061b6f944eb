import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

from lexiquarry.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", spark__sql__shuffle__partitions="4",
                            spark__ui__enabled="false", spark__driver__memory="8g")
    session.sparkContext.setLogLevel("OFF")
    session.sparkContext.environment["PYTHONPATH"] = ROOT  # workers find the package wherever pytest was started
    session.conf.set("lexiquarry.corpus.partitions", "4")
    yield session
    session.stop()


@pytest.fixture
def sentence_table(spark):
    """Table in sentence form from {doc_id: [sentence, ...]}, field pr_abstract."""
    def make(documents, field="pr_abstract"):
        rows = [(i, field, sentences) for i, sentences in documents.items()]
        return spark.createDataFrame(rows, "doc_id long, field string, sentences array<string>")
    return make
