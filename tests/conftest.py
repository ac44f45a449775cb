import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import pytest

from tagseek.session import fresh_path, local_session
from tagseek.sources.store import save_index


@pytest.fixture(scope="session")
def spark():
    return local_session("8", name="tagseek-tests")


TEXTS = [
    (1, "a", "Hyper space jump, then hyper space again"),
    (2, "a", "the hyperspace lane; hyper-space travel"),
    (3, "b", "space hyper"),
    (4, "b", "hyper fast space ship"),
    (5, "", "Knight of the night"),
    (6, None, "nite watch naïve 123"),
    (7, "c", None),
    (8, "c", "to be or not to be to be"),
    (9, "c", "hyperdrive hypersonic"),
]


@pytest.fixture(scope="session")
def index(spark):
    documents = spark.createDataFrame(TEXTS, "doc_id bigint, bookmark_tag string, text string")
    return save_index(documents, fresh_path(spark, "fixture"), doc_buckets=4, term_buckets=3)


@pytest.fixture(scope="session")
def ask(spark):
    return lambda *phrases: spark.createDataFrame(list(enumerate(phrases)), "query_id bigint, phrase string")
