import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from parley.session import local_session

    s = local_session(4, shuffle_partitions=8, app="parley-tests")
    # tests have no cluster-wide checkpoint folder: make one for this run
    if s.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def corpus_fixture(spark):
    """Raw corpus with the edge cases the reference data needs (FIXTURES §1)."""
    rows = [
        (1, "GENERAL", "How do I cancel my order?", "ORDER", "cancel_order", "You can cancel order {{Order Number}}."),
        (2, "B", "How do I cancel my order?", "ORDER", "cancel_order", "You can cancel order {{Order Number}}."),
        (3, "C", "How do I cancel my order?", "ORDER", "track_order", "A different answer, with a comma."),
        (4, "D", None, "ORDER", "cancel_order", "orphan response"),
        (5, "E", "missing response", "ACCOUNT", "account", None),
        (6, "F", 'He said "hi",\nthen left', "CONTACT", "contact_customer_service", 'Line one\nLine "two", done'),
        (7, "G", "N/A", "REFUND", None, "N/A"),
        (8, "H", "Where is my package?", "DELIVERY", "delivery", "It is on the way."),
        (9, "I", "Where is my package?", "DELIVERY", "track_order", "It is on the way."),
        (10, "J", "  spaced  ", "ACCOUNT", "account", "ok"),
    ]
    return spark.createDataFrame(
        rows, "id bigint, flags string, instruction string, category string, intent string, response string")
