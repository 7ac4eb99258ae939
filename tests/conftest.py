import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from oddsflow.session import build_session, checkpoint_dir

    s = build_session(master="local[4]", shuffle_partitions=4, app="oddsflow-tests",
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="oddsflow-wh-")})
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def feed_dir():
    from tests.feed_fixture import write_feed

    return write_feed(tempfile.mkdtemp(prefix="oddsflow-feed-"))


@pytest.fixture(scope="session")
def raw(spark, feed_dir):
    from oddsflow.sources.feed import ingest, read_feed

    return ingest(read_feed(spark, feed_dir)).cache()
