import os
import sys
from datetime import datetime, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventlens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="eventlens-tests", shuffle_partitions=4)
    yield s
    s.stop()


def ts(epoch_s: float) -> datetime:
    """Epoch seconds -> naive UTC datetime (what Spark returns in a UTC session)."""
    return datetime.fromtimestamp(epoch_s, tz=timezone.utc).replace(tzinfo=None)


def lines_df(spark, lines):
    """Text lines with their line number as ``seq`` (as the text source gives)."""
    return spark.createDataFrame([(l, i) for i, l in enumerate(lines)], "value string, seq long")
