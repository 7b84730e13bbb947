import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from gridpanel.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="gp-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="gp-test-")


def ts(h, base=dt.datetime(2024, 1, 1)):
    """Hour offset -> naive datetime."""
    return base + dt.timedelta(hours=h)


PANEL_SCHEMA = "prediction_unit_id int, is_consumption boolean, prediction_datetime timestamp_ntz, target double"
