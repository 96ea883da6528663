from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from sparesledger.session import ensure_checkpoint_dir, local_session

    s = local_session(cores="*", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="sparesledger-test-wh-")})
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="sparesledger-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="sparesledger-test-")
