import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from threatspark.session import get_session
    ckpt = tempfile.mkdtemp(prefix="ts-test-ckpt-")
    s = get_session("local[4]", app="threatspark-tests", shuffle_partitions=4,
                    extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    yield s
    s.stop()
