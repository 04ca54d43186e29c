import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewatch.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    extra = {}
    if not os.environ.get("SPARK_CONF_DIR") and not _configured_checkpoint_dir():
        # tests set their own checkpoint folder only where none is configured
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="tw-test-ckpt-")
    s = build_session("local[4]", app="tidewatch-tests", shuffle_partitions=8, extra=extra)
    yield s
    s.stop()


def _configured_checkpoint_dir() -> bool:
    """True when spark-defaults already names a checkpoint folder."""
    home = os.environ.get("SPARK_HOME")
    if not home:
        import pyspark
        home = os.path.dirname(pyspark.__file__)
    conf = os.path.join(home, "conf", "spark-defaults.conf")
    if os.path.exists(conf):
        with open(conf) as f:
            return any(l.split()[:1] == ["spark.checkpoint.dir"] for l in f)
    return False


SF_SMALL = "/root/testdata/sf0.001"
