import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from loglens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", f"local[{os.environ.get('TEST_CPUS', '*')}]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"})
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def evaluate(spark):
    """Evaluate a column function on each of some values."""
    def run(function, values, kind="string"):
        rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
        return [r["out"] for r in rows.withColumn("out", function("v")).orderBy("i").collect()]
    return run


@pytest.fixture
def put():
    def write(root, path, content, mtime=None):
        target = Path(root) / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(content.encode() if isinstance(content, str) else content)
        if mtime is not None:
            os.utime(target, (mtime, mtime))
        return target
    return write
