import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from lodestar.session import local_session

    session = local_session(4, memory="3g", **{"spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false"})
    yield session
    session.stop()
