import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from ringfold.plans.session import local_session

    session = local_session(4, 4, "4g", "tests")
    session.conf.set("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}") if session.conf.isModifiable("spark.checkpoint.dir") else None
    yield session
    session.stop()
