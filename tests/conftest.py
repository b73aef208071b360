import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from checks.run import local_session, oracle  # noqa: E402
from cohortloom.session import shared_dir  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session()
    if shared_dir(session) is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    return oracle(SF_DIR)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
