import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from askframe.session import local_session

    session = local_session(cores=8, memory="4g", name="tests", shared=str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def nothing_fits(monkeypatch):
    """Every measured table is over every bound."""
    from askframe.operators import presence, search

    def never(table, *_):
        return False

    for module in (presence, search):
        monkeypatch.setattr(module, "fits_broadcast", never)
    monkeypatch.setattr(presence, "FEW_KEYS", 0)
    return never
