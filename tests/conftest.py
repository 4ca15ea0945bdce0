import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from kuatia.session import drop_stages, local_session

    session = local_session(4, 4, "4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_stages()
    session.stop()
