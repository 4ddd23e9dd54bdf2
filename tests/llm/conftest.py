from pathlib import Path

import pytest


@pytest.fixture(scope="session")
def data():
    folder = "/root/testdata/sf0.001"
    if not Path(folder).exists():
        pytest.skip("no test data")
    return folder
