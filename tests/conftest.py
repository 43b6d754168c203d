import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from corpusloom.session import local_session

    return local_session(cores=4, shuffle_partitions=4)


@pytest.fixture(scope="session")
def sf_dir():
    d = "/root/testdata/sf0.001"
    if not Path(d).exists():
        pytest.skip("no test data here")
    return d
