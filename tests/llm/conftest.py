import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def tables():
    names = "documents embeddings pages benchmark labels conversations".split()
    return {name: f"{TESTDATA}/sf0.01/{name}.parquet" for name in names}
