import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark():
    from subloom.session import local_session

    s = local_session(4, 4, "4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def rows():
    def collect(df, *columns):
        return sorted((tuple(r[c] for c in columns or df.columns) for r in df.collect()), key=repr)

    return collect
