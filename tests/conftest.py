import json
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cartwheel.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", shuffle_partitions=8, app_name="cartwheel-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def scratch():
    return tempfile.mkdtemp(prefix="cartwheel-test-")


def write_json_array(path: str, docs: list) -> str:
    """One JSON array on one line, as the shop's generator writes its files."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        json.dump(docs, f)
    return path
