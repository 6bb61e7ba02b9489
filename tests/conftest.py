import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from hourmeter.session import get_session

    s = get_session("local[2]", shuffle_partitions=2, app="hourmeter-tests")
    yield s
    s.stop()


@pytest.fixture()
def write_files(tmp_path):
    """Write {name: text} into a fresh folder and return its path."""

    def _write(files: dict, sub="incoming"):
        d = tmp_path / sub
        d.mkdir(exist_ok=True)
        for name, text in files.items():
            with open(d / name, "w", encoding="utf-8", newline="") as fh:
                fh.write(text)
        return str(d)

    return _write
