import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from sheaf.session import local_session

    s = local_session("*", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def docs_dir(tmp_path):
    """Write literal documents as files: docs_dir({"a.json": "...", ...})."""

    def write(files: dict[str, str], sub: str = "in") -> str:
        d = tmp_path / sub
        d.mkdir(exist_ok=True)
        for name, text in files.items():
            (d / name).write_text(text, encoding="utf-8")
        return str(d)

    return write
