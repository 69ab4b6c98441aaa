import os
import sys
import uuid

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from larder.session import local_session  # noqa: E402
from larder.sources.tables import ensure_schema  # noqa: E402

SF_DIR = os.environ.get("LARDER_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = local_session(
        8,
        spark__sql__warehouse__dir=str(root / "warehouse"),
        spark__checkpoint__dir=str(root / "shared"),
    )
    yield session
    session.stop()


@pytest.fixture
def schema(spark, tmp_path):
    """A fresh schema in a folder of its own."""
    name = f"t_{uuid.uuid4().hex[:8]}"
    ensure_schema(spark, name, str(tmp_path / name))
    return name


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
