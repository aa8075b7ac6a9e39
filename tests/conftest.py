import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

from ondol.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session("tests", "local[4]", spark__sql__shuffle__partitions=4, spark__ui__enabled="false", spark__driver__memory="3g", spark__checkpoint__dir=f"file://{tmp_path_factory.mktemp('shared')}", spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")))
    s.sparkContext.setLogLevel("ERROR")
    yield s


def rows(df, *columns):
    """The rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=str)
