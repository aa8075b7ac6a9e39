import re
from pathlib import Path

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_core_does_not_import_llm():
    root = Path(__file__).parent.parent / "ondol"
    for f in root.rglob("*.py"):
        if "llm" not in f.relative_to(root).parts:
            assert not re.search(r"from\s+(?:ondol)?\.*llm|import\s+ondol\.llm", f.read_text()), f


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")
def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
