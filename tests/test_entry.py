"""The driver's entry with and without the parts that may be left out."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def listed(*blocked):
    """Names of queries and of SQL when imports of some modules fail."""
    code = "import sys\n" + "".join(f"sys.modules[{m!r}] = None\n" for m in blocked) + (
        "import __spark_entry__ as e\nprint('|'.join(e.queries()), '|'.join(e.oracle_sql()), sep='#')")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout
    queries, sql = out.strip().splitlines()[-1].split("#")
    return set(queries.split("|")), set(sql.split("|"))


@pytest.mark.parametrize("blocked", [("issueloom.llm",), ("issueloom.llm.catalog",), ("corpus_pipeline", "issueloom.llm")])
def test_entry_without_the_subpackage(blocked):
    queries, sql = listed(*blocked)
    assert "ranked_groups" in queries and sql <= queries and len(queries) > 130
    assert not [q for q in queries if q.startswith("op") and q[2:3].isdigit()] and "pipeline" not in queries


def test_every_sql_has_its_query():
    queries, sql = listed()
    assert sql <= queries
