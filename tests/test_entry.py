"""The driver contract stands without the training-data operators."""

import os
import subprocess
import sys

import pytest

from tests.conftest import ROOT

NAMES = "import __spark_entry__ as e; print(sorted(e.queries())); print(sorted(e.oracle_sql()))"


def names(before: str) -> list[list[str]]:
    out = subprocess.run([sys.executable, "-c", f"import sys\n{before}\n{NAMES}"], cwd=ROOT, capture_output=True, text=True,
                         env=os.environ | {"PYTHONPATH": ROOT}, timeout=120, check=True)
    return [eval(line) for line in out.stdout.splitlines()[-2:]]


@pytest.mark.parametrize("module", ["xxhash", "tokenizers", "public_tokenizers", "pyarrow.fs", "jobmatch.llm", "corpus_pipeline"])
def test_what_cannot_be_imported_leaves_the_library_s_queries(module):
    from jobmatch.plans import queries as q
    found, sql = names(f"sys.modules[{module!r}] = None")
    assert set(q.QUERIES) <= set(found) and set(sql) <= set(found)
    if module != "tokenizers":             # imported in the workers only
        assert found == sorted(q.QUERIES)
