"""A library that only the optional package needs may be missing."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys

class Missing:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {name!r}:
            raise ImportError(name)

sys.meta_path.insert(0, Missing())
sys.path.insert(0, {root!r})
import __spark_entry__ as E
from riskloom.plans import catalog
keys, sql = E.queries(), E.oracle_sql()
assert set(catalog.QUERIES) <= set(keys) and set(sql) <= set(keys)
assert "feature_matrix" in sql and not [k for k in keys if k.startswith("op")]
"""


@pytest.mark.parametrize("name", ["zstandard", "tokenizers"])
def test_queries_without_an_optional_library(name):
    done = subprocess.run([sys.executable, "-c", CODE.format(name=name, root=ROOT)], capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
