"""The entry module without its optional parts."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys
sys.modules[{name!r}] = None  # importing it fails
import __spark_entry__ as e
names = set(e.queries())
assert len(names) > 100 and "ingest_rules" in names and set(e.oracle_sql()) <= names
print(any(n.startswith("op") and n[2].isdigit() for n in names), "pipeline" in names)
"""


@pytest.mark.parametrize("name", ["telemetra.llm", "telemetra.llm.queries", "xxhash", "public_tokenizers"])
def test_library_queries_stay_when_a_module_is_missing(name):
    out = subprocess.run([sys.executable, "-c", CODE.format(name=name)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert out.stdout.split() == ["False", "False"]


def test_pipeline_alone_may_be_missing():
    out = subprocess.run([sys.executable, "-c", CODE.format(name="corpus_pipeline")], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert out.stdout.split()[1] == "False"
