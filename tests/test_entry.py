"""The driver's entry with and without the optional package and its libraries."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[1]
COUNT = """
import sys
for name in {absent!r}:
    sys.modules[name] = None
import importlib.util as util
real = util.find_spec
util.find_spec = lambda name, *rest: None if name in {absent!r} else real(name, *rest)
import __spark_entry__ as entry
print(len(entry.queries()), len(entry.oracle_sql()))
"""


def count(folder, absent=()):
    """Numbers of queries and of SQL texts, in a process of its own."""
    done = subprocess.run(
        [sys.executable, "-c", COUNT.format(absent=list(absent))], cwd=folder, capture_output=True, text=True
    )
    if done.returncode:
        raise RuntimeError(done.stderr)
    return tuple(map(int, done.stdout.split()))


@pytest.fixture
def copy(tmp_path):
    shutil.copytree(REPO / "bizregistry", tmp_path / "bizregistry")
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (REPO / name).exists():
            shutil.copy(REPO / name, tmp_path)
    return tmp_path


def test_queries_without_the_optional_package(copy):
    from bizregistry.bindings.queries import QUERIES

    shutil.rmtree(copy / "bizregistry" / "llm", ignore_errors=True)
    (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    assert count(copy) == (len(QUERIES), len(QUERIES))


def test_queries_without_a_library(copy):
    from bizregistry.bindings.queries import QUERIES

    assert count(copy, ["tiktoken"]) == (len(QUERIES), len(QUERIES))


def test_errors_of_what_is_there_are_raised(copy):
    package = copy / "bizregistry" / "llm"
    if not package.is_dir():
        pytest.skip("the optional package is not here")
    (package / "packing.py").unlink()
    with pytest.raises(RuntimeError, match=r"bizregistry\.llm\.packing"):
        count(copy)
