"""The entry module without the libraries that only the optional operators need."""

import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def imported(*before):
    code = "; ".join(["import sys", *before, "import __spark_entry__ as e", "print(sorted(e.queries()), sorted(e.oracle_sql()))"])
    return subprocess.run([sys.executable, "-c", code], cwd=REPO, capture_output=True, text=True, timeout=120)


@pytest.mark.parametrize("module", ["public_tokenizers", "zstandard", "numpy.linalg", "tiktoken"])
def test_a_missing_library_leaves_the_retail_engine(module):
    got = imported(f"sys.modules['{module}'] = None")
    assert got.returncode == 0, got.stderr[-500:]
    assert "'dau_first_of_day'" in got.stdout and "'sale_recovered'" in got.stdout and "'dau_state_stream'" in got.stdout


def test_a_fault_inside_the_library_is_an_error():
    got = imported("sys.modules['retail_pulse.sources.readers'] = None")
    assert got.returncode != 0 and "retail_pulse.sources.readers" in got.stderr
