"""The entry's optional part."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
NAMES = "import __spark_entry__ as e; print(*e.queries())"


def names(before=""):
    run = subprocess.run([sys.executable, "-c", before + NAMES], cwd=ROOT, capture_output=True, text=True, check=True)
    return run.stdout.split()


@pytest.mark.parametrize("missing", ["public_tokenizers", "corpus_pipeline", "marketlens.llm"])
def test_without(missing):
    """Whatever the text operators lack, the other queries are there."""
    found = names(f"import sys; sys.modules['{missing}'] = None\n")
    assert "friday_effect" in found and "pipeline" not in found


@pytest.mark.skipif(not os.path.isdir(os.path.join(ROOT, "marketlens", "llm")), reason="the optional part is not there")
def test_other_faults_are_told():
    """Only a missing import is an excuse."""
    with pytest.raises(subprocess.CalledProcessError):
        names("import sys, types; sys.modules['public_tokenizers'] = types.ModuleType('public_tokenizers')\n")
