"""The entry point works without the training-data subpackage and its pipeline."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_training_data_folders(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", "tests"))
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); print(len(q), 'pipeline' in q)"
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) >= 130 and out[1] == "False"


@pytest.mark.parametrize("name", ["tiktoken", "public_tokenizers", "zstandard"])
def test_entry_without_a_library_that_only_the_training_data_part_needs(name):
    code = (f"import sys; sys.modules['{name}'] = None\n"
            "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); print(len(q), 'pipeline' in q)")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) >= 130 and out[1] == "False"


def test_nothing_else_imports_the_subpackage():
    for folder, _, names in os.walk(os.path.join(ROOT, "tontine")):
        if os.path.basename(folder) != "llm":
            for name in names:
                if name.endswith(".py"):
                    with open(os.path.join(folder, name), encoding="utf-8") as f:
                        assert "tontine.llm" not in f.read(), name
