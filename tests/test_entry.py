"""The entry must work when the folders of the training-text operators are gone."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

HIDE = """
import importlib.abc, sys
class Hidden(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if any(name == h or name.startswith(h + ".") for h in {hidden!r}):
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Hidden())
import __spark_entry__ as entry
print(sorted(k for k in entry.queries() if k.startswith("op") or k == "pipeline"))
print(len([k for k in entry.queries() if not k.startswith("op")]) > 50, set(entry.oracle_sql()) <= set(entry.queries()))
"""


@pytest.mark.parametrize("hidden", [["strata.llm", "corpus_pipeline"], ["strata.llm"]])
def test_entry_without_the_training_text_folders(hidden):
    out = subprocess.run([sys.executable, "-c", HIDE.format(hidden=hidden)], cwd=ROOT, capture_output=True, text=True, check=True)
    # of the rest, only the names that do not come from that folder are left
    assert out.stdout.split("\n")[:2] == ["[]", "True True"]


def test_other_missing_modules_are_not_hidden():
    out = subprocess.run([sys.executable, "-c", HIDE.format(hidden=["strata.plans.registry"])], cwd=ROOT, capture_output=True, text=True)
    assert out.returncode != 0 and "strata.plans.registry" in out.stderr
