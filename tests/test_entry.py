"""The entry without its optional part."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
OPTIONAL = {"roentra/llm", "tests/llm"}


def copy_without(target, left_out):
    def ignored(folder, names):
        at = os.path.relpath(folder, ROOT)
        return {n for n in names if n.startswith(".") or os.path.normpath(f"{at}/{n}") in left_out}

    return shutil.copytree(ROOT, target, ignore=ignored)


def run(tree, *command):
    done = subprocess.run(
        [sys.executable, *command], cwd=tree, capture_output=True, text=True, timeout=300
    )
    assert done.returncode == 0, done.stdout + done.stderr
    return done.stdout


@pytest.mark.parametrize("left_out", [OPTIONAL, OPTIONAL | {"corpus_pipeline.py"}])
def test_the_rest_stands_alone(tmp_path, left_out):
    tree = copy_without(tmp_path / "tree", left_out)
    code = (
        "import __spark_entry__ as e; from roentra.workload import QUERIES;"
        "print(set(e.queries()) == set(QUERIES), set(e.oracle_sql()) <= set(QUERIES))"
    )
    assert run(tree, "-c", code).split() == ["True", "True"]
    # Collects every test file that is left; an import that fails is an error.
    assert "error" not in run(tree, "-m", "pytest", "tests", "--collect-only", "-q").lower().split()


def test_with_the_optional_part_all_is_registered():
    code = "import __spark_entry__ as e; print('pipeline' in e.queries(), 'op1_bpe' in e.queries())"
    if os.path.isdir(f"{ROOT}/roentra/llm"):
        assert run(ROOT, "-c", code).split() == ["True", "True"]
