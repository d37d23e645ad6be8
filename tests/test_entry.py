"""The entry point works without the optional part."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[1]
PROBE = "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries(), all(n.startswith('q_') for n in e.queries()))"


def probe(folder, code):
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    return done.stdout.split()


@pytest.fixture
def copy(tmp_path):
    def skipped(folder, names):
        return [n for n in names if n in (".git", "__pycache__", ".pytest_cache")]

    return Path(shutil.copytree(REPO, tmp_path / "repo", ignore=skipped))


@pytest.mark.parametrize("gone", [["predial/llm", "tests/llm"],
                                  ["predial/llm", "tests/llm", "corpus_pipeline.py"]])
def test_without_the_folders(copy, gone):
    for name in gone:
        path = copy / name
        shutil.rmtree(path) if path.is_dir() else path.unlink(missing_ok=True)
    number, pipeline, only = probe(copy, PROBE)
    assert int(number) > 60 and (pipeline, only) == ("False", "True")


def test_without_a_package_it_needs(copy):
    """A package that only the optional part imports."""
    found = probe(copy, "import sys; sys.modules['xxhash'] = None; " + PROBE)
    assert int(found[0]) > 60 and found[1:] == ["False", "True"]
