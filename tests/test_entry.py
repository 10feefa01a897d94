"""The driver contract holds with and without the optional folders."""

import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_optional_queries():
    code = ("import sys; sys.modules['corpus_pipeline'] = None; sys.modules['tidemark.llm'] = None\n"
            "import __spark_entry__ as e; names = set(e.queries())\n"
            "assert 'apply_current' in names and 'pipeline' not in names and set(e.oracle_sql()) <= names")
    subprocess.run([sys.executable, "-c", code], cwd=REPO, check=True)


def test_a_copy_without_the_optional_folders(tmp_path):
    """The folders really gone: the entry and these tests hold."""
    for name in ("tidemark", "tests", "scripts"):
        shutil.copytree(os.path.join(REPO, name), tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py", "bench.py"):
        if os.path.exists(os.path.join(REPO, name)):
            shutil.copy(os.path.join(REPO, name), tmp_path / name)
    code = "import __spark_entry__ as e; names = set(e.queries()); assert 'apply_current' in names and not any(n.startswith('op') for n in names)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
    wanted = [f"tests/test_entry.py::{n}" for n in ("test_entry_without_the_optional_queries", "test_every_oracle_has_a_query",
                                                    "test_an_error_inside_the_optional_folders_is_not_hidden")]
    subprocess.run([sys.executable, "-m", "pytest", "-q", "-p", "no:cacheprovider", *wanted], cwd=tmp_path, check=True)


def test_every_oracle_has_a_query():
    import __spark_entry__ as contract
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_an_error_inside_the_optional_folders_is_not_hidden():
    code = ("import sys, types; sys.modules['pyarrow'] = None\n"
            "import importlib.util\n"
            "import tidemark\n"
            "if importlib.util.find_spec('corpus_pipeline') is None or importlib.util.find_spec('tidemark.llm') is None: sys.exit()\n"
            "try:\n    import __spark_entry__\n"
            "except ModuleNotFoundError as e:\n    assert e.name == 'pyarrow', e\n"
            "else:\n    raise AssertionError('hidden')")
    subprocess.run([sys.executable, "-c", code], cwd=REPO, check=True)
