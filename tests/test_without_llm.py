"""The entry without the training-data operators: their folder, or a package that they need, is absent."""

import os
import shutil
import subprocess
import sys

import pytest

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = ("import __spark_entry__ as e, regioncast.catalog as c; q = e.queries(); "
         "assert set(q) == set(c.QUERIES) and len(q) >= 58, sorted(q); assert set(e.oracle_sql()) <= set(q); print('CORE', len(q))")


def run(code, cwd):
    done = subprocess.run([sys.executable, "-c", code], cwd=cwd, capture_output=True, text=True, timeout=120, env={**os.environ, "PYTHONPATH": cwd})
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout


@pytest.mark.parametrize("left", ["nothing", "pipeline", "empty folder"])
def test_folders_left_out(tmp_path, left):
    copy = str(tmp_path / "copy")
    ignored = shutil.ignore_patterns(".git", "llm", "__pycache__", "spark-warehouse", *([] if left == "pipeline" else ["corpus_pipeline.py"]))
    shutil.copytree(HERE, copy, ignore=ignored)
    if left == "empty folder":
        os.makedirs(f"{copy}/regioncast/llm/__pycache__")
    assert "CORE" in run(COUNT, copy)
    listed = subprocess.run([sys.executable, "-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider"], cwd=copy, capture_output=True,
                            text=True, timeout=120, env={**os.environ, "PYTHONPATH": copy})
    assert listed.returncode == 0, listed.stdout[-2000:]


@pytest.mark.parametrize("package", ["public_tokenizers", "pyarrow", "zstandard"])
def test_missing_package(package):
    if not os.path.isdir(f"{HERE}/regioncast/llm"):
        pytest.skip("the operators themselves are absent")
    assert "CORE" in run(f"import sys; sys.modules[{package!r}] = None; " + COUNT, HERE)


def test_errors_of_the_operators_are_not_hidden(tmp_path):
    copy = str(tmp_path / "copy")
    shutil.copytree(HERE, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "spark-warehouse", "tests", "llm"))
    os.makedirs(f"{copy}/regioncast/llm")
    for name, text in (("__init__.py", ""), ("queries.py", "import regioncast.llm.no_such_module\n")):
        with open(f"{copy}/regioncast/llm/{name}", "w") as f:
            f.write(text)
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; e.queries()"], cwd=copy, capture_output=True, text=True, timeout=120,
                          env={**os.environ, "PYTHONPATH": copy})
    assert done.returncode != 0 and "no_such_module" in done.stderr
