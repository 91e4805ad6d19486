"""The driver contract without the training-data operators."""

import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_llm_folders(tmp_path):
    names = ["__spark_entry__.py", "oracle_sql.py", "boardwalk"]
    for n in names:
        src = os.path.join(REPO, n)
        if os.path.isdir(src):
            shutil.copytree(src, tmp_path / n, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(src, tmp_path / n)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'trip_board' in q and 'pipeline' not in q; assert set(q) == set(e.oracle_sql())"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True, timeout=120)


def test_nothing_else_imports_the_llm_package():
    for folder, _, files in os.walk(os.path.join(REPO, "boardwalk")):
        if os.path.basename(folder) == "llm":
            continue
        for f in files:
            if f.endswith(".py"):
                with open(os.path.join(folder, f), encoding="utf-8") as src:
                    assert "boardwalk.llm" not in src.read(), f
