"""The rest of the repository without the training-data operators and their pipeline."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).parents[1]
ASKS = """
import __spark_entry__ as driver, bench
print(len(driver.queries()), len(driver.oracle_sql()))
print([n for n in driver.queries() if n.startswith("op") and n[2].isdigit() or n == "pipeline"])
"""


def test_the_entry_imports_without_them(tmp_path):
    left = shutil.ignore_patterns("llm", ".git", "__pycache__")
    for with_pipeline in (False, True):
        to = tmp_path / str(with_pipeline)
        shutil.copytree(ROOT / "millrace", to / "millrace", ignore=left)
        (to / "millrace" / "llm").mkdir()
        for name in ("__spark_entry__.py", "bench.py", *["corpus_pipeline.py"] * with_pipeline):
            if (ROOT / name).exists():
                shutil.copy(ROOT / name, to)
        env = {**os.environ, "PYTHONPATH": str(to)}
        done = subprocess.run([sys.executable, "-c", ASKS], cwd=to, env=env, capture_output=True, text=True)
        assert done.returncode == 0, done.stderr
        counts, names = done.stdout.splitlines()
        assert names == "[]"
        assert len(set(counts.split())) == 1
