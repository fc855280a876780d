"""Python batch functions run when the driver starts outside the repository."""

import os
import subprocess
import sys

from helpers import ROOT, SF_SMALL

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from quillspark.session import get_session
spark = get_session("local[2]", 2)
import __spark_entry__ as E
print("ROWS", E.queries()["gram_matrix"](spark, {SF_SMALL!r}).count())
"""


def test_batch_functions_run_from_another_directory(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=600)
    assert "ROWS 4096" in out.stdout, out.stderr[-2000:]
