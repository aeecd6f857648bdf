"""The registry can be read before there is a session."""

import os
import subprocess
import sys


def test_queries_are_listed_without_a_session():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import __spark_entry__ as e; assert len(e.queries()) > 100 and set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
