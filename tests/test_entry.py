import os
import subprocess
import sys


def test_entry_imports_without_a_session():
    """The driver and the bench import the entry module before any Spark session exists."""
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert len(q) > 40 and set(o) <= set(q)"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), timeout=120)
