"""The package imports with nothing but Python: no file is read, no JVM or session is asked."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(code: str) -> str:
    return subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout


def test_import_reads_no_jar_and_starts_no_jvm():
    code = """
import glob, zipfile
glob.glob = lambda *a, **k: []
def refuse(*a, **k): raise AssertionError("a file is read at import")
zipfile.ZipFile.__init__ = refuse
import __spark_entry__ as e
from pyspark import SparkContext
assert SparkContext._gateway is None
print(len(e.queries()), len(e.oracle_sql()))
"""
    n, sql = map(int, run(code).split())
    assert n >= sql > 60


def test_base_queries_stand_without_the_optional_subpackage():
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == "casebook.llm" or name.startswith("casebook.llm.") or name == "corpus_pipeline":
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
print(sum(n.startswith("op") and n[2].isdigit() for n in e.queries()), len(e.queries()))
"""
    numbered, n = map(int, run(code).split())
    assert numbered == 0 and n > 80
