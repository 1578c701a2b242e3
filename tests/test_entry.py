"""The entry points work without the llm subpackage and without the pipeline."""

import subprocess
import sys
from pathlib import Path

from stackgrain.plans import catalogue

CODE = """
import sys
for name in {gone!r}:
    sys.modules[name] = None
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()), "pipeline" in e.queries())
"""


def said(*gone):
    code = CODE.format(gone=gone)
    return subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parent.parent, capture_output=True, text=True, check=True).stdout.split()


def test_queries_without_the_subpackage():
    own = [str(len(catalogue.QUERIES)), str(len(catalogue.ORACLE_SQL)), "False"]
    assert said("stackgrain.llm", "stackgrain.llm.queries", "corpus_pipeline") == own
    assert said("stackgrain.llm") == own
    assert said("corpus_pipeline")[2] == "False"


def test_every_sql_has_its_query():
    assert set(catalogue.ORACLE_SQL) <= set(catalogue.QUERIES)
