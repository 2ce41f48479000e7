"""The entry without the optional training-data operators."""

import os
import subprocess
import sys
import textwrap
from pathlib import Path

from termlift.catalog.oracles import ORACLES
from termlift.catalog.queries import QUERIES

ROOT = Path(__file__).resolve().parent.parent
HIDING = textwrap.dedent(
    """
    import importlib.util, sys

    find = importlib.util.find_spec
    importlib.util.find_spec = lambda name, *rest: None if name in {hidden} else find(name, *rest)

    class Hidden:
        def find_spec(self, name, path=None, target=None):
            if name in {hidden}:
                raise ModuleNotFoundError(name)

    sys.meta_path.insert(0, Hidden())
    import __spark_entry__ as entry
    print(len(entry.queries()), len(entry.oracle_sql()), *(name for name in entry.queries() if name == "pipeline"))
    """
)


def _names_without(*hidden):
    done = subprocess.run([sys.executable, "-c", HIDING.format(hidden=set(hidden))], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    return done.stdout.split()


def test_entry_without_the_operators():
    assert _names_without("termlift.llm") == [str(len(QUERIES)), str(len(ORACLES))]


def test_entry_without_operators_and_pipeline():
    assert _names_without("termlift.llm", "corpus_pipeline") == [str(len(QUERIES)), str(len(ORACLES))]


ELSEWHERE = textwrap.dedent(
    """
    import sys

    sys.path.insert(0, {root!r})
    from pyspark.sql import SparkSession
    import __spark_entry__ as entry

    spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
    print(entry.queries()["svm_predictions"](spark, "/root/testdata/sf0.001").count())
    """
)


def test_python_workers_find_the_code_from_another_folder(tmp_path):
    """Trainers run in Python workers, which start in the session's folder and know no path but their own."""
    code = ELSEWHERE.format(root=str(ROOT))
    known = {name: value for name, value in os.environ.items() if name != "PYTHONPATH"}
    known["PYTHONPATH"] = os.pathsep.join(path for path in os.environ.get("PYTHONPATH", "").split(os.pathsep) if path and Path(path).resolve() != ROOT)
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=known, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert int(done.stdout.split()[-1]) > 0
