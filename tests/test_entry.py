"""The driver entry point with and without the training-data operators."""
import subprocess
import sys

from tests.conftest import ROOT

CODE = """
import sys
sys.modules[{missing!r}] = None
import __spark_entry__ as e
names = list(e.queries())
print(len(names), any(n.startswith("op") for n in names), "pipeline" in names, set(e.oracle_sql()) <= set(names))
"""


def test_entry_without_the_optional_operators():
    for missing in ("corpus_pipeline", "pondlens.llm"):
        out = subprocess.run([sys.executable, "-c", CODE.format(missing=missing)], cwd=ROOT, capture_output=True, text=True,
                             timeout=120)
        assert out.returncode == 0, out.stderr[-500:]
        n, ops, pipeline, same = out.stdout.split()[-4:]
        assert int(n) >= 75 and (ops, pipeline, same) == ("False", "False", "True")

