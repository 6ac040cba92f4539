"""Tasks need no copy of the package: every operator runs where only the driver can import it."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[2]
JOB = """
import sys
sys.path.insert(0, {repo!r})
from corpus_ledger.session import local_session
from corpus_ledger.llm.queries import QUERIES
import corpus_pipeline
spark = local_session("foreign", 4)
spark.sparkContext.setLogLevel("ERROR")
def importable(batches):
    import importlib.util, pyarrow as pa
    for _ in batches:
        yield pa.RecordBatch.from_arrays([pa.array([importlib.util.find_spec("corpus_ledger") is not None])], names=["x"])
assert not any(r["x"] for r in spark.range(4).mapInArrow(importable, "x boolean").collect())
for name, job in {{**QUERIES, "pipeline": corpus_pipeline.run}}.items():
    print(name, job(spark, "/root/testdata/sf0.001").count(), flush=True)
"""


def test_every_operator_in_a_foreign_folder(tmp_path):
    pytest.importorskip("public_tokenizers")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", JOB.format(repo=str(REPO))], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    counts = dict(line.split() for line in run.stdout.splitlines() if line.startswith(("op", "pipeline")))
    assert run.returncode == 0, run.stderr[-3000:]
    assert len(counts) == 14 and all(int(n) > 0 for n in counts.values())
