"""Workers that cannot import the library run the operators."""

import os
import subprocess
import sys
from pathlib import Path

_REPOSITORY = Path(__file__).resolve().parents[2]
_SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from goldspine.llm import suite
from goldspine.session import build_session

spark = build_session("elsewhere", 4, 2, "-XX:TieredStopAtLevel=1")


def importable(batches):
    from importlib.util import find_spec
    import pyarrow as pa
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([find_spec("goldspine") is not None] * batch.num_rows)], names=["found"])


assert not any(r.found for r in spark.range(4).mapInArrow(importable, "found boolean").collect())
for name, query in suite.QUERIES.items():
    if name.split("_")[0] in ("op2", "op4", "op7", "op10"):
        continue  # these run no Python
    rows = query(spark, "/root/testdata/sf0.001").count()
    assert rows, name
    print("done", name, rows, flush=True)
"""


def test_functions_travel_with_their_tasks(tmp_path):
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", _SCRIPT, str(_REPOSITORY)], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=600
    )
    assert done.returncode == 0, done.stderr[-4000:]
