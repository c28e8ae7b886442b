"""The queries whose work runs in Python, and the pipeline, where workers can't import this package."""

import os
import subprocess
import sys
import textwrap
from pathlib import Path

REPO = Path(__file__).resolve().parents[2]
SCRIPT = textwrap.dedent("""
    import sys
    repo, sf = sys.argv[1:3]
    sys.path.insert(0, repo)  # of the driver alone
    from planmart.session import local_session
    spark = local_session(cpus=4, shuffle_partitions=4)

    def importable(batches):
        import importlib.util
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([importlib.util.find_spec("planmart") is not None])], names=["x"])

    assert not any(r.x for r in spark.range(1).mapInArrow(importable, "x boolean").collect())
    import __spark_entry__ as E
    queries = E.queries()
    docs = spark.read.parquet(f"{sf}/documents.parquet").count()
    for name in sorted(q for q in queries if q.startswith("op") or q == "pipeline"):
        n = queries[name](spark, sf).count()
        assert n > 0, name
        print(name, n, docs)
""")


def test_workers_need_no_copy_of_the_package(sf_small, tmp_path):
    (tmp_path / "driver.py").write_text(SCRIPT)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "driver.py", str(REPO), sf_small], cwd=tmp_path, env=env, capture_output=True, text=True,
                          timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    assert len(done.stdout.strip().splitlines()) == 14, done.stdout
