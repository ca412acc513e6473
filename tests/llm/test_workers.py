from __future__ import annotations

import os
import pathlib
import subprocess
import sys

from .conftest import SF_DIR

SCRIPT = """
import sys
sys.path.insert(0, {root!r})  # the driver's path only
from tidemark.session import build_session
from tidemark.llm import langid, secretscan
spark = build_session("workers", **{{"spark.master": "local[2]", "spark.ui.enabled": "false",
                                    "spark.sql.shuffle.partitions": "2", "spark.checkpoint.dir": "file://{scratch}"}})
docs = spark.read.parquet({data!r})
model = langid.fit(docs)
assert model.languages and langid.predict(docs, model).filter("lang_pred <> 'und'").count()
assert secretscan.scan(docs.select("doc_id", "text")).count() == docs.count()
print("whole results")
"""


def test_models_reach_workers_without_the_package(tmp_path):
    root = str(pathlib.Path(__file__).parents[2])
    code = SCRIPT.format(root=root, scratch=tmp_path / "scratch", data=f"{SF_DIR}/documents.parquet")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "whole results" in done.stdout, done.stderr[-2000:]
