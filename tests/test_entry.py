from __future__ import annotations

import importlib
import sys


def test_entry_without_the_training_data_part(monkeypatch):
    """The registered queries import and stand without the optional part."""
    import __spark_entry__

    monkeypatch.setitem(sys.modules, "tidemark.llm", None)  # an import of it fails
    try:
        entry = importlib.reload(__spark_entry__)
        assert "time_bucket_hour" in entry.queries() and "pipeline" not in entry.queries()
        assert not [name for name in entry.queries() if name.startswith("op1")]
        assert set(entry.oracle_sql()) <= set(entry.queries())
    finally:
        monkeypatch.undo()
        importlib.reload(sys.modules["__spark_entry__"])


def test_nothing_else_imports_the_training_data_part():
    import pathlib

    root = pathlib.Path(__file__).parent.parent
    for path in [*root.glob("tidemark/**/*.py"), *root.glob("suite/*.py"), *root.glob("*.py")]:
        if "llm" not in path.parts and path.name not in ("corpus_pipeline.py", "__spark_entry__.py", "test_entry.py"):
            assert "tidemark.llm" not in path.read_text(), path
