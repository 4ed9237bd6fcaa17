import importlib
import sys


def test_entry_runs(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0 and "Visits" in df.columns


def test_imports_without_the_training_data_part(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("visitmart.llm") or m in ("corpus_pipeline", "__spark_entry__")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "visitmart.llm", None)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    entry = importlib.import_module("__spark_entry__")
    assert "funnel" in entry.queries() and "pipeline" not in entry.queries() and set(entry.oracle_sql()) <= set(entry.queries())
