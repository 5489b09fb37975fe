import builtins
import importlib.util
import sys

import pytest

import __spark_entry__ as entry


@pytest.mark.parametrize("missing", ["obsmatch.llm", "obsmatch.llm.queries", "public_tokenizers", "corpus_pipeline"])
def test_core_queries_survive_a_missing_subpackage_or_dependency(monkeypatch, missing):
    if importlib.util.find_spec("obsmatch.llm") is None:
        pytest.skip("there is nothing to miss")
    real = builtins.__import__

    def no_import(name, *args, **kw):
        if name == missing or name.startswith(missing + "."):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
        return real(name, *args, **kw)

    for loaded in [m for m in sys.modules if m.startswith(("obsmatch.llm", "corpus_pipeline", "public_tokenizers"))]:
        monkeypatch.delitem(sys.modules, loaded)
    monkeypatch.setattr(builtins, "__import__", no_import)
    real_module = entry.importlib.import_module
    monkeypatch.setattr(entry.importlib, "import_module", lambda n: no_import(n) if n.startswith(missing) else real_module(n))
    with pytest.warns() if missing == "public_tokenizers" else _quiet():
        queries, sql = entry.queries(), entry.oracle_sql()
    assert "gold_accident_weather" in queries and set(sql) <= set(queries)
    assert "pipeline" not in queries


class _quiet:
    def __enter__(self):
        return self

    def __exit__(self, *args):
        return False
