import ast
import importlib
import pathlib

import pytest

import __spark_entry__ as entry

ROOT = pathlib.Path(entry.__file__).parent


def test_contract():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and all(callable(f) for f in q.values()) and "p2_found" in q


def test_only_the_entry_knows_llm():
    for f in (ROOT / "boxlake").rglob("*.py"):
        if "llm" in f.relative_to(ROOT / "boxlake").parts:
            continue
        for n in ast.walk(ast.parse(f.read_text())):
            names = [n.module or ""] if isinstance(n, ast.ImportFrom) else [a.name for a in n.names] if isinstance(n, ast.Import) else []
            assert not any("llm" in x for x in names), f


def test_only_a_missing_subpackage_is_passed_over(monkeypatch):
    """Without the subpackage the core's queries remain; a module that the subpackage needs may not be missing silently."""
    def missing(name):
        def load(_):
            raise ModuleNotFoundError(f"no {name}", name=name)

        return load

    for name in ("boxlake.llm", "boxlake.llm.queries"):
        monkeypatch.setattr(importlib, "import_module", missing(name))
        assert "p2_found" in entry.queries() and "p1_found" not in entry.queries() and set(entry.oracle_sql()) <= set(entry.queries())
    monkeypatch.setattr(importlib, "import_module", missing("ahocorasick"))
    with pytest.raises(ModuleNotFoundError):
        entry.queries()
