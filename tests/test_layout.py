"""What the layout promises."""

import ast
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_only_llm_knows_llm():
    for p in (ROOT / "tessera").rglob("*.py"):
        if "llm" in p.relative_to(ROOT / "tessera").parts:
            continue
        for node in ast.walk(ast.parse(p.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n for n in names), p


def test_entry_points():
    import __spark_entry__ as e

    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 185


def test_no_local_checkpoint():
    for p in (ROOT / "tessera").rglob("*.py"):
        assert "localCheckpoint(" not in p.read_text(), p
