"""Entry point: every oracle belongs to a query, and the library stands without its optional parts."""

import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry_point

ROOT = Path(__file__).resolve().parents[1]


def test_oracles_belong_to_queries():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).count() == 687


def test_imports_without_optional_parts(tmp_path):
    for p in ROOT.rglob("*.py"):
        rel = p.relative_to(ROOT)
        if "llm" in rel.parts or rel.name == "corpus_pipeline.py":
            continue
        (tmp_path / rel).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / rel).write_bytes(p.read_bytes())
    code = "import __spark_entry__ as e; q = e.queries(); assert 'gold_table' in q and 'pipeline' not in q"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=60)
