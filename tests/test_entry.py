import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parents[1]


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 40


def test_core_stands_alone():
    code = "import sys; sys.modules['cuefold.llm'] = None; import __spark_entry__ as e; assert 'p5_found' in e.queries() and not any(k.startswith('p1_') for k in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_nothing_in_the_core_names_the_text_operators():
    for path in (ROOT / "cuefold").rglob("*.py"):
        if "llm" not in path.parts:
            assert "llm" not in path.read_text(encoding="utf-8")
