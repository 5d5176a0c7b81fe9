"""The driver contract holds with and without the llm package."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_contract():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) > 30


def test_core_does_not_need_llm():
    code = (
        "import sys; sys.modules['tamiz.llm'] = None\n"
        "import __spark_entry__ as e, tamiz.cli, bench\n"
        "assert not any(k.startswith(('p3', 'p4', 'p5', 'p7', 'p8', 'p9', 'p10')) for k in e.queries())"
    )
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT).returncode == 0
    assert not [p for p in (ROOT / "tamiz").rglob("*.py") if "llm" not in p.parts and "tamiz.llm" in p.read_text(encoding="utf-8")]
