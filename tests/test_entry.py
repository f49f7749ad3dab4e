"""The entry module with and without its optional part."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

WITHOUT = """
import sys

class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("tallyglass.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)

sys.meta_path.insert(0, Missing())
import __spark_entry__ as entry
from tallyglass.plans.oracles import ORACLES
from tallyglass.plans.queries import QUERIES
assert set(entry.queries()) == set(QUERIES) and set(entry.oracle_sql()) == set(ORACLES)
"""


def test_imports_without_the_optional_part():
    done = subprocess.run([sys.executable, "-c", WITHOUT], cwd=ROOT, capture_output=True, text=True, check=False)
    assert done.returncode == 0, done.stderr


def test_nothing_else_imports_the_optional_part():
    for path in [*ROOT.glob("*.py"), *(ROOT / "tallyglass").rglob("*.py"), *(ROOT / "tests").glob("*.py")]:
        inside = "llm" in path.relative_to(ROOT).parts
        if not inside and path.name not in ("__spark_entry__.py", "corpus_pipeline.py", "test_entry.py"):
            text = path.read_text()
            assert "tallyglass.llm" not in text and "corpus_pipeline" not in text, path
