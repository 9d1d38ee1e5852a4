import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(entry.__file__).parent


def test_every_sql_belongs_to_a_query():
    queries = entry.queries()
    assert set(entry.oracle_sql()) <= set(queries) and all(callable(q) for q in queries.values())
    found = {f"p{n}_found" for n in (1, 2, 3, 4, 6)}
    assert found <= set(queries) and "p6_found" in queries


def test_the_rest_imports_without_the_text_subpackage(tmp_path):
    code = "import sys; sys.modules['tripmart.llm'] = None\nimport __spark_entry__ as e\nassert not [q for q in e.queries() if q[:2] in ('p5', 'p7', 'p8', 'p9')] and 'p6_found' in e.queries() and e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
    for path in (ROOT / "tripmart").rglob("*.py"):
        if "llm" not in path.parts:
            assert "tripmart.llm" not in path.read_text(), path
