import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

REPO = Path(entry.__file__).parent


def test_flagship_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_the_rest_works_without_the_corpus_package(tmp_path):
    code = f"""
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == 'corpus_pipeline' or name.startswith('marajo.llm'):
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Gone())
sys.path.insert(0, {str(REPO)!r})
import __spark_entry__ as e
assert 'pipeline' not in e.queries() and not any(k.startswith('op') and k[2].isdigit() for k in e.queries())
assert len(e.queries()) > 100
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path)
