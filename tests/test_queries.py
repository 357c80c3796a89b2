"""Every query with SQL gives the SQL's rows; those without give rows."""

import pytest

from quernstone import queries as q


@pytest.mark.parametrize("name", list(q.oracle_sql()))
def test_oracle(spark, oracle, name):
    oracle(spark, name, q.queries()[name], q.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(q.queries()) - set(q.oracle_sql())))
def test_rows(spark, sf_dir, name):
    assert q.queries()[name](spark, sf_dir).count() > 0


def test_entry_module_without_corpus_operators():
    """The entry module and the core import where the corpus operators are gone."""
    import subprocess
    import sys

    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith(('quernstone.llm', 'corpus_pipeline')): raise ModuleNotFoundError(name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert len(e.queries()) > 50 and 'pipeline' not in e.queries() and set(e.oracle_sql()) <= set(e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=__file__.rsplit("/", 2)[0])
