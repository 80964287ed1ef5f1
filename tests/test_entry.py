"""The driver contract: entry(), queries(), oracle_sql(), and a few oracle comparisons."""

import duckdb
import pytest

import __spark_entry__ as E
from wordlens.plans import catalog
from conftest import SF_SMALL

TABLES = "events documents pages labels conversations benchmark".split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["word", "count"]
    assert 0 < df.count() <= 10


def test_every_oracle_has_a_query():
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    own = catalog.queries()
    assert set(own) <= set(qs) and set(own) == set(catalog.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", ["word_count", "exact_topk", "cms_heavy_hitters",
                                  "new_urls_bloom", "valid_pages", "latest_per_key", "topk_frequent_items",
                                  "saved_table_sql", "stream_batch_cap", "stream_url_metrics", "stream_url_offsets",
                                  "cms_hierarchy_heavy_hitters", "frequent_items_merged", "stop_table_filtered"])
def test_matches_oracle_on_smallest_tables(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = sorted(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())
    cur = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    want = sorted(tuple(r[i] for i in order) for r in cur.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert got == want


def test_queries_without_and_with_a_broken_subpackage(tmp_path):
    """Without the subpackage's folder the other queries are there; an import that fails inside it is not passed over."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(E.__file__))
    shutil.copytree(f"{root}/wordlens", tmp_path / "wordlens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op') for n in e.queries()))"
    run = lambda: subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert run().stdout.split() == [str(len(catalog.queries())), "False"]
    (tmp_path / "corpus_pipeline.py").write_text("import wordlens.llm\n")
    (tmp_path / "wordlens" / "llm").mkdir()
    (tmp_path / "wordlens" / "llm" / "__init__.py").write_text("import a_module_that_is_missing\n")
    assert "a_module_that_is_missing" in run().stderr
