"""Every core query that has SQL gives DuckDB's rows on the smallest tables."""

import pytest

from newsloom.plans.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    from tools_oracle import connect

    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, sf_dir, name):
    from tools_oracle import compare

    assert compare(spark, con, QUERIES[name], ORACLES[name], sf_dir) == ""


def test_keyword_table_without_sql(spark, sf_dir):
    got = QUERIES["q49_keyword_table"](spark, sf_dir).collect()
    assert got and all(1 <= r.rank <= 20 for r in got)


def test_library_does_not_need_the_llm_subpackage():
    import pathlib

    root = pathlib.Path(__file__).parent.parent / "newsloom"
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert "llm" not in p.read_text(encoding="utf-8").replace("_llm", "").replace("llm_", ""), p
