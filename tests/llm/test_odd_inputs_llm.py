import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from odd import folders  # noqa: E402

from noticeflow.llm import queries  # noqa: E402


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    from conftest import DATA

    return folders(spark, DATA, tmp_path_factory.mktemp("odd"))


def canonical(rows):
    return sorted(map(str, rows))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_odd(spark, data, odd, name):
    query = queries.QUERIES[name]
    usual = canonical(query(spark, data).collect())
    assert canonical(query(spark, odd["clashing"]).collect()) == usual
    assert query(spark, odd["empty"]).count() == 0
    twice = canonical(query(spark, odd["nulls"]).collect())
    if name in ("p4_found", "p8_ids", "p10_found"):
        assert set(usual) <= set(twice)
