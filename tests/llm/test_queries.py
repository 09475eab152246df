from __future__ import annotations

import pytest
from lossmill.llm.queries import ORACLES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(same_as_sql, sf_dir, name):
    same_as_sql(name, sf_dir)
