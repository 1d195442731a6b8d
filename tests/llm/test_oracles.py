"""Queries of this subpackage against their SQL."""

from __future__ import annotations

import pytest

import corpus_pipeline
from compare import compare, duck
from sparge.llm.oracles import all_oracles
from sparge.llm.queries import all_queries


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_query(spark, folder, name):
    result = compare(spark, duck(folder), folder, all_queries()[name], all_oracles()[name])
    assert result["same"], result


def test_entry_registers_them():
    import __spark_entry__ as contract

    assert set(all_queries()) | {"pipeline"} <= set(contract.queries())
    assert set(all_oracles()) <= set(contract.oracle_sql())
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in contract.oracle_sql()
