import os

import pytest

from siltworks.llm import queries
from tests.compare import DATA, check

SF = f"{DATA}/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
COLUMNS = {
    "p1_found": "row_id_a long, row_id_b long", "p2_found": "field string, tag string, mark string", "p3_found": "item_a string, item_b string", "p4_found": "row_id long, turn_pos int, defect string", "p5_found": "row_id long, turn_pos int",
    "p6_found": "row_id long", "p7_ids": "doc_id long, ids array<int>", "p8_found": "doc_id long, item_id long", "p9_found": "doc_id long",
}


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_equals_sql(spark, name):
    check(spark, queries.QUERIES[name], queries.ORACLE_SQL[name], SF)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    df = queries.QUERIES[name](spark, SF)
    assert ", ".join(f"{c} {t.replace('bigint', 'long')}" for c, t in df.dtypes) == COLUMNS[name]
    if name != "p7_ids":
        assert df.count() == df.distinct().count() > 0
