"""Every query of the subpackage runs and has the columns asked for."""

import pytest

from folioloom.llm import queries as Q

COLUMNS = {
    "p1_found": ["id_a", "id_b"], "p2_found": ["body_id", "line_no"], "p3_found": ["id", "line_no"], "p4_found": ["id", "cefr_level"], "p5_found": ["id", "block_kind", "block_text"],
    "p6_found": ["record_table", "record_key", "author_id"], "p8_ids": ["doc_id", "ids"], "p10_found": ["doc_id", "area"],
}


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query(spark, small, name):
    df = Q.QUERIES[name](spark, small)
    rows = [repr(r) for r in df.collect()]
    if name in COLUMNS:
        assert df.columns == COLUMNS[name] and len(rows) == len(set(rows))
    assert rows or name == "p10_found"  # a dozen labels are too few


def test_every_problem_is_there():
    assert {n.split("_")[0] for n in Q.QUERIES} == {"p1", "p2", "p3", "p4", "p5", "p6", "p8", "p9", "p10"}
