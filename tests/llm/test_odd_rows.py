import pytest
from odd_tables import SOURCE, made

from tabularium.llm.queries import QUERIES

pytestmark = pytest.mark.skipif(not SOURCE.exists(), reason="no supplied tables")
FOUND = ("p1_found", "p4_found", "p5_found", "p8_found", "p9_found")


def test_nulls_and_clashing_names(spark, tmp_path):
    folder = made(tmp_path, "nulls")
    for query in QUERIES.values():
        query(spark, folder).write.format("noop").mode("overwrite").save()


@pytest.mark.parametrize("mode", ["empty", "twice"])
def test_no_rows_and_repeated_rows(spark, tmp_path, mode):
    folder = made(tmp_path, mode)
    for name in FOUND:
        rows = QUERIES[name](spark, folder).collect()
        once = QUERIES[name](spark, str(SOURCE)).collect() if mode == "twice" else []
        assert sorted(map(tuple, rows)) == sorted(map(tuple, once)), name
