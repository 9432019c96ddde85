import __spark_entry__
from tenderlake.llm.queries import ORACLE, QUERIES


def test_one_query_for_each_operator():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(ORACLE) <= set(QUERIES)
    registered = __spark_entry__.queries()
    assert set(QUERIES) | {"pipeline"} <= set(registered)
