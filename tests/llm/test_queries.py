import __spark_entry__ as entry
from carelattice.llm import queries


def test_all_are_registered():
    names = sorted(queries.QUERIES, key=lambda n: int(n[2:].split("_")[0]))
    assert [n.split("_")[0] for n in names] == [f"op{k}" for k in range(1, 11)]
    assert set(names) | {"pipeline"} <= set(entry.queries()) and set(queries.ORACLES) <= set(entry.oracle_sql())
