import random

from pyspark.sql import functions as F

from carelattice.llm import decontaminate as d
from suite.check import duck
from tests.llm import brute
from tests.llm.conftest import SF


def found(docs, items):
    return {(r.doc_id, r.item_id): (r.first_word, round(r.similarity, 9)) for r in d.contaminated(docs, items).collect()}


def planted(pick):
    """Items of 12 to 70 words, and documents that hold them whole, changed or in part."""
    text = lambda n: [f"w{pick.randrange(4000)}" for _ in range(n)]
    items = [(k, " ".join(text(pick.randint(12, 70)))) for k in range(12)] + [(50, "four words only here"), (51, None), (52, "")]
    rows = []
    for i in range(120):
        words = items[pick.randrange(12)][1].split()
        for _ in range(pick.choice([0, 0, 1, 1, 2])):
            words[pick.randrange(len(words))] = "changed"
        words = words[pick.choice([0, 0, 1, 3, 8]):]
        rows.append((i, " ".join(text(pick.randint(0, 60)) + words * pick.choice([1, 1, 2]) + text(pick.randint(0, 60))).title()))
    return rows, items


def test_planted_passages_equal_brute_force(spark, documents):
    rows, items = planted(random.Random(5))
    rows += [(i, t) for i, t in documents if len(t or "") < 3000 and i is not None][:40]
    got = found(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), spark.createDataFrame(items, "item_id bigint, text string"))
    want = {k: (a, round(s, 9)) for k, (a, s) in brute.contaminated(rows, items).items()}
    assert got == want and len(want) > 30


def test_join_instead_of_listed_shingles(spark, monkeypatch):
    monkeypatch.setattr(d, "LISTED", 3)
    rows, items = planted(random.Random(6))
    got = found(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert got == {k: (a, round(s, 9)) for k, (a, s) in brute.contaminated(rows, items).items()}


def test_query_equals_sql(spark):
    from carelattice.llm.queries import op4_simhash_windows

    got = sorted((r.doc_id, r.item_id, r.first_word, round(r.similarity, 9)) for r in op4_simhash_windows(spark, SF).collect())
    assert got == sorted((a, b, c, round(s, 9)) for a, b, c, s in duck(SF).execute(d.ORACLE).fetchall())


def test_edges(spark, frame, empty, clashing):
    items = spark.createDataFrame([(1, "a clashing row of some nine plain words here"), (1, "a clashing row of some nine plain words here")], "item_id int, text string")
    assert found(empty, items) == {} and found(frame, items.limit(0)) == {}
    assert found(clashing, items) == {(1, 1): (0, 1.0)}
    assert d.clean(clashing, items).count() == 0
    assert d.clean(frame, items).count() == frame.count()  # repeated and null rows included


def test_blocks_hold_all_fingerprints_within_the_radius(spark):
    pick = random.Random(9)
    rows = []
    for _ in range(300):
        a, b = pick.getrandbits(64), 0
        for bit in pick.sample(range(64), d.RADIUS):
            b |= 1 << bit
        rows.append((a - 2**63, (a ^ b) - 2**63))
    pairs = spark.createDataFrame(rows, "a bigint, b bigint")
    both = pairs.select(F.arrays_overlap(d.blocks(F.col("a"), d.RADIUS), d.blocks(F.col("b"), d.RADIUS)).alias("hit"))
    assert both.where("hit").count() == 300


def test_plan_has_no_python(spark, frame):
    items = spark.createDataFrame([(1, "a b c d e f g")], "item_id int, text string")
    plan = d.contaminated(frame, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
