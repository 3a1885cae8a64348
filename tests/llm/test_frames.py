"""What operators hold at once: batches of bounded bytes, one query's shuffle files, the rows that are needed again."""

import glob
import os
import time
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from carelattice.llm import byte_bpe, circulant, frames, jaccard, rounds
from carelattice.llm.bloom import bitmap, marked
from tests.llm.conftest import SCHEMA


def test_batches_are_bounded_by_bytes(spark):
    def measured(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(batch)]), pa.array([batch.nbytes])], names=["n", "size"])

    texts = frames.bound_batches(spark.range(3000, numPartitions=1).select(F.repeat(F.lit("x"), 10_000).alias("text")))
    rows = texts.mapInArrow(measured, "n bigint, size bigint").collect()
    assert sum(r.n for r in rows) == 3000
    assert max(r["size"] for r in rows) < 2 * frames.BATCH


def test_operators_bound_their_batches(spark, frame):
    for operator in (jaccard.jaccard_components, circulant.near_copies):
        spark.conf.set(frames.BATCH_SETTING, str(64 << 20))
        operator(frame.limit(20))
        assert spark.conf.get(frames.BATCH_SETTING) == str(frames.BATCH)


def shuffle_files(spark):
    root = spark.conf.get("spark.local.dir", None) or os.environ.get("SPARK_LOCAL_DIRS") or spark.sparkContext._jvm.System.getProperty("java.io.tmpdir")
    return set(glob.glob(f"{root}/**/blockmgr-*/*/shuffle_*.data", recursive=True)) | set(glob.glob(f"{root}/blockmgr-*/*/shuffle_*.data"))


def test_stored_leaves_no_shuffle_files(spark):
    rows = spark.range(100_000, numPartitions=2).groupBy((F.col("id") % 5000).alias("k")).agg(F.max("id").alias("m"))
    before = shuffle_files(spark)
    kept = rows.collect()
    assert shuffle_files(spark) - before  # the place is the right one
    before, setting = shuffle_files(spark), spark.conf.get(frames.CLEANUP_SETTING)
    assert sorted(frames.stored(rows, "test").collect()) == sorted(kept)
    bitmap(rows, "m")
    deadline = time.time() + 10  # Spark deletes them beside its other work
    while shuffle_files(spark) - before and time.time() < deadline:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(frames.CLEANUP_SETTING) == setting


def test_one_row_of_each_wanted_class(spark):
    sets = spark.createDataFrame([(1, 10), (1, 11), (2, 20), (3, 30), (3, 31)], "class bigint, row_key bigint")
    wanted = spark.createDataFrame([(1,), (3,)], "class bigint")
    found = jaccard.one_row_each(sets, wanted)
    assert sorted(map(tuple, found.collect())) == [(1, 10), (3, 30)]
    batch = pa.RecordBatch.from_arrays([pa.array(["a", "b", None, "d"]), pa.array([10, 11, 30, 31])], names=["text", "row_key"])
    left = list(jaccard.rows_marked([batch], bitmap(found, "row_key"), 1))
    assert [b.to_pydict() for b in left] == [{"text": ["a", None], "row_key": [10, 30]}]


def test_sets_are_made_again_from_one_row_of_a_class(spark):
    docs = frames.identified(spark.createDataFrame([(1, "a b c"), (2, "a b c"), (None, "a b c"), (3, "x y z"), (4, None)], SCHEMA))
    sets = frames.stored(circulant.signed(docs, 2, 4, 2), "test")
    assert {(r.row_key, r.doc_id) for r in sets.collect()} == {(r.row_key, r.doc_id) for r in docs.collect()}
    wanted = sets.where("doc_id = 2").select("class").distinct()
    marks = bitmap(jaccard.one_row_each(sets, wanted), "row_key")
    keys = np.array([r.row_key for r in docs.collect()], np.int64)
    assert marked(marks, keys.view(np.uint64)).sum() == 1
    assert [len(r.shingles) for r in circulant.full_sets(docs, sets, wanted, 2).collect()] == [2]


def test_words_are_counted_over_batches(spark):
    """A word that each batch of a task holds once is frequent, too."""
    texts = spark.createDataFrame([(k, "ab " * 1_800_000 + "zqxvkjw end") for k in range(2)], SCHEMA).coalesce(1)
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    shared = spark.sparkContext.broadcast((ranks, byte_bpe.pair_table(ranks)))
    table = byte_bpe.frequent(frames.bound_batches(texts), shared, public_tokenizers.PATTERN, 100)
    assert byte_bpe.piece_arrays([b" zqxvkjw"])[2][0] in table.hash


def resident():
    with open("/proc/self/statm") as file:
        return int(file.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")


def test_a_worker_gives_its_memory_back():
    """Free memory below a block that is still in use."""
    pins = []

    def many(batches):
        blocks = [np.ones(12_000) for _ in range(2500)]  # 240 MB in blocks that are too small for pages of their own
        pins.append(np.ones(12_000))
        yield sum(map(len, blocks))

    before = resident()
    assert list(frames.lean(many)([])) == [30_000_000]
    assert resident() - before < 60e6


def test_shingles_of_many_classes_are_counted_without_copies_of_the_others():
    pick = np.random.default_rng(5)
    parts = [pick.integers(0, 2**63, 300_000).astype(np.uint64) for _ in range(3)] + [np.array([7, 7, 9, 7], np.uint64)]
    parts.append(parts[0][:1000])
    value, count = np.unique(np.concatenate(parts), return_counts=True)
    for times in (1, 2, 3):
        got = jaccard.repeated(list(parts), times)
        assert (got[0] == value[count >= times]).all() and (got[1] == count[count >= times]).all()
    held, size = list(parts), sum(p.nbytes for p in parts)
    tracemalloc.start()
    jaccard.repeated(held, 2)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 1.7 * size and not held
    assert [len(x) for x in jaccard.repeated([], 2)] == [0, 0]


def test_rows_go_to_the_steps_of_size_that_are_there(spark, monkeypatch):
    """Prefix rows are written once for each step of size of another component in their bucket, not for all that fit."""
    written = {}

    def counted(df, purpose):
        out = frames.stored(df, purpose)
        written[purpose] = out.count()
        return out

    monkeypatch.setattr(rounds, "stored", counted)
    rows = [(s, c, n, 0, root) for s in range(30) for c, n, root in ((1, 100, 1), (2, 100, 2), (3, 118, 3), (4, 400, 4), (5, 400, 4))]
    frame = spark.createDataFrame(rows, "bucket bigint, class bigint, n bigint, pos bigint, root bigint")
    found = rounds.open_by_prefix(frame).collect()
    assert {r["class"] for r in found} == {1, 2, 3} and len(found) == 30 * 5  # 1 and 2 meet each other, both meet 3
    assert written["first"] == 30 * 5


def test_shingles_are_listed_once_over_the_rounds(spark):
    """The next round reads the shingles that two components shared; the sets stay whole."""
    texts = {1: [1, 2, 3, 4, 5, 6, 7, 8, 9, 90], 2: [1, 2, 3, 4, 5, 6, 7, 8, 9, 91], 3: [1, 2, 3, 4, 5, 6, 7, 8, 9, 92], 4: [50, 51]}
    full = spark.createDataFrame([(c, p, [x for x in xs if x % 2 == p]) for c, xs in texts.items() for p in (0, 1)],
                                 "class bigint, fragment int, shingles array<bigint>")
    rows = lambda roots: spark.createDataFrame([(1, c, 10, roots[c]) for c in (1, 2, 3)], "bucket bigint, class bigint, n bigint, root bigint")
    first, mixed, sets, flat = rounds.still_open(rows({1: 1, 2: 2, 3: 1}), full)
    assert {r["class"] for r in first.collect()} == {r["class"] for r in mixed.collect()} == {1, 2, 3}
    whole = sorted(map(tuple, full.where("class < 4").collect()))
    assert sets.columns == full.columns and sorted(map(tuple, sets.collect())) == whole
    assert sorted(map(tuple, flat.collect())) == [(c, x) for c in (1, 2, 3) for x in range(1, 10)]
    again = rounds.still_open(rows({1: 1, 2: 2, 3: 1}), sets, flat)
    assert sorted(map(tuple, again[0].collect())) == sorted(map(tuple, first.collect()))
    assert again[3].count() == 27 and rounds.still_open(rows({1: 1, 2: 1, 3: 1}), again[2], again[3])[0].count() == 0
