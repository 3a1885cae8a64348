import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from carelattice.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
MORE = [(9100, "it's I'LL <|endoftext|> 　½²③٣٤"), (9101, "日本語テキスト👩‍👩‍👧"), (9102, "aaaa" * 200), (9103, " \n\n  a  ")]


def reference(path, text):
    ranks = byte_bpe.read_ranks(path)
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return coder.encode_ordinary(text or "")


@pytest.mark.parametrize("name, head", [("byte_bpe_50k.tiktoken", 300), ("byte_bpe_multi_50k.tiktoken", byte_bpe.HEAD)])
def test_ids_equal_the_reference_and_decode_to_the_text(spark, documents, name, head):
    path = public_tokenizers.path(name)
    rows = [(i, t) for i, t in documents if len(t or "") < 20_000] + MORE
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    ranks = byte_bpe.read_ranks(path)
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = byte_bpe.encode(frame, path, public_tokenizers.PATTERN, with_values=True, head=head).collect()
    want = sorted((str(i), coder.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows)
    assert sorted((str(r.doc_id), r.ids, bytes(r.decoded)) for r in got) == want
    for r in got:
        assert r.n_tokens == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(bytes(r.decoded)).hexdigest()


def test_decode_column(spark):
    frame = spark.createDataFrame([(1, [72, 105]), (2, []), (3, None)], "doc_id int, ids array<int>")
    pieces = {r: t for t, r in byte_bpe.read_ranks(PATH).items()}
    got = [bytes(r.decoded) for r in byte_bpe.decode(frame, PATH).orderBy("doc_id").collect()]
    assert got == [pieces[72] + pieces[105], b"", b""]


def test_every_pair_is_found_in_the_table():
    ranks = byte_bpe.read_ranks(PATH)
    place, table = byte_bpe.pair_table(ranks)
    for token, rank in list(ranks.items())[300:50_000:97]:
        for cut in range(1, len(token)):
            a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
            if a is not None and b is not None:
                assert table[place[a] + b] == (a + 1) << 16 | rank


def test_empty_table_and_clashing_names(empty, clashing):
    assert byte_bpe.encode(empty, PATH, public_tokenizers.PATTERN).count() == 0
    row = byte_bpe.encode(clashing, PATH, public_tokenizers.PATTERN).first()
    assert row.n_tokens == len(reference(PATH, "a clashing row of some nine plain words here"))


def test_a_step_of_the_fold_moves_one_array(spark):
    """Ids and ranks lie in one array of numbers; of pairs of the same rank the leftmost is merged, however they are split."""
    ranks = byte_bpe.read_ranks(PATH)
    columns = [F.array().cast(t) for t in ("array<smallint>", "array<int>", "array<int>", "array<bigint>")]
    assert str(byte_bpe.merged(*columns)).count("slice(") <= 3
    rows = [(i, t) for i, t in enumerate(["a" * n for n in range(12)] + ["abab" * 9 + "aab", "ababa" * 7, "é" * 30, "x" * 700])]
    got = byte_bpe.encode(spark.createDataFrame(rows, "doc_id bigint, text string"), PATH, public_tokenizers.PATTERN, with_values=True, head=1).collect()
    assert {r.doc_id: r.ids for r in got} == {i: reference(PATH, t) for i, t in rows}
    tiny = {bytes([b]): b for b in range(256)} | {b"aa": 256, b"aaa": 257, b"ba": 258, b"aba": 259, b"ab": 260}
    place, table = byte_bpe.pair_table(tiny)
    coder = tiktoken.Encoding("tiny", pat_str=r"\S+", mergeable_ranks=tiny, special_tokens={})
    for text in ("aaaaaaa", "abababa", "baabaab", "bababaabab"):
        frame = spark.createDataFrame([(list(text.encode()), list(range(256)), place.tolist(), table.tolist())], "piece array<smallint>, " + byte_bpe.MAP)
        assert frame.select(byte_bpe.merged(*map(F.col, ("piece", "byte_ids", "place", "table"))).alias("x")).first().x == coder.encode_ordinary(text)
