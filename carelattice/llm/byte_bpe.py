"""Byte-level BPE: encoding by ranked merges in Spark's higher-order functions, and decoding.

1. Frequent words of the corpus are counted; the pieces that the tokenizer's pattern cuts from the ``HEAD``
   most frequent ones are folded once and travel to the tasks (a bounded table).
2. An Arrow function splits the texts of a block with the pattern and lists the block's distinct pieces that
   are neither tokens nor in the table, as byte arrays. No text is shuffled: a block is one row of
   distinct pieces and of the places where they occur.
3. Spark folds the merges over each distinct piece: per step the pair of lowest rank (the leftmost of
   equals) becomes one token, until no pair has a rank. Tokens are numbers that hold rank, place and id, so that a
   step moves one array. Ranks of pairs come from a literal map that
   travels in the row (as a literal of the expression it would be repeated in every printed
   plan); a lookup is two array accesses.
4. A second Arrow function puts each text's ids together; decoding concatenates the ids' bytes.

The result equals the reference library's ordinary encoding for the same ranks and pattern, without
special tokens, whatever the table holds. Defined results: null and empty texts have no ids and
decode to nothing; repeated rows are encoded one by one; columns other than id and text are not
read. Any text can be decoded exactly, as every byte is a token. The time for one piece grows with
the square of its length (a piece of 20,000 letters takes some ten seconds).
"""

from __future__ import annotations

import base64
import hashlib
import os
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from carelattice.llm.frames import bound_batches, fetched, lean, pieces as blocks_of
from carelattice.llm.words import SEGMENT, hash_spans, ramp, words

IDS = 1 << 16
HEAD = 1 << 20           # words whose pieces are folded once
HEAD_BYTES = 48          # and the longest of these pieces
BARE = 64                # words are folded without a blank before them, too, from so many occurrences on
COUNTED = 64 << 20       # a word is counted in runs of so many bytes that hold it twice
BLOCK_BYTES = 6 << 20    # a batch (``frames.BATCH``), unless its last text is very long


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a rank file: base64 and number in each line."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    if len(ranks) != len(set(ranks.values())) or not all(0 <= r < IDS - 1 for r in ranks.values()):
        raise ValueError(f"ranks must be different and below {IDS - 1}")
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("every byte must be a token")
    return ranks


def pair_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """A place for each token, and a table with (token + 1) << 16 | rank at the place of a pair's first token
    plus its second one, for all pairs that make a token; 0 is empty."""
    seconds: dict[int, list[tuple[int, int]]] = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
            if a is not None and b is not None:
                seconds.setdefault(a, []).append((b, rank))
    total = sum(map(len, seconds.values()))
    size = max(4 * IDS, 1 << (8 * total).bit_length())
    table, place, pick = np.zeros(size, np.int64), np.zeros(IDS, np.int32), np.random.default_rng(1)
    for a, row in sorted(seconds.items(), key=lambda x: -len(x[1])):
        at = np.array([b for b, _ in row])
        while True:
            start = int(pick.integers(0, size - IDS))
            if not table[start + at].any():
                break
        place[a] = start
        table[start + at] = (a + 1) << 16 | np.array([r for _, r in row], np.int64)
    return place, table


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


PLACE_BITS, TOKEN_BITS = 30, 16
NONE = IDS << (PLACE_BITS + TOKEN_BITS)   # rank of a token that makes no pair with the next one


def rank(a: Column, b: Column, place: Column, table: Column) -> Column:
    """Rank of a pair of tokens; ``IDS`` if they make no token."""
    return F.least(F.get(table, F.get(place, a) + b).bitwiseXOR((a.cast("bigint") + 1) * IDS), F.lit(IDS).cast("bigint"))


def merged(piece: Column, byte_ids: Column, place: Column, table: Column) -> Column:
    """Token ids of a piece given as an array of bytes.

    A token is one number: from the highest bits on the rank of its pair with the next token, the place of its first byte
    and its id. The least number is the leftmost pair of lowest rank, and a step moves one array."""
    shift = PLACE_BITS + TOKEN_BITS

    def packed(pair: Column, rest: Column) -> Column:
        return F.shiftleft(pair, shift).bitwiseOR(rest)

    def token_of(x: Column) -> Column:
        return x.bitwiseAND(F.lit((1 << TOKEN_BITS) - 1)).cast("int")

    def first(ids: Column) -> Column:
        def one(a: Column, i: Column) -> Column:
            pair = F.when(i + 1 < F.size(ids), rank(a, F.get(ids, i + 1), place, table)).otherwise(F.lit(IDS).cast("bigint"))
            return packed(pair, F.shiftleft(i.cast("bigint"), TOKEN_BITS).bitwiseOR(a.cast("bigint")))

        return F.transform(ids, one)

    def step(x: Column, _: Column) -> Column:
        def apply(least: Column) -> Column:
            token = F.shiftright(least, shift).cast("int")

            def at(p: Column) -> Column:  # 0-based place of the pair
                pair = F.when(p + 2 < F.size(x), rank(token, token_of(F.get(x, p + 2)), place, table)).otherwise(F.lit(IDS).cast("bigint"))
                start = least.bitwiseAND(F.lit(((1 << PLACE_BITS) - 1) << TOKEN_BITS))
                made, after = packed(pair, start.bitwiseOR(token.cast("bigint"))), F.slice(x, p + 3, F.size(x))
                left = F.get(x, p - 1)
                before = packed(rank(token_of(left), token, place, table), left.bitwiseAND(F.lit((1 << shift) - 1)))
                return F.when(p > 0, F.concat(F.slice(x, F.lit(1), p - 1), F.array(before, made), after)).otherwise(F.concat(F.array(made), after))

            return F.when(least < NONE, let((F.array_position(x, least) - 1).cast("int"), at)).otherwise(x)

        return let(F.coalesce(F.array_min(x), F.lit(NONE)), apply)

    start = let(F.transform(piece, lambda b: F.get(byte_ids, b)), first)
    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(piece) - 1, F.lit(1))), start, step, lambda x: F.transform(x, token_of))


@lru_cache(maxsize=2)
def _pattern(pattern: str):
    return regex.compile(pattern)


class Table(NamedTuple):
    """Ids of pieces, found by hash."""

    hash: np.ndarray     # sorted
    start: np.ndarray    # of each piece's ids, one more than there are pieces
    ids: np.ndarray


def found_in(known: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Place of each hash among the sorted ``known`` ones, or -1."""
    if not len(known):
        return np.full(len(hashed), -1)
    at = np.minimum(np.searchsorted(known, hashed), len(known) - 1)
    return np.where(known[at] == hashed, at, -1)


def piece_arrays(pieces_: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes, offsets and hashes of pieces."""
    data = np.frombuffer(b"".join(pieces_), np.uint8)
    offsets = np.concatenate([[0], np.cumsum(np.fromiter(map(len, pieces_), np.int64, len(pieces_)))])
    hashed = np.zeros(len(pieces_), np.uint64)
    at = 0
    while at < len(pieces_):  # in segments, as hashing takes many times the bytes
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SEGMENT, side="right")) - 1)
        part = slice(offsets[at], offsets[end])
        hashed[at:end] = hash_spans(data[part], offsets[at:end] - offsets[at], offsets[at + 1:end + 1] - offsets[at])
        at = end
    return data, offsets, hashed


def as_row(values: pa.Array) -> pa.ListArray:
    """An array as the only value of a list column."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def fixed_rows(ranks: dict[bytes, int], tables) -> list[pa.ListArray]:
    by_byte = pa.array([ranks[bytes([b])] for b in range(256)], pa.int32())
    return [as_row(by_byte), as_row(pa.array(tables[0])), as_row(pa.array(tables[1]))]


MAP = "byte_ids array<int>, place array<int>, table array<bigint>"
BLOCK = "doc_ids array<bigint>, counts array<int>, places array<int>, heads array<int>, pieces array<array<smallint>>, " + MAP


def byte_lists(data: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(data.astype(np.int16)))


def fold() -> Column:
    return F.transform("pieces", lambda p: merged(p, F.col("byte_ids"), F.col("place"), F.col("table")))


def frequent(texts: DataFrame, shared, pattern: str, head: int) -> Table:
    """The table of pieces of the most frequent words. What it holds only decides how often Spark folds."""

    def count(batches):
        held, bytes_ = [], 0  # of each block its distinct words only

        def report():
            value, n, size, data = (np.concatenate(part) for part in zip(*held))
            _, first, inverse = np.unique(value, return_index=True, return_inverse=True)
            total = np.bincount(inverse, n, len(first)).astype(np.int64)
            at, total = first[total > 1], total[total > 1]
            offsets = np.concatenate([[0], np.cumsum(size[at])]).astype(np.int32)
            word = pa.Array.from_buffers(pa.binary(), len(at), [
                None, pa.py_buffer(offsets), pa.py_buffer(gathered(data, (np.cumsum(size) - size)[at], size[at]))])
            return pa.RecordBatch.from_arrays([word, pa.array(total)], names=["word", "n"])

        for batch in blocks_of(batches, 0):
            found = words(batch.column(0))
            value, first, n = np.unique(found.hash, return_index=True, return_counts=True)
            size = (found.end - found.start)[first]
            short = size <= HEAD_BYTES
            held.append((value[short], n[short], size[short], gathered(found.data, found.start[first[short]], size[short])))
            bytes_ += len(found.data)
            if bytes_ >= COUNTED:
                yield report()
                held, bytes_ = [], 0
        if held:
            yield report()

    def cut(batches):
        find = _pattern(pattern).findall
        for batch in batches:
            made = {p.encode() for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for t in [w.decode()]
                    for p in (*find(" " + t), *(find(t) if n >= BARE else ()))}
            made = sorted(p for p in made if p not in shared.value[0] and len(p) <= HEAD_BYTES)
            data, offsets, hashed = piece_arrays(made)
            yield pa.RecordBatch.from_arrays([pa.array(hashed.view(np.int64)), byte_lists(data, offsets)], names=["hash", "piece"])

    def block(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [as_row(batch.column(0)), as_row(batch.column(1)), *fixed_rows(*shared.value)], names=["hashes", "pieces", "byte_ids", "place", "table"])

    counted = texts.select("text").mapInArrow(lean(count), "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "word").limit(head).select("word", "n").repartition(64)
    made = top.mapInArrow(lean(cut), "hash bigint, piece array<smallint>").dropDuplicates(["hash"])
    folded = made.mapInArrow(lean(block), "hashes array<bigint>, pieces array<array<smallint>>, " + MAP).select("hashes", fold().alias("ids"))
    got = fetched(folded.select(F.inline(F.arrays_zip("hashes", "ids")))).combine_chunks()
    if not len(got):
        return Table(np.zeros(0, np.uint64), np.zeros(1, np.int32), np.zeros(0, np.uint16))
    ids, offsets = _flat(got["ids"].chunk(0))
    hashed = got["hashes"].to_numpy().view(np.uint64)
    order = np.argsort(hashed)
    size = np.diff(offsets)[order]
    return Table(hashed[order], np.concatenate([[0], np.cumsum(size)]).astype(np.int32), gathered(ids, offsets[:-1][order], size).astype(np.uint16))


def split_batches(batches, ranks: dict[bytes, int], tables, hashes: np.ndarray, pattern: str):
    """A row a block: distinct pieces that are no token, and for each text where its pieces are listed.

    A place below ``IDS`` is a token; from there on it numbers the listed pieces. ``heads`` has the
    listed pieces' places in the table, or -1 for those (in order) that Spark folds.
    """
    find = _pattern(pattern).findall
    for batch in blocks_of(batches, 1, BLOCK_BYTES):
        known: dict[str, int] = {}
        listed, places, counts = [], [], []
        for text in batch.column(1).to_pylist():
            found = find(text) if text else []
            for piece in set(found).difference(known):
                raw = piece.encode()
                token = ranks.get(raw)
                if token is None:
                    token = IDS + len(listed)
                    listed.append(raw)
                known[piece] = token
            places.append(np.fromiter(map(known.__getitem__, found), np.int32, len(found)))
            counts.append(len(found))
        heads = found_in(hashes, piece_arrays(listed)[2])
        data, offsets, _ = piece_arrays([listed[i] for i in np.flatnonzero(heads < 0)])
        yield pa.RecordBatch.from_arrays([
            as_row(batch.column(0).cast(pa.int64())), as_row(pa.array(np.array(counts, np.int32))),
            as_row(pa.array(np.concatenate(places) if places else np.zeros(0, np.int32))), as_row(pa.array(heads.astype(np.int32))),
            as_row(byte_lists(data, offsets)), *fixed_rows(ranks, tables)],
            names=["doc_ids", "counts", "places", "heads", "pieces", "byte_ids", "place", "table"])


def _flat(array: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    if not len(array):  # Spark may hand over no offset at all
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    offsets = array.offsets.to_numpy()
    return array.values.slice(offsets[0], offsets[-1] - offsets[0]).to_numpy(zero_copy_only=False), offsets - offsets[0]


def gathered(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs of ``values`` that begin at ``start``, one after the other."""
    return values[np.repeat(start, size) + ramp(size)]


def token_bytes(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens' bytes in one array, and start and length of each id's."""
    start, size = np.zeros(IDS, np.int64), np.zeros(IDS, np.int64)
    data = b"".join(ranks)
    at = 0
    for token, rank_ in ranks.items():
        start[rank_], size[rank_] = at, len(token)
        at += len(token)
    return np.frombuffer(data, np.uint8), start, size


def decoded(ids: np.ndarray, tokens) -> bytes:
    data, start, size = tokens
    return gathered(data, start[ids], size[ids]).tobytes()


def assemble(batches, tokens, table: tuple[np.ndarray, np.ndarray], with_values: bool):
    """A row a text again: its ids, what they decode to, and digests of both. ``table``: start and ids of the head's pieces."""
    head_start, head_ids = table
    known = np.concatenate([np.arange(IDS, dtype=np.uint16), head_ids])
    for batch in batches:
        for k in range(len(batch)):
            row = batch.slice(k, 1)
            doc_ids, counts, places, heads = (row.column(j).flatten() for j in range(4))
            counts, places, heads = counts.to_numpy(), places.to_numpy(), heads.to_numpy()
            folded, offsets = _flat(row.column(4).flatten())
            values = np.concatenate([known, folded.astype(np.uint16)])
            in_head, turn = heads >= 0, np.cumsum(heads < 0) - 1
            begin, length = np.zeros(IDS + len(heads), np.int64), np.ones(IDS + len(heads), np.int64)
            begin[:IDS] = np.arange(IDS)
            begin[IDS:][in_head] = IDS + head_start[heads[in_head]]
            length[IDS:][in_head] = head_start[heads[in_head] + 1] - head_start[heads[in_head]]
            begin[IDS:][~in_head] = IDS + len(head_ids) + offsets[turn[~in_head]]
            length[IDS:][~in_head] = np.diff(offsets)[turn[~in_head]]
            ends = np.concatenate([[0], np.cumsum(counts)])
            out = {n: [] for n in ("n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded")}
            for a, z in zip(ends[:-1].tolist(), ends[1:].tolist()):
                mine = gathered(values, begin[places[a:z]], length[places[a:z]]).astype("<u4")
                text = decoded(mine, tokens)
                out["n_tokens"].append(len(mine))
                out["ids_sha256"].append(hashlib.sha256(mine.tobytes()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(text).hexdigest())
                if with_values:
                    out["ids"].append(mine.astype(np.int32))
                    out["decoded"].append(text)
            kinds = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string(), "ids": pa.list_(pa.int32()), "decoded": pa.binary()}
            names = list(out) if with_values else list(out)[:3]
            yield pa.RecordBatch.from_arrays([doc_ids, *[pa.array(out[n], kinds[n]) for n in names]], names=["doc_id", *names])


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_values: bool = False,
           head: int = HEAD) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, and on request ids and decoded: one row a document.

    ``path`` names the rank file; the driver reads it and sends it to the tasks.
    """
    ranks = read_ranks(os.fspath(path))
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((ranks, pair_table(ranks)))
    texts = bound_batches(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")))
    table = frequent(texts, shared, pattern, head)
    hashes, rest = context.broadcast(table.hash), context.broadcast((token_bytes(ranks), table[1:]))  # a worker holds what it needs
    blocks = texts.mapInArrow(lean(lambda batches: split_batches(batches, *shared.value, hashes.value, pattern)), BLOCK)
    folded = blocks.select("doc_ids", "counts", "places", "heads", fold().alias("folded"))
    fields = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded binary" if with_values else "")
    return folded.mapInArrow(lean(lambda batches: assemble(batches, *rest.value, with_values)), fields)


def decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``: the bytes of the ids, one after the other (null ids: none)."""
    ranks = read_ranks(os.fspath(path))
    shared = encoded.sparkSession.sparkContext.broadcast({rank_: token for token, rank_ in ranks.items()})
    join = F.pandas_udf(lambda ids: ids.map(lambda x: b"".join(shared.value[i] for i in x) if x is not None else b""), "binary", F.PandasUDFType.SCALAR)
    return encoded.withColumn("decoded", join(F.col(ids_col)))
