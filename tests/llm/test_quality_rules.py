import zstandard

from carelattice.llm import quality_rules as q
from tests.llm import brute


def verdict(text):
    raw = (text or "").encode()
    n, *_, repeated = brute.quality_counts(text)
    if n < 10 or 100 * repeated > 20 * n:
        return False
    size = lambda x: len(zstandard.ZstdCompressor(level=q.LEVEL).compress(x)) / len(x)
    _, low, high = [b for b in q.BANDS if len(raw) >= b[0]][-1]
    parts = [raw[i:i + q.CHUNK] for i in range(0, len(raw), q.CHUNK)]
    parts = [size(p) for p in parts if 2 * len(p) >= q.CHUNK]
    odd = sum(not q.CHUNK_BAND[0] <= r <= q.CHUNK_BAND[1] for r in parts)
    return low <= size(raw) <= high and 2 * odd <= len(parts)


def test_counts_and_verdicts(frame, documents):
    got = sorted(((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.kept)
                  for r in q.compression_bands(frame).collect()))
    short = [(i, t) for i, t in documents if len(t or "") < 20_000]
    want = sorted((str(i), *brute.quality_counts(t), verdict(t)) for i, t in short)
    kept = {(str(i), len(brute.words(t))) for i, t in short}
    assert [g for g in got if (g[0], g[1]) in kept] == want and len(got) == len(documents)


def test_random_and_repetitive_text_is_rejected(spark):
    import base64
    import random

    pick = random.Random(1)
    noise = " ".join(base64.b64encode(pick.randbytes(9)).decode() for _ in range(400))
    repeated = " ".join(f"{a} {b}" for a in "abc" for b in "xyz") + " "
    rows = spark.createDataFrame([(1, noise), (2, "".join(repeated + f"{i} " for i in range(300)))], "doc_id int, text string")
    got = {r.doc_id: r for r in q.compression_bands(rows).collect()}
    assert not got[1].base_failed and not got[1].kept and not got[2].kept


def test_empty_table_and_clashing_names(empty, clashing):
    assert q.compression_bands(empty).count() == 0
    row = q.compression_bands(clashing).first()
    assert row.n_words == 9 and row.score == "score" and "text" not in row.asDict()
