"""Each stage against a plain version on the stage's own input."""

import hashlib

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from carelattice.llm import byte_bpe, pii, toxicity
from carelattice.llm.frames import held_out
from tests.llm import brute
from tests.llm.conftest import EDGES, SF

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def plain_toxic(spark, rows, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet").where(~held_out(5))
    model = toxicity.train(docs, labels)
    rejected = {r.doc_id for r in toxicity.scored(docs, model).where("score >= 0.5").collect()}
    return [r for r in rows if r[0] not in rejected]


def plain_one(spark, rows, docs):
    least = brute.near_components([r[:2] for r in rows])
    return [r for i, r in enumerate(rows) if r[0] == least[i] or not brute.words(r[1])]


def plain_clean(spark, rows, docs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {i for i, _ in brute.contaminated([r[:2] for r in rows], items)}
    return [r for r in rows if r[0] not in bad]


def plain_mask(spark, rows, docs):
    model, out = pii.train(docs), []
    for i, text, lang, source, n in rows:
        masked = None if text is None else pii.masked(text, sum(pii.find_spans(text, model), []))
        out.append((i, masked, lang, source, n if text is None else len(masked)))
    return out


def plain_encoding(spark, rows, docs):
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    digest = lambda x: hashlib.sha256(x).hexdigest()
    ids = [(r[0], coder.encode_ordinary(r[1] or ""), r[1] or "") for r in rows]
    return [(i, len(x), digest(np.array(x, "<u4").tobytes()), digest(t.encode())) for i, x, t in ids]


PLAIN = [plain_toxic, plain_one, plain_clean, plain_mask, plain_encoding]


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "n-gram Jaccard join", "benchmark decontamination", "PII", "byte-level BPE"]
    edges = [(i, t, "en", None, len(t or "")) for i, t in EDGES if i not in (None, 9006)]
    first = spark.read.parquet(f"{SF}/documents.parquet").unionByName(
        spark.createDataFrame(edges, "doc_id bigint, text string, lang string, source string, n_chars bigint")).dropDuplicates(["doc_id"])
    rows = sorted(tuple(r) for r in first.collect())
    for (_, stage), plain in zip(corpus_pipeline.STAGES, PLAIN):
        docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3)
        out = stage(spark, docs, SF)
        assert plain is plain_encoding or out.columns == COLUMNS
        got, want = sorted((tuple(r) for r in out.collect()), key=str), sorted(plain(spark, rows, docs), key=str)
        assert got == want, stage.__name__
        rows = sorted(want)


def test_run_on_an_empty_table(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
