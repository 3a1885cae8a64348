import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from carelattice.llm import pii, urls
from tests.llm import brute

PIECES = ["a@b.co", "x.y+z@mail.example.com", "@", "1.2.3.4", "999.1.1.1", "4111 1111 1111 1111", "4111111111111112", "+1 (555) 555-0100",
          "+12", "token = \"9b0b3c6a43eb78aa99cbd7049c572391524f37a8\"", "Version 2.0", "word", "é", "\n", " ", ".", "-", "0", "1"]


def test_base_spans_equal_the_rules():
    pick = random.Random(2)
    texts = ["".join(pick.choice(PIECES) + pick.choice(["", " "]) for _ in range(pick.randint(0, 12))) for _ in range(3000)]
    texts += ["".join(pick.choice("a@.%-1 +2(") for _ in range(25)) for _ in range(20_000)]
    for text in texts:
        assert pii.base_spans(text) == brute.base_spans(text), text


def test_digests(frame, documents):
    model = pii.train(frame)
    got = sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in pii.digests(frame, model).collect())
    want = []
    for i, t in documents:
        spans = brute.base_spans(t)
        text = ",".join(f"{k}:{a}:{z}" for k, a, z in spans)
        want.append((str(i), *[sum(s[0] == k for s in spans) for k in pii.BASE], hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want)


def test_classifier_adds_secrets_and_leaves_plain_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = pii.train(docs)
    rows = pii.detect(docs, model).join(docs.select("doc_id", "text"), "doc_id").collect()
    secrets = [r for r in rows if 'token = "' in r.text]
    assert secrets and all(any(s.kind == "secret" for s in r.added) for r in secrets)
    plain = [r for r in rows if not any(c.isdigit() or c == "@" for c in r.text)]
    assert plain and not any(r.added or r.base for r in plain)
    assert not [s for r in rows for s in r.added if r.text[s.start:s.end] in ("2.0", "4.0", "3")]


def test_em_finds_the_reliable_labeler():
    pick = np.random.default_rng(3)
    truth = pick.random(4000) < 0.3
    good = np.where(pick.random(4000) < 0.95, np.where(truth, 1, -1), 0)
    fair = np.where(pick.random(4000) < 0.8, np.where(truth, 1, -1), np.where(truth, -1, 1))
    noise, other = pick.integers(-1, 2, 4000), np.where(pick.random(4000) < 0.85, np.where(truth, 1, -1), np.where(truth, -1, 1))
    posterior, reliability = pii.expectation_maximisation(np.stack([good, fair, noise, other], 1), np.ones(4000))
    assert ((posterior > 0.5) == truth).mean() > 0.97
    assert reliability[1, 0, 2] > reliability[1, 1, 2] > reliability[1, 2, 2]


def test_redact_keeps_columns_and_masks(spark, empty, clashing):
    df = spark.createDataFrame([(1, "mail a@b.co now", 7), (2, None, 8), (3, "", 9)], "doc_id int, text string, base int")
    out = pii.redact(df, None)
    assert out.columns == ["doc_id", "text", "base"] and [r.text for r in out.orderBy("doc_id").collect()] == ["mail <email> now", None, ""]
    assert pii.train(empty) is None and pii.digests(empty, None).count() == 0
    assert pii.detect(clashing, None).first().added == []


def plain_url(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?", 1)[0].split("#", 1)[0]
    fits = [r for r in urls.RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
    return host, path, best and best[1] + best[2], best and best[0]


def test_rules_and_parts(spark):
    odd = [None, "", "x", "http://NET", "http://a.NET/", "xnet://xnet/", "http://example.net/en", "a://example.net/en/q?x", "q?://z.net/",
           "http://w.org/fr/#a?b", "http://org?/fr/", "http://é.org/fr/é", "http://h://net/", "http://example.com/de/x?y#z"]
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", "html")
    rows = [(r.page_id, r.url) for r in pages.collect()] + [(5000 + k, u) for k, u in enumerate(odd)] + [(5000, None)]
    got = urls.judge(spark.createDataFrame(rows, "page_id bigint, url string").repartition(2)).collect()
    want = {}
    for i, u in rows:
        want[i] = plain_url(u)
    assert len(got) == len(rows)
    for r in got:
        host, path, rule, verdict = want[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.block_score >= 0.5 else "allow"))


def test_trees_learn_the_rules(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    judged = urls.judge(pages).where("rule is null").collect()
    share = lambda rows: sum(r.verdict == "block" for r in rows) / len(rows)
    assert share([r for r in judged if r.host.endswith(".com")]) > share([r for r in judged if r.host.endswith(".org")])


@pytest.mark.parametrize("url, verdict", [("http://a.net/", "block"), ("http://a.org/fr/", "allow")])
def test_one_class_and_empty(spark, url, verdict):
    rows = spark.createDataFrame([(1, url), (2, "http://b.com/")], "page_id int, url string")
    assert {r.page_id: r.verdict for r in urls.judge(rows).collect()} == {1: verdict, 2: verdict}
    assert urls.judge(rows.limit(0)).count() == 0


def test_copies_of_one_url_do_not_fill_the_sample(spark):
    """Copies of the url with the smallest hash are one row of the sample: the trees still see both classes."""
    few = [f"http://a{k}.net/" for k in range(20)] + [f"http://b{k}.org/fr/page{k}" for k in range(20)]
    order = spark.createDataFrame([(u,) for u in few], "url string").orderBy(F.xxhash64("url")).collect()
    rows = few + [order[0].url] * 200 + ["http://c.com/"]
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id int, url string")
    got = {r.page_id: r for r in urls.judge(pages, rows=40).collect()}
    assert 0 < got[len(rows) - 1].block_score < 1
    got = {r.page_id: r for r in urls.judge(pages, rows=2).collect()}
    assert len(got) == len(rows) and 0 < got[len(rows) - 1].block_score < 1
