"""Clashing column names, rows without an id, repeated ids, and the toxicity scores against a plain computation."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixlake.llm import decontamination, neardup, packing, quality, substrings, toxicity, urls
from helixlake.llm.common import word_hashes

from .test_operators import PATH

#: Names that the operators use within.
NAMES = "row row_key _row _row_key _spans spans _hash _n r1 r2 t1 t2 h1 h2 node head kept class_id root n_words words item path first doc gram x k".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice([f"w{i}" for i in range(300)]) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Two texts under one id, near copies of both, a row that is there twice, and rows without id or text."""
    base, other, long = prose(1, 60), prose(2, 60), prose(3, 90)
    near = lambda t: t.replace(" w1", " z1", 2)
    rows = [(1, base), (1, other), (2, near(base)), (3, near(other)), (4, long), (4, long), (None, long + " end"), (None, None), (5, None), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs.select("*", *(F.lit(n).alias(n) for n in NAMES))


def rows_of(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_near_dedup_of_repeated_ids(odd):
    texts = {(r.doc_id, r.text) for r in odd.collect()}
    kept = neardup.keep_one(odd)
    assert kept.columns == odd.columns
    got = rows_of(kept)
    assert [r[0] for r in got if r[1]] == [1, 1, 4] and set(got) <= texts
    assert [r[0] for r in got if r[1] is None] == [5, None]
    classes = sorted(map(tuple, neardup.classes(odd).collect()), key=str)
    assert classes == sorted([(1, 1), (1, 1), (2, 1), (3, 1), (4, 4), (4, 4), (None, 4), (None, None), (5, 5), (6, 6)], key=str)


def test_substrings_of_repeated_rows(odd):
    out = substrings.remove(odd)
    assert out.columns == odd.columns and out.count() == 10
    left = rows_of(out)
    assert [r for r in left if r[0] == 4] == [(4, ""), (4, "")]
    assert (None, "end") in left and (None, None) in left and (5, None) in left


def test_decontamination_goes_by_row(spark, odd):
    items = spark.createDataFrame([(9, prose(2, 60)), (8, prose(3, 90)), (None, prose(7, 20)), (7, None)], "item_id long, text string")
    out = decontamination.clean(odd, items)
    assert out.columns == odd.columns
    assert rows_of(out) == rows_of(odd.where("text is null or text = '' or doc_id = 2 or (doc_id = 1 and text <> '" + prose(2, 60) + "')"))
    found = {(r.doc_id, r.item_id) for r in decontamination.contaminated(odd, items).collect()}
    assert found == {(1, 9), (3, 9), (4, 8), (None, 8)}


def test_quality_and_packing_of_odd_rows(odd):
    kept = quality.keep(odd)
    assert kept.columns == odd.columns and kept.count() <= 10
    assert quality.judge(odd).count() == 10
    packed = packing.pack_documents(odd, PATH).collect()
    assert len(packed) == 10 and sum(r.length for r in packed if r.doc_id is None) > 90


def test_urls_with_both_labels(spark):
    rows = [("http://a.com/1", 0), ("http://a.com/1", 1), (None, 1), ("http://b.com/2", None)]
    features, trees = urls.fit(spark.createDataFrame(rows, "url string, block int"))
    assert features.mean == 0.5
    pages = spark.createDataFrame([(None, None, "h"), (1, "http://a.com/1", "h"), (1, "http://a.com/1", "h")], "page_id long, url string, verdict string")
    assert urls.judge(pages, spark.createDataFrame(rows, "url string, block int")).count() == 3


def test_word_hashes():
    texts = [None, b"", b" \t ", b"one", b"one two\x0bone", "Ärger  über\n".encode(), b"x" * 3_000_000 + b" y", b"\xc2\xa0z"]
    hashes, lens = word_hashes(texts, most=16)
    words = [(t or b"").split() for t in texts]
    assert lens.tolist() == [len(w) for w in words]
    known = {}
    for w, h in zip((w for own in words for w in own), hashes.tolist()):
        assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known) == 7
    assert (word_hashes(texts)[0] == hashes).all()


def test_toxicity_scores_every_window():
    """The score of a text is that of its worst window, each computed on its own."""
    net = toxicity.Network(4)
    net.scale = (1.3, -0.2)
    texts = [None, b"", b"one", prose(1, 30).encode(), prose(2, 200).encode(), (prose(3, 70) + " " + "y" * 60).encode()]
    want = []
    for t in texts:
        words, logits = toxicity.pieces(t), []
        for s in toxicity.windows_of(len(words)):
            own = words[s : s + toxicity.WINDOW]
            place = np.arange(len(own))[None] if own else np.full((1, 1), -1)
            logits.append(float(net.logits(net.table(own, np.float64), place)[0]))
        want.append(toxicity.sigmoid(np.array(1.3 * max(logits) - 0.2)))
    assert toxicity.Scorer(net).scores(texts) == pytest.approx(want, rel=1e-4)
