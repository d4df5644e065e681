"""The pipeline against its stages done by brute force."""

import corpus_pipeline
from helixlake.llm import decontamination, packing, quality

from .conftest import SF
from .test_operators import PATH, classes, distance, kept_words


def test_pipeline(spark, sf_docs, tmp_path):
    sf_docs.where("n_chars < 900").write.parquet(f"{tmp_path}/documents.parquet")  # brute force is slow on long texts
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    sf_docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {r.doc_id for r in quality.judge(sf_docs).where("kept").collect()}
    texts = [(r.doc_id, r.text) for r in sf_docs.collect() if r.doc_id in kept]
    root = classes(texts)
    texts = [(i, t) for i, t in texts if root[i] == i]
    words, left = kept_words(texts)
    texts = [(i, b" ".join(left[i]).decode() if len(left[i]) < len(words[i]) else t) for i, t in texts]
    items = [[decontamination.form(w) for w in r.text.encode().split()] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]

    def leaks(text):
        w = [decontamination.form(x) for x in text.encode().split()]
        three = set(zip(w, w[1:], w[2:]))
        for item in items:  # all are of 14 words or more: one within the limit shares three words in a row
            if not three & set(zip(item, item[1:], item[2:])):
                continue
            limit = int(len(item) * 0.2 + 1e-9)
            for s in range(max(1, len(w) - len(item) + 1)):
                own = w[s : s + len(item)]
                if len(set(item) & set(own)) >= len(set(item)) - limit and distance(own, item) <= limit:
                    return True
        return False

    texts = [(i, t) for i, t in texts if not leaks(t)]
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = spark.createDataFrame(texts, "doc_id long, text string")
    columns = lambda rows: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert columns(got) == columns(packing.pieces(want, PATH, 1024).collect())
    assert len(texts) > 10


def test_stages_keep_columns(spark, edge_docs):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, edge_docs, SF).columns == edge_docs.columns


def test_stages_on_nothing(spark, no_docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, SF).count() == 0
