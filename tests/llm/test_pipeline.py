"""The pipeline on the smallest tables, each stage against what it should keep."""

import pytest
import public_tokenizers as P
from pyspark.sql import functions as F

import brute
import corpus_pipeline as C
from lodestone.llm import bpe

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("extra", F.lit(1))
    columns, at = docs.columns, {}
    for k, (name, stage) in enumerate(C.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        docs = stage(spark, docs, SF).persist()
        at[name] = (before, {r.doc_id: r for r in docs.collect()})
        assert k == len(C.STAGES) - 1 or docs.columns == columns
    before, after = at["quality classifier"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [i for i in before if labels.get(i) == 1]
    assert sum(i in after for i in good) > 0.9 * len(good)
    before, after = at["n-gram Jaccard join"]
    want = brute.jaccard_components([(i, r.text) for i, r in before.items()])
    assert set(after) == {i for i, (_, root) in want.items() if root == i}
    before, after = at["benchmark decontamination"]
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    held = {i for i, r in before.items() if any(t in " ".join(r.text.lower().split()) for t in items)}
    assert set(after) == set(before) - held
    before, after = at["secret scans"]
    assert set(after) == set(before) and all(len(r.text) == r.n_chars and "AKIA" not in r.text for r in after.values())
    before, after = at["byte-level BPE"]
    codec = bpe.codec(bpe.read_ranks(P.path(C.RANKS)), P.PATTERN)
    import numpy as np

    assert all(codec.decode(np.array(r.input_ids, "<u4").tobytes()).decode() == before[i].text for i, r in after.items())


def test_run(spark):
    assert C.run(spark, SF).columns == ["doc_id", "text", "lang", "source", "n_chars", "input_ids", "n_tokens"]


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "plain words of a text", None, None, 21), (2, "plain words of a text", None, None, 21)]])
def test_odd_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in C.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() <= len(rows)


#: Names that the operators use inside, now or before.
INNER = ["text_1", "score", "score_1", "null", "redacted", "holds", "id", "h", "n", "node", "bucket", "payload", "component_id", "__score", "__text", "__bad", "__null", "__redacted", "__copy", "input_ids", "n_tokens"]


def test_clashing_names_null_ids_and_repeated_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(120)
    near = docs.orderBy(F.length("text").desc()).limit(1).select(F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"), *docs.columns[1:])
    docs = docs.unionByName(near).unionByName(near)
    for k, name in enumerate(INNER):
        docs = docs.withColumn(name, F.lit(k))
    columns = docs.columns
    for k, (name, stage) in enumerate(C.STAGES):
        out = stage(spark, docs, SF).persist()
        last = k == len(C.STAGES) - 1
        assert sorted(out.columns) == sorted(columns) and (last or out.columns == columns), name
        rows = out.collect()
        assert rows and all(r[c] == j for r in rows for j, c in enumerate(INNER) if not (last and c in ("input_ids", "n_tokens"))), name
        if k == 1:  # the copies without id go, their original stays
            assert all(r.doc_id is not None for r in rows)
        docs = out
    for _, stage in C.STAGES:
        assert stage(spark, spark.read.parquet(f"{SF}/documents.parquet").limit(0), SF).count() == 0
