"""The corpus pipeline: every stage on its own input, against brute force."""

import hashlib

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from showledger.llm import byte_bpe
from showledger.llm.queries import ORACLES, QUERIES
from tools.check import compare, connect

from .test_llm import _brute_hits, _normal, _shingles

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(FOLDER + "/documents.parquet")
    toxic = {r.doc_id for r in QUERIES["op5_toxicity"](spark, FOLDER).where("predicted = 1").collect()}
    left = {r.doc_id: r.text for r in docs.collect() if r.doc_id not in toxic}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "jaccard_join", "decontamination", "byte_bpe"]

    now = stages["toxicity"](spark, docs, FOLDER)
    assert now.columns == docs.columns and {r.doc_id for r in now.collect()} == set(left)

    first = {}
    for i in sorted(left):
        first.setdefault(_normal(left[i]), i)
    left = {i: left[i] for i in first.values()}
    now = spark.createDataFrame(stages["exact_dedup"](spark, now, FOLDER).collect(), docs.schema)
    assert {r.doc_id for r in now.collect()} == set(left)

    sets = {i: _shingles(t) for i, t in left.items()}
    root = {i: i for i in left}
    for _ in range(20):
        for i in left:
            for j in left:
                if sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                    root[i] = root[j] = min(root[i], root[j])
        if all(root[root[i]] == root[i] for i in left):
            break
    left = {i: t for i, t in left.items() if root[i] == i}
    now = spark.createDataFrame(stages["jaccard_join"](spark, now, FOLDER).collect(), docs.schema)
    assert {r.doc_id for r in now.collect()} == set(left)

    items = [tuple(r) for r in spark.read.parquet(FOLDER + "/benchmark.parquet").select("item_id", "text").collect()]
    left = {i: t for (i, t), hit in zip(left.items(), _brute_hits(left.values(), items)) if not hit[4]}
    now = spark.createDataFrame(stages["decontamination"](spark, now, FOLDER).collect(), docs.schema)
    assert {r.doc_id for r in now.collect()} == set(left)

    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    got = {r.doc_id: r for r in stages["byte_bpe"](spark, now, FOLDER).collect()}
    assert {i: bytes(r.ids) for i, r in got.items()} == {i: np.array(coder.encode_ordinary(t), dtype="<u4").tobytes() for i, t in left.items()}
    assert all(r.round_trip and r.n_tokens == len(r.ids) // 4 for r in got.values())


def test_run_and_empty(spark, tmp_path):
    whole = corpus_pipeline.run(spark, FOLDER)
    assert whole.where(~F.col("round_trip")).count() == 0 and whole.count() > 100
    folder = str(tmp_path)
    for table in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{table}.parquet").limit(0).write.parquet(f"{folder}/{table}.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_queries_against_sql(spark):
    con = connect(FOLDER)
    for name, sql in ORACLES.items():
        assert compare(con, spark, name, QUERIES[name], sql, FOLDER)[0] is None
    assert hashlib and len(QUERIES) == 10
