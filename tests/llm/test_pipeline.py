"""Queries against SQL, and the pipeline's stages against what each promises."""

import os
import random

import duckdb
import public_tokenizers
import pytest

from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from cratewise.llm.queries import ORACLES, QUERIES
from cratewise.llm.toxicity import fit, score_toxicity
from tools.check import table

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    df = QUERIES[name](spark, FOLDER)
    result = db.sql(ORACLES[name])
    assert table(df.columns, df.collect()) == table(result.columns, result.fetchall())


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept = {r.doc_id for r in docs.select("doc_id").collect()}
        assert kept <= ids and len(kept) >= 0.7 * len(ids)
        ids = kept
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == ids


def test_run_on_planted_rows(spark, tmp_path):
    dice = random.Random(2)

    def words(n):
        return " ".join("".join(dice.choices("aeioubdgklmnprst", k=7)) for _ in range(n))

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels, benchmark = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("labels", "benchmark"))
    item = benchmark.filter("size(split(text, ' ')) >= 12").orderBy("item_id").first().text
    shared, copied, own = words(30), words(120).split(), words(80)
    changed = " ".join([*copied[:60], "other", *copied[61:]])
    planted = {
        9_000_001: f"{words(40)}\n{item}\n{words(40)}",
        9_000_002: f"{words(80)}\n{shared}", 9_000_003: f"{own}\n{shared}",
        9_000_004: " ".join(copied), 9_000_005: changed, 9_000_006: " ".join(copied), 9_000_007: words(90),
    }
    first = docs.first()
    rows = [(i, t, first.lang, first.source, len(t)) for i, t in planted.items()]
    # In front of all others, so that nothing of the table is an earlier copy.
    docs = spark.createDataFrame(rows, docs.schema).unionByName(docs)
    for name, df in (("documents", docs), ("labels", labels), ("benchmark", benchmark)):
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    packed = corpus_pipeline.run(spark, str(tmp_path)).groupBy("doc_id").agg(F.sum("length").alias("n"))
    kept = {r.doc_id: r.n for r in packed.collect()}
    # The benchmark passage and later near copies go, an exact copy with them; the rest stays.
    assert {i for i in planted if i in kept} == {9_000_002, 9_000_003, 9_000_004, 9_000_007}
    tokens = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))

    def size(text):
        return len(tokens.encode(text, add_special_tokens=False).ids) + 1

    assert kept[9_000_002] == size(planted[9_000_002]) and kept[9_000_003] == size(own)
    toxic = {r.doc_id for r in score_toxicity(docs, fit(docs, labels)).filter("predicted = 1").collect()}
    assert toxic and not toxic & set(kept)
