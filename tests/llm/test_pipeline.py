"""The pipeline's stages over the smallest tables, each against a brute-force version on its own input."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from folioloom.llm import quality, toxicity
from folioloom.llm.common import stored
from folioloom.llm.queries import table, tokenizer_path
from test_text_operators import components_brute, print_brute, windows_brute

SF = "/root/testdata/sf0.001"


def ids(rows):
    return sorted(r.doc_id for r in rows)


def test_stages_equal_brute_force(spark):
    from tokenizers import Tokenizer

    docs = table(spark, SF, "documents")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality", "toxicity", "simhash_dedup", "decontamination", "packing"]
    after = []
    for name, stage in corpus_pipeline.STAGES:
        after.append(stored(stage(spark, after[-1] if after else docs, SF), name))
    before = [docs, *after[:-1]]
    for frame in after[:-1]:
        assert frame.schema.names == docs.schema.names

    labels = table(spark, SF, "labels")
    good = quality.score(docs, quality.fit(docs, labels)).where(F.col("score") >= quality.THRESHOLD)
    assert ids(after[0].collect()) == ids(good.collect())
    clean = toxicity.score(before[1], toxicity.fit(before[1], labels)).where(F.col("score") < toxicity.THRESHOLD)
    assert ids(after[1].collect()) == ids(clean.collect())
    marks = {r.doc_id: r.quality for r in labels.collect()}
    judged = [(r.doc_id in set(ids(after[0].collect()))) == bool(marks[r.doc_id]) for r in docs.collect() if r.doc_id in marks]
    assert np.mean(judged) >= 0.95

    rows = [(r.doc_id, r.text) for r in before[2].collect()]
    groups = components_brute([(i, print_brute(t)) for i, t in rows], 2)
    assert ids(after[2].collect()) == sorted(set(groups.values()))

    rows = [(r.doc_id, r.text) for r in before[3].collect()]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    assert ids(after[3].collect()) == sorted(d for d, *_, bad in windows_brute(rows, items) if not bad)

    tokenizer = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    pieces, sequences = {}, {}
    for r in after[4].collect():
        pieces[r.doc_id] = pieces.get(r.doc_id, 0) + r.length
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert pieces == {r.doc_id: len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in before[4].collect()}
    for places in sequences.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 2048


def test_pipeline_takes_nulls_empty_and_repeated_rows(spark):
    docs = table(spark, SF, "documents").limit(40)
    extra = spark.createDataFrame([(None, None), (9001, None), (9002, ""), (9003, "word " * 20_000), (9003, "word " * 20_000)],
                                  "doc_id long, text string")
    frame = docs.withColumn("score", F.lit("clash")).unionByName(extra, allowMissingColumns=True)
    for name, stage in corpus_pipeline.STAGES:
        frame = stored(stage(spark, frame, SF), name)
    assert frame.count() > 0
    empty = stored(table(spark, SF, "documents").limit(0), "empty")
    for name, stage in corpus_pipeline.STAGES:
        empty = stored(stage(spark, empty, SF), name)
    assert empty.count() == 0


CLASHING = ["places", "Items", "n_words", "passages", "quality_score", "toxicity_score", "simhash_row", "simhash_key",
            "pack_row", "score", "number", "key", "in_0", "Contaminated", "added_text"]


def test_stages_keep_columns_of_any_name(spark):
    docs = table(spark, SF, "documents").limit(60)
    docs = docs.select(*(F.concat(F.lit(c + " "), "doc_id").alias(c) for c in CLASHING), *docs.columns)
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stored(stage(spark, frame, SF), name)
        assert frame.columns == docs.columns and frame.dtypes == docs.dtypes
        rows = frame.collect()
        assert rows and all(r[c] == f"{c} {r.doc_id}" for r in rows for c in CLASHING)
    assert corpus_pipeline.STAGES[-1][1](spark, frame, SF).count() > 0


def test_pipeline_leaves_nothing_behind(spark, tmp_path):
    import os

    from folioloom.sources import tables

    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    with tables.scope():
        corpus_pipeline.run(spark, SF).write.parquet(f"{tmp_path}/out")
    assert set(os.listdir(shared)) == before and spark.read.parquet(f"{tmp_path}/out").count() > 0


def test_queries_equal_their_sql(spark):
    from check_oracle import compare, duck
    from folioloom.llm.queries import ORACLES, QUERIES

    con = duck(SF)
    for name, sql in ORACLES.items():
        problem, rows = compare(spark, con, SF, QUERIES[name], sql)
        assert problem is None and rows > 0, name
