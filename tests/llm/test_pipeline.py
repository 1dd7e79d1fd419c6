"""Each stage of the pipeline judged on its own input, by plain versions where there is one."""

from __future__ import annotations

import collections

import corpus_pipeline
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

from ridewell.llm import secrets

SF = "/root/testdata/sf0.001"
#: Columns whose names stages might use themselves.
MORE = ("language_told", "told", "row", "mix", "mix_at", "kept_row", "size", "node")


def kept_by_brute_force(rows):
    """Least doc_id of each group of texts linked by five-word shingles at 0.8."""
    def shingles(text):
        words = (text or "").lower().split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets = {r.doc_id: shingles(r.text) for r in rows}
    part = {d: d for d in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    while any(part[a] != part[b] for a, b in links):
        for a, b in links:
            part[a] = part[b] = min(part[a], part[b])
    return {d for d in sets if part[d] == d}


def test_stages(spark):
    docs, rows = spark.read.parquet(f"{SF}/documents.parquet").withColumns({c: F.lit(c) for c in MORE}), []
    columns = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SF)
        rows.append((name, docs.collect()))
        docs = spark.createDataFrame(rows[-1][1], docs.schema)
        assert i == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
    by = dict(rows)
    assert [n for n, _ in rows] == ["language_id", "ngram_jaccard_join", "secret_scan", "source_mixing", "sentencepiece"]
    assert len(by["language_id"]) >= len(by["ngram_jaccard_join"]) == len(by["secret_scan"]) > 0
    assert {r.doc_id for r in by["ngram_jaccard_join"]} == kept_by_brute_force(by["language_id"])
    assert not any(secrets.find(r.text) for r in by["secret_scan"])
    drawn = collections.Counter(r.doc_id for r in by["source_mixing"])
    assert set(drawn) <= {r.doc_id for r in by["secret_scan"]} and max(drawn.values()) <= 2
    assert collections.Counter(r.doc_id for r in by["sentencepiece"]) == drawn
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text for r in by["source_mixing"]}
    assert all(r.ids == library.encode(texts[r.doc_id]) for r in by["sentencepiece"])
    assert all(r[c] == c for r in by["source_mixing"] for c in MORE)


def test_stages_take_empty_tables(spark):
    docs = spark.createDataFrame([], spark.read.parquet(f"{SF}/documents.parquet").schema)
    for _, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, SF)
        assert made.count() == 0
        docs = spark.createDataFrame([], made.schema)
