"""The pipeline's stages on the smallest data, each against a plain version on its own input."""

import collections

from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import brute
from tradeloom.llm import mixing, packing, quality_ledger
from tradeloom.llm import queries as q
from tradeloom.llm.common import keep


def test_stages(spark, small_data):
    docs = spark.read.parquet(f"{small_data}/documents.parquet")
    columns, inputs = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        made = keep(stage(spark, docs, small_data), "test")
        inputs[name] = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()], made
        if name != corpus_pipeline.STAGES[-1][0]:
            assert made.columns == columns
        docs = made

    rows, made = inputs["quality rules"]
    failed = {r.doc_id: r.failed for r in quality_ledger.evaluate(spark.read.parquet(
        f"{small_data}/documents.parquet")).collect()}
    kept = {r.doc_id for r in made.collect()}
    assert kept == {d for d, f in failed.items() if not f} and 100 < len(kept) < len(rows)

    rows, made = inputs["exact dedup"]
    last = {}
    for d, t, _ in rows:
        last[t] = max(d, last.get(t, d))
    assert sorted(r.doc_id for r in made.collect()) == sorted(last.values())

    rows, made = inputs["near dedup"]
    named = brute.near([r[:2] for r in rows], 5, 80)
    assert sorted(r.doc_id for r in made.collect()) == sorted(d for d, _, c in named if d == c)

    rows, made = inputs["mixing"]
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(brute.words(t))
    targets = brute.source_targets(sizes)
    taken = collections.Counter(r.doc_id for r in made.collect())
    assert max(taken.values()) <= mixing.MOST
    whole = sum(len(brute.words(t)) * taken[d] for d, t, _ in rows)
    assert abs(whole - sum(targets.values())) <= 0.25 * sum(targets.values())

    rows, made = inputs["packing"]
    library = Tokenizer.from_file(q.tokenizer_file())
    tokens = sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for _, t, _ in rows)
    got = made.collect()
    assert sum(r.length for r in got) == tokens
    assert len({r.sequence_id for r in got}) <= -(-tokens // packing.CAPACITY) + 2
