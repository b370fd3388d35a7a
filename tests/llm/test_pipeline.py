"""The registered queries of the package and the pipeline."""

import re
from collections import Counter

import oracle
import pytest

import corpus_pipeline
from test_duplicates import WORD, close, groups, plain_fingerprint
from test_text_operators import plain_hits
from textgrove.llm import packing, quality_rules, queries
from textgrove.operators.scale import settle


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_agrees_with_sql(spark, duck, sf_dir, name):
    assert oracle.compare(spark, duck, queries.QUERIES[name], queries.SQL[name], sf_dir) is None


def test_one_query_for_each_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES if n != "pipeline")
    assert numbers == list(range(1, 14)) and "pipeline" in queries.QUERIES


def test_stages_take_effect(spark, docs, texts, sf_dir):
    """Each stage on what the stage before kept, held against brute force."""
    kept = {r["doc_id"] for r in quality_rules.rate(docs).filter("kept").collect()}
    rows = corpus_pipeline.quality(spark, docs, sf_dir)
    assert rows.columns == docs.columns and {r["doc_id"] for r in rows.collect()} == kept
    assert all(len(WORD.findall(texts[i])) >= 20 for i in kept)
    ids = sorted(kept)
    links = [(ids[a], ids[b]) for a, b in close([plain_fingerprint(texts[i]) for i in ids])]
    single = corpus_pipeline.near_duplicates(spark, rows, sf_dir)
    left = set(groups(links, ids).values())
    assert links and single.columns == docs.columns and sorted(r["doc_id"] for r in single.collect()) == sorted(left)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = corpus_pipeline.benchmark(spark, single, sf_dir)
    left = {i for i in left if not plain_hits(texts[i], items)[1]}
    assert clean.columns == docs.columns and {r["doc_id"] for r in clean.collect()} == left
    mixed = corpus_pipeline.mixture(spark, clean, sf_dir)
    times = Counter(r["doc_id"] for r in mixed.collect())
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    size = {i: len(WORD.findall(texts[i])) for i in left}
    total = Counter()
    for i in left:
        total[source[i]] += size[i]
    wanted = plain_targets(total)
    for name in total:
        taken = sum(times[i] * size[i] for i in left if source[i] == name)
        longest = max(size[i] for i in left if source[i] == name)
        assert abs(taken - wanted[name]) <= longest / 2 + 1e-6, name
    assert mixed.columns == docs.columns and set(times) <= left and max(times.values()) <= 3
    encode = packing.tokenizer()
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    found = Counter()
    for r in packed:
        for d, at, a, b in zip(r["doc_ids"], r["starts"], r["cu_seqlens"], r["cu_seqlens"][1:], strict=False):
            found[d, at, tuple(r["input_ids"][a:b])] += 1
    want = Counter()
    for i, n in times.items():
        numbers = [*encode(texts[i]).tolist(), packing.END]
        for at in range(0, len(numbers), packing.LENGTH):
            want[i, at, tuple(numbers[at : at + packing.LENGTH])] += n
    assert found == want


def plain_targets(total, weights=(5, 2, 1), most=3):
    """Shares by weight, in order of names; what a source cannot take goes to the others."""
    weight = {s: weights[k % 3] for k, s in enumerate(sorted(total))}
    words, full = sum(total.values()), {}
    while True:
        rest = [s for s in total if s not in full]
        rate = (words - sum(full.values())) / sum(weight[s] for s in rest) if rest else 0
        over = [s for s in rest if weight[s] * rate > most * total[s]]
        if not over:
            return full | {s: weight[s] * rate for s in rest}
        full |= {s: most * total[s] for s in over}


def test_odd_and_empty_documents(spark, odd, empty, docs, sf_dir, tmp_path):
    """Null, blank, repeated and very long texts beside clean ones, clashing columns, empty tables."""
    good = docs.select("doc_id", "text", "source").join(odd.drop("doc_id", "text", "source").limit(1))
    for k, table in enumerate((odd.union(good), odd, empty)):
        table.write.parquet(f"{tmp_path}/{k}/documents.parquet")
        spark.read.parquet(f"{sf_dir}/benchmark.parquet").limit(5 if k else 0).write.parquet(f"{tmp_path}/{k}/benchmark.parquet")
        rows = spark.read.parquet(f"{tmp_path}/{k}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            rows = settle(stage(spark, rows, f"{tmp_path}/{k}"), "stage")
            assert rows.columns == odd.columns
        packed = corpus_pipeline.run(spark, f"{tmp_path}/{k}")
        assert (packed.count() > 0) == (k == 0)
        assert not rows.filter("text is null or length(text) < 20").count()
