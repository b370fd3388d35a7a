"""Rounding that strays beside 0 or 1."""

from pyspark.sql import functions as F

from textgrove.llm import mixing


def test_pivot_stays_between_zero_and_one():
    for key in range(50):
        out = mixing.pivot([(key, 11, 0.8877005347593583), (key + 1, 3, 7 / 17)])
        assert all(0 <= p <= 1 for p in out) and sum(0 < p < 1 for p in out) <= 1


def test_every_row_is_decided(spark):
    rows = [("a", 3, 1, -5.6e-17, 1), ("a", 3, 2, 1 + 2.3e-16, 1), ("a", 3, 3, 0.25, 1), ("a", 0, 4, 0.5, 1)]
    rows += [("b", 11, key, 0.8877005347593583, 1) for key in range(20)] + [("b", 3, key, 7 / 17, 1) for key in range(20, 40)]
    table = spark.createDataFrame(rows, "source string, size long, key long, p double, groups long")
    done = mixing._decide(table, 42).collect()
    assert sorted((r["source"], r["key"]) for r in done) == sorted((s, k) for s, _, k, _, _ in rows)
    assert all(int(r["p"]) in (0, 1) for r in done)


def test_repeated_rows(spark, monkeypatch):
    """9,000 equal rows beside others: one row of the rounding, copies shared evenly, no group above its size."""
    monkeypatch.setattr(mixing, "GROUP", 64)
    seen = []
    plain = mixing._decide

    def decide(rows, seed):
        seen.append(rows.filter("p > 0 and p < 1 and size > 0").groupBy("source", F.expr("pmod(key, groups)")).count().agg(F.max("count")).first()[0])
        return plain(rows, seed)

    monkeypatch.setattr(mixing, "_decide", decide)
    same = spark.range(9000).selectExpr("cast(1 as long) as doc_id", "'the same few words' as text", "'a' as source")
    other = spark.range(1000).selectExpr("id + 10 as doc_id", "concat('words of row ', id, ' ', repeat('x ', cast(id % 7 as int))) as text", "if(id < 500, 'a', 'b') as source")
    docs = same.union(other).repartition(6)
    rows = mixing.taken(docs).collect()
    assert len(rows) == 10000 and seen[0] < 150
    copies = [r["copies"] for r in rows if r["doc_id"] == 1]
    assert max(copies) - min(copies) <= 1
    for source in "ab":
        own = [r for r in rows if (r["doc_id"] == 1 or r["doc_id"] < 510) == (source == "a")]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own) / 2 + 1e-6
        assert own[0]["source_size"] == sum(r["size"] for r in own)
    mixed = mixing.mix(docs).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in mixed}[1] in (sum(copies), sum(copies) + 1, sum(copies) - 1)
