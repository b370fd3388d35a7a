"""Languages, vocabularies and token ids on small fixtures."""

import random
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textgrove.operators import language as L
from textgrove.operators import tokens as K

TEXTS = [
    (1, "the cat and the dog walk in the garden", "en"),
    (2, "the house is on the hill and the road", "en"),
    (3, "der Hund und die Katze gehen durch den Garten", "de"),
    (4, "das Haus steht auf dem Berg und die Strasse", "de"),
]


def docs(spark):
    return spark.createDataFrame(TEXTS, "id int, text string, lang string")


def test_detect(spark):
    new = [(1, "the dog and the road"), (2, "der Hund und das Haus"), (3, ""), (4, "12 34"), (5, None), (6, "漢字")]
    rows = spark.createDataFrame(new, "id int, text string")
    got = {r["id"]: r["detected"] for r in L.detect(rows, L.build_profiles(docs(spark))).collect()}
    assert got == {1: "en", 2: "de", 3: "en", 4: "en", 5: "en", 6: "en"}


def test_large_profiles_are_joined_with_equal_results(spark):
    rows, profiles = docs(spark).drop("lang"), L.build_profiles(docs(spark))
    sent = L.detect(rows, profiles).collect()
    joined = L.detect(rows, profiles, max_bytes=0).collect()
    assert sorted(sent) == sorted(joined) and {r["detected"] for r in joined} == {"en", "de"}


def test_stop_words_are_cut_like_texts(spark):
    row = spark.createDataFrame([("they've said we'll go home", "en")], "text string, lang string")
    kept = row.select(L.content_words(F.col("text"), F.col("lang"), L.default_stop_words()).alias("w")).first()["w"]
    assert "ve" not in kept and "ll" not in kept and "home" in kept


def test_trigrams(spark):
    r = spark.createDataFrame([("a",), ("abc",), ("𝒳y",)], "w string").select(L.trigrams(F.col("w"))).collect()
    assert [x[0] for x in r] == [["_a_"], ["_ab", "abc", "bc_"], ["_𝒳y", "𝒳y_"]]


def test_route(spark):
    rows = spark.createDataFrame([("en", "fr"), (None, "ja"), (None, "xx"), (None, None)], "g string, d string")
    got = [tuple(r[0]) for r in rows.select(L.route(F.col("g"), F.col("d"))).collect()]
    assert got == [("en", "model", True), ("ja", "fallback", True), ("xx", "fallback", False), ("en", "model", True)]


def test_multilingual(spark):
    rows = spark.createDataFrame(
        [(1, "The dogs, the cats!", "en"), (2, "It's <b>x</b>", "xx"), (3, "the", "en"), (4, None, "en")],
        "id int, text string, lang string",
    )
    lemmas = spark.createDataFrame([("en", "dogs", "dog"), ("de", "cats", "no")], "lang string, word string, lemma string")
    got = L.preprocess(rows, multilingual=True, lang="lang", stop_words={"en": ["the"]}, lemmas=lemmas)
    assert {r["id"]: r["text"] for r in got.collect()} == {1: "dog cats", 2: "it is x", 3: "", 4: ""}
    plain = L.preprocess(rows, multilingual=True, lang="lang", stop_words={"en": ["the"]})
    assert {r["id"]: r["text"] for r in plain.collect()} == {1: "dogs cats", 2: "it is x", 3: "", 4: ""}


def test_default_stop_words(spark):
    lists = L.default_stop_words()
    assert "the" in lists["en"] and "und" in lists["de"] and "zh" not in lists


def vocabulary(spark, tokens):
    rows = [(t, i) for i, t in enumerate([*K.SPECIALS.values(), *tokens])]
    return spark.createDataFrame(rows, "token string, id int")


def brute_force(word, table):
    """Longest match at each place, found by trying all parts."""
    ids, rest, mark = [], word, ""
    while rest:
        fits = [p for p in (rest[:n] for n in range(len(rest), 0, -1)) if mark + p in table]
        if not fits or len(word) > 100:
            return [1]
        ids.append(table[mark + fits[0]])
        rest, mark = rest[len(fits[0]):], "##"
    return ids


def test_word_pieces_by_brute_force(spark):
    table = K.vocabulary_ids(vocabulary(spark, ["un", "##aff", "##able", "##a", "u", "a", "##b", "able"]))
    words = ["unaffable", "unable", "able", "uaab", "x", "unx", "u" * 101, "un"]
    rows = spark.createDataFrame([(w,) for w in words], "word string")
    got = {r["word"]: r["ids"] for r in K.word_pieces(rows, table).collect()}
    assert got == {w: brute_force(w, table) for w in words}
    text = spark.createDataFrame([(" ".join(words),), ("",), (None,)], "text string")
    encoded = [r["ids"] for r in K.encode(text, table).collect()]
    assert encoded == [sum((brute_force(w, table) for w in words), []), [], []]


def test_vocabulary_file(spark, tmp_path):
    path = tmp_path / "vocab.txt"
    path.write_text("[PAD]\na\nb\na\n", encoding="utf-8")
    assert K.vocabulary_ids(K.load_vocabulary(spark, str(path))) == {"[PAD]": 0, "b": 2, "a": 3}
    out = str(tmp_path / "out")
    K.save_vocabulary(vocabulary(spark, ["x", "y"]), out)
    assert K.vocabulary_ids(K.load_vocabulary(spark, out))["y"] == 6


def test_batches_have_one_length(spark):
    rows = spark.range(50).select("id", F.array_repeat(F.lit(7), (F.col("id") % 9 + 1).cast("int")).alias("input_ids"))
    got = K.pad_batches(rows, batch_size=8)
    per = got.groupBy("batch_id").agg(
        F.count("*").alias("n"),
        F.count_distinct(F.size("input_ids")).alias("lengths"),
        F.count_distinct(F.size("attention_mask")).alias("masks"),
    ).collect()
    assert sorted(r["n"] for r in per) == [2] + [8] * 6 and all(r["lengths"] == r["masks"] == 1 for r in per)
    same = got.filter(F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x) == F.col("id") % 9 + 1)
    assert same.count() == 50


def test_tokenize_truncates(spark):
    rows = spark.createDataFrame([(1, "a " * 600, 0), (2, "a", 1)], "id int, text string, label int")
    got = {r["id"]: r for r in K.tokenize(rows, vocabulary(spark, ["a"]), max_length=16).collect()}
    assert len(got[1]["input_ids"]) == 16 and got[1]["input_ids"][0] == 2 and got[1]["input_ids"][-1] == 3
    assert got[2]["input_ids"] == [2, 5, 3] + [0] * 13 and got[2]["attention_mask"] == [1] * 3 + [0] * 13
    assert set(got[1].asDict()) == {"id", "input_ids", "attention_mask", "labels", "batch_id"}


def test_long_words_count_in_full(spark, monkeypatch):
    """Ends longer than those counted at once: as if all had been."""
    monkeypatch.setattr(K, "SHORT", 4)
    counts = spark.createDataFrame([("abcdefghij", 9), ("xbcdefghij", 5), ("short", 3), ("z" * 12, 1)], "word string, n long")
    got = {r["token"]: r["id"] for r in K.build_vocabulary(counts, 60).collect()}
    monkeypatch.setattr(K, "SHORT", 100)
    assert got == {r["token"]: r["id"] for r in K.build_vocabulary(counts, 60).collect()}
    assert "abcdefghij" in got and "##bcdefghij" in got
    words = K.word_pieces(counts, K.vocabulary_ids(K.build_vocabulary(counts, 60))).collect()
    assert {r["word"]: list(r["ids"]) for r in words}["abcdefghij"] == [got["abcdefghij"]]


@pytest.mark.parametrize("max_bytes", [1 << 20, 700, 0])
def test_lemmas_of_tables_of_any_size(spark, max_bytes):
    """Looked up in place; only the words that occur; joined: the same lemmas in the same order."""
    rows = spark.createDataFrame(
        [(1, "en", ["dogs", "and", "cats", "dogs"]), (2, "de", ["dogs"]), (3, None, ["dogs"]), (4, "en", []), (5, "en", ["same"])],
        "id long, lang string, tokens array<string>",
    )
    table = [("en", "dogs", "dog"), ("en", "dogs", "doge"), ("en", "cats", "cat"), ("en", "same", "same"), ("fr", "chiens", "chien")]
    table += [("en", f"word{i}", "word") for i in range(50)]
    lemmas = spark.createDataFrame(table, "lang string, word string, lemma string")
    got = {r["id"]: r["tokens"] for r in L.lemmatize(rows, lemmas, "id", max_bytes=max_bytes).collect()}
    assert got == {1: ["dog", "and", "cat", "dog"], 2: ["dogs"], 3: ["dogs"], 4: [], 5: ["same"]}


def test_batches_by_length(spark):
    rng = random.Random(8)
    rows = [(i, i % 2, [1] * rng.randint(1, 200)) for i in range(500)]
    table = spark.createDataFrame(rows, "id long, part int, input_ids array<int>").repartition(4)
    for by in ([], ["part"]):
        batched = K.length_batches(table, batch_size=16, by=by)
        found = batched.collect()
        assert sorted(r["id"] for r in found) == list(range(500)) and set(batched.columns) == {"id", "part", "input_ids", "batch_id", "attention_mask"}
        groups = {}
        for r in found:
            groups.setdefault((r["part"] if by else 0, r["batch_id"]), []).append(r)
        sizes = [len(g) for g in groups.values()]
        assert sizes.count(16) >= len(sizes) - max(1, 2 * len(by)) and max(sizes) == 16
        for g in groups.values():
            assert len({len(r["input_ids"]) for r in g}) == 1 and max(sum(r["attention_mask"]) for r in g) == len(g[0]["input_ids"])
        order = [max(sum(r["attention_mask"]) for r in groups[k]) for k in sorted(groups)]
        assert order != sorted(order)  # batches are not in order of length
        share = lambda b: K.padding_share(b).first()["padding"]
        assert share(batched) < share(K.pad_batches(table, batch_size=16, by=by)) / 3
    again = {r["id"]: r["batch_id"] for r in K.length_batches(table.repartition(7), batch_size=16).collect()}
    assert again == {r["id"]: r["batch_id"] for r in K.length_batches(table, batch_size=16).collect()}
    assert K.length_batches(table.limit(0), batch_size=16).count() == 0


def test_words_stay_in_arrow(spark, monkeypatch):
    """Chunks that end inside a row change nothing; of a batch only distinct words are Python strings."""
    table = K.vocabulary_ids(vocabulary(spark, ["a", "##a", "b", "##b", "ab"]))
    rng = random.Random(3)
    rows = [["".join(rng.choices("abc", [5, 5, 1], k=rng.randint(1, 6))) for _ in range(rng.randint(0, 9))] for _ in range(200)]
    look_up = K._look_up(spark, table, None).func
    monkeypatch.setattr(K, "CHUNK", 7)
    batches = [pa.array(rows)[:90], pa.array([], pa.list_(pa.string())), pa.array(rows)[90:]]
    got = [r for out in look_up(iter(batches)) for r in out.to_pylist()]
    assert got == [[i for w in row for i in brute_force(w, table)] for row in rows]
    monkeypatch.undo()
    many = pa.array([rows[i % 200] for i in range(1 << 18)])
    words = len(many.flatten())
    tracemalloc.start()
    found = sum(len(out) for out in look_up(iter([many])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == len(many) and peak < 60 * words


def test_a_vocabulary_is_built_once(spark):
    built = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            built.add(batch.num_rows)
            yield batch

    table = vocabulary(spark, ["a"]).mapInArrow(count, "token string, id int")
    assert len(K.vocabulary_ids(table)) == built.value == 6


def test_lemmas_of_nulls_and_in_chunks(spark, monkeypatch):
    rows = spark.createDataFrame(
        [(1, "en", ["dogs", None, "cats", "dogs"]), (2, "de", ["dogs", "cats"]), (3, None, ["dogs"]), (4, "en", None), (5, None, None), (6, "en", [])],
        "id long, lang string, tokens array<string>",
    ).coalesce(1)
    lemmas = spark.createDataFrame([("en", "dogs", "dog"), ("de", "cats", "cat"), (None, "dogs", "none")], "lang string, word string, lemma string")
    expected = {1: ["dog", None, "cats", "dog"], 2: ["dogs", "cat"], 3: ["none"], 4: [], 5: [], 6: []}
    monkeypatch.setattr(L, "CHUNK", 2)
    assert {r["id"]: r["tokens"] for r in L.lemmatize(rows, lemmas, "id").collect()} == expected
    monkeypatch.undo()
    assert {r["id"]: r["tokens"] for r in L.lemmatize(rows, lemmas, "id").collect()} == expected
