import itertools

import numpy as np
from brute import edges, empty
from pyspark.sql import functions as F

from flakeform.llm import language
from flakeform.llm.common import crc_fold


def test_posteriors_against_all_paths():
    draw = np.random.default_rng(0)
    sizes = np.array([3, 1, 4, 2])
    emission = draw.normal(size=(10, 3)).astype(np.float32)
    transitions = draw.normal(size=(3, 3)).astype(np.float32)
    pairs = np.zeros((3, 3), np.float32)
    got = language.posteriors(emission, sizes, transitions, pairs)
    want, want_pairs, at = [], np.zeros((3, 3)), 0
    for n in sizes:
        e = emission[at : at + n]
        at += n
        total, marginal, both = 0.0, np.zeros((n, 3)), np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            w = np.exp(sum(e[t, y] for t, y in enumerate(path)) + sum(transitions[a, b] for a, b in itertools.pairwise(path)))
            total += w
            for t, y in enumerate(path):
                marginal[t, y] += w
            for a, b in itertools.pairwise(path):
                both[a, b] += w
        want.append(marginal / total)
        want_pairs += both / total
    assert np.allclose(got, np.concatenate(want), atol=1e-5)
    assert np.allclose(pairs, want_pairs, atol=1e-4)


def trained(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = crc_fold(F.col("doc_id"), 4) == 2
    return docs, held, language.train(docs.filter(~held))


def test_held_out_accuracy_and_code_switching(spark):
    docs, held, model = trained(spark)
    rows = language.identify(docs.filter(held), model).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)
    # Staying in a language is likelier than any switch.
    assert (np.argmax(model.transitions, axis=1) == np.arange(len(model.languages))).all()
    text = {r["lang"]: r["text"].replace("\n", " ").split()[5:45] for r in docs.filter(held).filter("length(text) > 800").collect()}
    words = text["en"] + text["fr"] + text["en"]
    sizes = np.array([len(words)])
    label = np.argmax(language.posteriors(model.emissions(words), sizes, model.transitions), axis=1)
    want = [model.languages.index("en")] * 40 + [model.languages.index("fr")] * 40 + [model.languages.index("en")] * 40
    assert (label == np.array(want)).mean() > 0.9


def test_whole_long_words_are_read(spark):
    """Lines without spaces, which differ after 40 characters only, and outweigh short words by their length."""
    draw = np.random.default_rng(3)

    def line(alphabet, n):
        return "".join(draw.choice(list(alphabet), n))

    same = line("一二三四五", 40)
    table = [(i, same + line(letters, 400), lang) for i in range(60) for lang, letters in (("p", "山川田日月"), ("q", "人口手足目"))]
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string")
    model = language.train(docs.filter("doc_id < 40"))
    rows = language.identify(docs.filter("doc_id >= 40"), model).collect()
    assert len(rows) == 40 and all(r["lang"] == r["lang_pred"] and r["score"] > 0.8 for r in rows)
    mixed = spark.createDataFrame([(1, line("山川田日月", 4000) + "\n" + "\n".join(line("人口手足目", 3) for _ in range(20)))], "doc_id long, text string")
    assert [r["lang_pred"] for r in language.identify(mixed, model).collect()] == ["p"]
    word = "é" * 30 + "漢" * 100
    assert b"".join(language.byte_tokens([b"a", word.encode()])) == b"a" + word.encode()
    assert [t.decode() for t in language.byte_tokens([word.encode()])] == language.tokens([word])


def test_every_language_is_learned(spark):
    """More languages than 64, the rarest with two documents."""
    draw = np.random.default_rng(5)
    words = {f"l{x:02}": ["".join(draw.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(20)] for x in range(80)}
    table = [(10 * x + i, " ".join(draw.choice(own, 60)), lang) for x, (lang, own) in enumerate(words.items()) for i in range(2 + (x < 64))]
    model = language.train(spark.createDataFrame(table, "doc_id long, text string, lang string"))
    assert model.languages == sorted(words)
    new = [(x, " ".join(draw.choice(own, 40)), lang) for x, (lang, own) in enumerate(words.items())]
    rows = language.identify(spark.createDataFrame(new, "doc_id long, text string, lang string"), model).collect()
    assert all(r["lang"] == r["lang_pred"] for r in rows)


def test_sample_is_bounded_and_whole(spark):
    """One id, or few texts, over all rows; long texts are whole, and taken where there is no other."""
    one_id = spark.range(3000).select(F.lit(7).alias("doc_id"), F.concat(F.lit("word "), "id").alias("text"), F.lit("x").alias("lang"))
    assert [len(v) for v in language.training_sample(one_id).values()] == [language.SAMPLE_PER_LANGUAGE]
    same = spark.range(3000).select((F.col("id") % 3).alias("doc_id"), F.lit("same text").alias("text"), F.lit("x").alias("lang"))
    assert language.training_sample(same) == {"x": ["same text"] * 3}
    long = "long text " * 20_000
    table = [(i, long if i % 2 else f"short {i}", lang) for i in range(30) for lang in ("a", "b") if lang == "a" or i % 2]
    found = language.training_sample(spark.createDataFrame(table, "doc_id long, text string, lang string"), 15)
    assert sorted(found["a"]) == sorted(f"short {i}" for i in range(0, 30, 2)) and found["b"] == [long] * 15


def test_words_are_parted_alike_in_training_and_prediction(spark):
    """Only ASCII white space parts words."""
    text = {x: f"{x}a\u00a0{x}b\u3000{x}c\x1c{x}d\x85{x}e " * 30 for x in "pq"}
    seen = []
    original = language.word_features

    def features(words):
        seen.append(set(words))
        return original(words)

    language.word_features = features
    try:
        language.fit({x: [t] for x, t in text.items()})
    finally:
        language.word_features = original
    assert seen[0] == {w.decode() for t in text.values() for w in language.byte_tokens(t.encode().split())}
    assert any("\u00a0" in w for w in seen[0])


def test_edges_and_filter(spark):
    _, _, model = trained(spark)
    docs = edges(spark)
    rows = language.identify(docs, model).select("doc_id", "text", "lang_pred", "score").collect()
    assert len(rows) == docs.count()
    for r in rows:
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in model.languages
    kept = language.known_language(docs, model)
    assert kept.columns == docs.columns and kept.filter("text is null").count() == 0


def test_no_labels_and_no_rows(spark):
    _, _, model = trained(spark)
    assert language.identify(empty(spark), model).count() == 0
    none = language.train(empty(spark))
    assert {r["lang_pred"] for r in language.identify(edges(spark), none).collect()} == {"und"}
    one = language.train(spark.createDataFrame([(1, "some words", "xx")], "doc_id long, text string, lang string"))
    assert {r["lang_pred"] for r in language.identify(edges(spark).filter("doc_id = 1"), one).collect()} == {"xx"}
