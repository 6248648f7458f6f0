import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pytest
from brute import edges, empty, sources
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from flakeform.llm import packing
from flakeform.llm.packing import BestFit, WordEncoder, pack, pack_documents, tokenizer_path

WHOLE = Tokenizer.from_file(tokenizer_path())


def ids(text):
    return [*WHOLE.encode(text or "", add_special_tokens=False).ids, 0]


ODD = ["", " ", "don't we'll I'm 's", "ÉCOLE Straße İstanbul ΣΑΣ", "a b c\x1cd\x85e", "é ́x", "漢字 かな 🙂👍🏽", "<|endoftext|> x<|startoftext|>y <|x", "<|ENDOFTEXT|> <|EndOfText|> x a<|ENDOFTEXT|>b A<|endoftext|>B", "X<|StartOfText|><|startoftext|>Y <|END <| |> Plain", "a,b...c!? (d) [e] #$%&*|<>", "x1y22 3.14", "tab\tnl\nvt\x0bff\fcr\r", "é" * 50, "AbC" * 200, "​ zero", "ﬁ ligature ² ½"]


def test_encoder_equals_the_tokenizer(spark):
    encoder = WordEncoder(tokenizer_path())
    texts = ODD + [r["text"] for r in sources(spark).collect()]
    for text, data in zip(texts, encoder.encode([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(data, "<u4").tolist() == ids(text)


def test_two_generations_of_words(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 40)
    encoder = WordEncoder(tokenizer_path())
    texts = [f"common words, stay here! rare{k} seldom-{k} é{k} abc{'x' * (k % 30)} {'yz' * (k % 20)}?" for k in range(300)]
    for text in texts:
        (data,) = encoder.encode([text.encode()])
        assert np.frombuffer(data, "<u4").tolist() == ids(text)
        assert len(encoder.words) <= 40 and len(encoder.earlier) <= 40
    assert b"common" in encoder.words and b"rare3" not in encoder.words | encoder.earlier


def test_texts_without_words():
    encoder = packing.encoder(tokenizer_path())
    for texts in ([], [b""], [b"", b" \t\n"], [b"", b"a", b""]):
        assert [np.frombuffer(data, "<u4").tolist() for data in encoder.encode(texts)] == [ids(t.decode()) for t in texts]


def test_repeated_words_are_looked_up_once_and_are_no_objects_each():
    """Of three million characters, only the distinct words become Python objects."""
    encoder, text = WordEncoder(tokenizer_path()), b"Some few words that repeat. " * 108_000
    looked_up = []
    assert list(encoder.encode([b"some"]))  # imports come first
    encoder.learn = lambda words, learn=encoder.learn: (looked_up.extend(words), learn(words))
    tracemalloc.start()
    (data,) = encoder.encode([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert zlib.crc32(data) == zlib.crc32(np.array([*ids("Some few words that repeat.")[:-1] * 108_000, 0], "<u4").tobytes())
    assert sorted(set(looked_up) - {b""}) == [b"few", b"repeat.", b"some", b"that", b"words"]
    assert len(looked_up) == len(set(looked_up))
    assert peak < 4 * len(text) + len(data)


def test_byte_letters_are_those_of_the_vocabulary():
    rules = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    for letter in [chr(n) for n in range(ord("a"), 256) if packing._SIMPLE.fullmatch(f"{chr(n)}\n")[1]]:
        assert packing.byte_letters(f"b{letter}c") == rules.pre_tokenize_str(f"b{letter}c")[0][0]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_encoder_on_any_text(text):
    encoder = packing.encoder(tokenizer_path())
    (data,) = encoder.encode([text.encode()])
    assert np.frombuffer(data, "<u4").tolist() == ids(text)


def check_places(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


@pytest.mark.parametrize("make", [edges, sources])
def test_pieces_and_places(spark, make):
    docs = make(spark)
    rows = pack_documents(docs).collect()
    sequences = check_places(rows, 2048)
    total = sum(r["length"] for r in rows)
    assert sequences <= -(-total // 2048) * 1.1 + 1
    got = defaultdict(list)
    for r in rows:
        got[(r["doc_id"], r["copy"])].append(r)
    want = []
    for r in docs.select("doc_id", "text").collect():
        data = np.array(ids(r["text"]), "<u4")
        want.append((r["doc_id"] or -1, tuple((k, k * 2048, min(2048, len(data) - k * 2048), zlib.crc32(data[k * 2048 : (k + 1) * 2048].tobytes())) for k in range(-(-len(data) // 2048)))))
    found = [(doc or -1, tuple((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in sorted(rs, key=lambda r: r["piece"]))) for (doc, _), rs in got.items()]
    assert sorted(found) == sorted(want)


@given(st.lists(st.integers(1, 50), max_size=300), st.integers(1, 6))
def test_best_fit(sizes, most):
    """Against a plain list of open bins: the fullest with room; the fullest closes first."""
    fit, open_, made = BestFit(50, most), [], 0
    used = defaultdict(int)
    for size in sizes:
        number, offset = fit.put(size)
        assert offset == used[number] and used[number] + size <= 50
        room = [free for _, free in open_ if free >= size]
        if room:
            assert 50 - used[number] == min(room)
            open_.remove((number, 50 - used[number]))
        else:
            assert number == made
            made += 1
            if size < 50 and len(open_) >= most:
                free = min(free for _, free in open_)
                held = set(fit.still_open())
                gone = [x for x in open_ if x[0] not in held and x[1] == free]
                open_.remove(gone[0])
        used[number] += size
        if used[number] < 50:
            open_.append((number, 50 - used[number]))
        assert fit.still_open() == {n: 50 - f for n, f in open_}


def test_levels_merge_open_bins(spark, monkeypatch):
    monkeypatch.setattr(packing, "PIECES_PER_PACKER", 60)
    parts = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit(0).cast("long").alias("copy"), F.lit(0).alias("piece"), (F.pmod(F.xxhash64("id"), F.lit(900)) + 1).alias("length"))
    counts = [check_places(pack(parts, levels=k).collect(), 2048) for k in (1, 2)]
    least = parts.agg(F.sum("length")).first()[0] / 2048
    assert counts[1] < counts[0] and counts[1] < 1.06 * least


def test_empty(spark):
    assert pack_documents(empty(spark)).count() == 0
