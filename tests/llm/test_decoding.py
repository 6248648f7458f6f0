import base64
import bz2
import gzip
import hashlib
import lzma
import re
import time
import zlib
from urllib.parse import quote

import pytest
from brute import edges, empty, sources

from flakeform.llm.decoding import KINDS, all_spans, base_spans, joined, redact, scan_secrets


def plain(text):
    """The contract's patterns, matched as stated and filtered afterwards."""
    found = [(m.start(), m.end(), "assign") for m in re.finditer(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
    found += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


@pytest.mark.parametrize("make", [edges, sources])
def test_base_spans(spark, make):
    docs = make(spark)
    want = sorted((-1 if r["doc_id"] is None else r["doc_id"], joined(plain(r["text"] or ""))) for r in docs.select("doc_id", "text").collect())
    got = scan_secrets(docs).collect()
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], joined([(s["start"], s["end"], s["kind"]) for s in r["base"]])) for r in got) == want
    for r in got:
        assert {tuple(s) for s in r["base"]} <= {tuple(s) for s in r["spans"]}


SECRET = "password=hunter22hunter"
LAYERS = {
    "url": lambda s: "".join(f"%{b:02X}" for b in s.encode()),
    "url_part": lambda s: quote(s),
    "unicode": lambda s: "".join(f"\\u{ord(c):04x}" for c in s),
    "entity": lambda s: "".join(f"&#{ord(c)};" for c in s),
    "base64": lambda s: base64.b64encode(s.encode()).decode(),
    "urlsafe": lambda s: base64.urlsafe_b64encode(s.encode()).decode().rstrip("="),
    "gzip": lambda s: base64.b64encode(gzip.compress(s.encode())).decode(),
    "zlib": lambda s: base64.b64encode(zlib.compress(s.encode())).decode(),
    "bz2": lambda s: base64.b64encode(bz2.compress(s.encode())).decode(),
    "xz": lambda s: base64.b64encode(lzma.compress(s.encode())).decode(),
}


@pytest.mark.parametrize("outer", LAYERS)
@pytest.mark.parametrize("inner", LAYERS)
def test_nested_layers_map_back(outer, inner):
    token = LAYERS[outer](LAYERS[inner](SECRET))
    text = f"some é words {token} and more"
    start = text.index(token)
    found = [s for s in all_spans(text) if s[2] == "assign"]
    assert (start, start + len(token)) in {(a, b) for a, b, _ in found}


COMPRESS = {"gzip": gzip.compress, "zlib": zlib.compress, "bz2": bz2.compress, "xz": lzma.compress}


def assigned(token, before="some é words ", after=" and more"):
    """Whether the whole token is found to hide an assignment."""
    return (len(before), len(before) + len(token), "assign") in all_spans(before + token + after)


@pytest.mark.parametrize("mark", ["\u00a0", "\u3000", "\ufeff", "\u200b", "\u00ad", "\x00"])
def test_layers_with_unprintable_characters(mark):
    text = f"{mark}note {SECRET}"
    assert [k for *_, k in all_spans(base64.b64encode(text.encode()).decode())] == ["assign"]
    assert assigned(base64.b64encode(gzip.compress(text.encode())).decode())
    assert not all_spans(base64.b64encode(b"\1\2\3\4" * 20 + SECRET.encode()).decode())


@pytest.mark.parametrize("outer", COMPRESS)
@pytest.mark.parametrize("inner", COMPRESS)
def test_archives_in_archives_and_joined_members(outer, inner):
    data = SECRET.encode()
    assert assigned(base64.b64encode(COMPRESS[outer](COMPRESS[inner](data))).decode())
    assert assigned(base64.b64encode(COMPRESS[outer](b"first ") + COMPRESS[inner](b"and " + data)).decode())
    deep = data
    for _ in range(300):
        deep = COMPRESS[inner](deep)
    assert assigned(base64.b64encode(deep).decode())


@pytest.mark.parametrize("line_end", ["\n", "\r\n", "\n  "])
@pytest.mark.parametrize("before,after", [("", ""), ("key: ", " end"), ("a line\n", "\nAnd more words"), ("internationalisation\n", "\nword")])
def test_wrapped_base64(line_end, before, after):
    noise = "".join(hashlib.sha256(bytes([i])).hexdigest() + " " for i in range(20)).replace("a", "Z")
    for data in (f"{noise}{SECRET} {noise}".encode(), SECRET.encode() * 4):
        for body in (gzip.compress(data), data):
            plain = base64.b64encode(body).decode()
            token = line_end.join(plain[i : i + 76] for i in range(0, len(plain), 76))
            found = [s for s in all_spans(before + token + after) if s[2] == "assign"]
            assert found and all(len(before) <= a < b <= len(before + token) for a, b, _ in found if body is not data)
    inner = "x" * 100 + f" {SECRET} " + "y" * 100
    plain = base64.b64encode(inner.encode()).decode()
    token = line_end.join(plain[i : i + 76] for i in range(0, len(plain), 76))
    place = lambda i: i + i // 76 * len(line_end)
    want = (len(before) + place(101 * 4 // 3), len(before) + place(-(-(101 + len(SECRET)) * 4 // 3) - 1) + 1, "assign")
    assert want in all_spans(before + token + after)


def test_large_expansion_is_scanned_in_blocks(monkeypatch):
    from flakeform.llm import decoding

    monkeypatch.setattr(decoding, "BLOCK", 1 << 16)
    monkeypatch.setattr(decoding, "OVERLAP", 1 << 10)
    for place in (0, 65_530, 3_000_000):
        data = b"." * place + SECRET.encode() + b"\n" * (6_000_000 - place)
        for outer in COMPRESS:
            assert assigned(base64.b64encode(COMPRESS[outer](data)).decode())
            assert assigned(base64.b64encode(COMPRESS[outer](gzip.compress(data))).decode())


def test_spans_are_exact_inside_a_layer():
    inner = f"xx {SECRET} yy"
    token = LAYERS["url"](inner)
    assert (3 * 3, 3 * (3 + len(SECRET)), "assign") in all_spans(token)
    token = LAYERS["unicode"](inner)
    assert (6 * 3, 6 * (3 + len(SECRET)), "assign") in all_spans(token)


@pytest.mark.parametrize("deep", ["%" + "25" * 150_000 + "41", "&#38;" + "#38;" * 75_000, "\\u005c" + "u005c" * 50_000, "%25" * 100_000])
def test_deep_escapes_take_the_time_of_a_few_layers(deep):
    began = time.process_time()
    assert all_spans(f"{deep} {SECRET}")
    assert time.process_time() - began < 20  # seconds on a slow machine; a scan for every depth would take hours


def test_secrets_under_deep_escapes_map_back():
    for _ in range(2):
        token = SECRET.replace("p", "%" + "25" * 40 + "70", 1).replace("=", "&#38;#38;#38;#38;#38;#38;#38;#61;")
        text = f"some é words {token} and more"
        start = text.index(token)
        assert (start, start + len(token), "assign") in all_spans(text)


@pytest.mark.parametrize("noise", [b"\xff", b"\xc3", b"\xe2\x82", b"\x80\x80"])
def test_bytes_that_are_no_text_hide_nothing(noise):
    data = b"some words " + noise + b" and " + SECRET.encode() + b" after"
    token = base64.b64encode(data).decode()
    place = 5 + (data.index(SECRET.encode()) * 4) // 3
    found = [s for s in all_spans(f"text {token} end") if s[2] == "assign"]
    assert found and abs(found[0][0] - place) <= 3 and found[0][1] < 5 + len(token)
    assert assigned(base64.b64encode(gzip.compress(data)).decode())
    escaped = "".join(f"%{b:02X}" for b in data)
    at = 3 * data.index(SECRET.encode())
    assert (at, at + 3 * len(SECRET), "assign") in all_spans(escaped)
    assert not all_spans(base64.b64encode(bytes(range(128, 256)) * 3).decode() + " x")


@pytest.mark.parametrize("encoding", ["utf-16", "utf-16-le", "utf-16-be"])
def test_wide_text(encoding):
    data = f"Some words and {SECRET} 🙂 after".encode(encoding)
    assert [k for *_, k in all_spans(base64.b64encode(data).decode())] == ["assign"]
    assert assigned(base64.b64encode(gzip.compress(data)).decode())


def test_a_long_token_that_a_block_cuts(monkeypatch):
    from flakeform.llm import decoding

    monkeypatch.setattr(decoding, "BLOCK", 1 << 16)
    monkeypatch.setattr(decoding, "OVERLAP", 1 << 8)
    noise = "".join(hashlib.sha256(bytes([i % 256, i >> 8])).hexdigest() + "\n" for i in range(400))
    token = base64.b64encode(f"{noise} {SECRET} {noise}".encode()).decode()
    assert 1 << 15 < len(token) < 1 << 17
    long = base64.b64encode(zlib.compress(noise.encode() * 3 + SECRET.encode())).decode()
    for before in (10, 40_000, 65_000):
        data = ". " * (before // 2) + long + " ." * 60_000
        assert assigned(base64.b64encode(gzip.compress(data.encode())).decode())


def test_fixpoint_ends_on_odd_input():
    for text in ("%25" * 2000, "%2525252525", "QUFB" * 500, "\\u005cu005cu005c", "&#38;#38;#38;", base64.b64encode(b"x" * 20).decode() * 3, "%", "\\u", "&#"):
        assert all_spans(text) is not None
    deep = SECRET
    for _ in range(8):
        deep = base64.b64encode(deep.encode()).decode()
    assert [k for *_, k in all_spans(deep) if k == "assign"]


def test_letters_in_either_case_are_ascii():
    assert base_spans("PassWord: abcdef") and not base_spans("ſecret=abcdefgh") and not base_spans("secret=abcde")


def test_redaction(spark):
    docs = spark.createDataFrame([(1, f"a {SECRET} b", 3), (2, None, 4), (3, "clean", 5), (4, f"x {LAYERS['gzip'](SECRET)} y", 9)], "doc_id long, text string, n_chars long")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in redact(docs).collect()}
    assert got[1] == ("a [assign] b", 12) and got[2] == (None, 4) and got[3] == ("clean", 5)
    assert "[assign]" in got[4][0] and hashlib.sha256(b"").hexdigest()


def test_empty_and_columns(spark):
    assert scan_secrets(empty(spark)).count() == 0
    docs = edges(spark)
    assert redact(docs).columns == docs.columns and redact(docs).count() == docs.count()
