import hashlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rentlens.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "", " ", "Hello world's  it'll\n\n x", "<|endoftext|>a<|endoftext|><|endoftext|> b", "aaaaaaa aaaa", "é" * 40, "漢字かな テスト", " " * 300,
    "tab\tand\x0bvt\x85nel em", "ab" * 2000, "x" * 5000, "😀 emoji😀😀 1²³½ 123", "\x00\x1c\x1d", "The cat. " * 500,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_equal_the_library(library):
    got = bpe.ByteBpe(PATH).encode(TEXTS)
    assert [g.tolist() for g in got] == [e.ids for e in library.encode_batch(TEXTS, add_special_tokens=False)]


def test_every_code_point(library):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"x{c}1 {c}{c} y" for c in points[i : i + 400]) for i in range(0, len(points), 4000)]
    got = bpe.ByteBpe(PATH).encode(texts)
    assert [g.tolist() for g in got] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_decode_part_of_a_letter(library):
    ids = [e.ids for e in library.encode_batch(["漢字", "é"], add_special_tokens=False)]
    cut = [np.array(i[:-1], "<u4") for i in ids]
    assert bpe.ByteBpe(PATH).decode(cut) == [library.decode(i[:-1], skip_special_tokens=False) for i in ids]


def test_unknown_id():
    with pytest.raises(ValueError):
        bpe.ByteBpe(PATH).decode([np.array([60_000], "<u4")])


def test_word_table_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    coder = bpe.ByteBpe(PATH)
    one = coder.encode(["one two three four"])[0].tolist()
    assert coder.encode(["five"]) and len(coder.words) < 5
    assert coder.encode(["one two three four"])[0].tolist() == one


def test_frames(docs, library):
    df = docs([(i, t) for i, t in enumerate(TEXTS)] + [(99, None), (None, "no id"), (3, TEXTS[3])])
    rows = bpe.decode(bpe.encode(df, PATH), PATH).withColumn("n", bpe.token_count()).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"], r["ids"], r["decoded"])
    assert sorted(map(key, rows), key=str) == sorted(map(key, bpe.round_trip(df, PATH).collect()), key=str)
    assert len(rows) == len(TEXTS) + 3
    for r in rows:
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == want and r["n"] == len(want)
        assert r["decoded"] == (r["text"] or "") and r["_keep"] == "extra"
    assert bpe.decode(bpe.encode(df.limit(0), PATH), PATH).count() == 0


def test_digest_is_of_little_endian_words(docs, library):
    row = bpe.encode(docs([(1, "ab cd")]), PATH).selectExpr("sha2(ids, 256) AS h").first()
    assert row["h"] == hashlib.sha256(np.array(library.encode("ab cd").ids, "<u4").tobytes()).hexdigest()


def test_rows_of_short_words_merge_as_the_rounds_by_rank():
    coder = bpe.ByteBpe(PATH)
    r = np.random.default_rng(11)
    words = sorted({"".join(r.choice([*"aeitnhs A.é", "the", "ing"], r.integers(1, 33))) for _ in range(3000)} | {"a" * n for n in range(1, 70)})
    raw = [w.encode() for w in words]
    first = np.zeros(sum(map(len, raw)), bool)
    first[np.cumsum([0, *map(len, raw[:-1])])] = True
    symbols = coder.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
    alive = coder.merge(symbols, first)
    ids, counts = coder.encode_words(words)
    assert ids.tolist() == symbols[alive].tolist()
    assert counts.tolist() == np.add.reduceat(alive.astype(int), np.flatnonzero(first)).tolist()


def test_new_words_take_rounds_by_their_length_not_by_their_pairs(monkeypatch):
    coder = bpe.ByteBpe(PATH)
    calls, look_up = [], coder.pair_ranks
    monkeypatch.setattr(coder, "pair_ranks", lambda *pairs: calls.append(len(pairs[0])) or look_up(*pairs))
    r = np.random.default_rng(12)
    words = sorted({"".join(r.choice([*"abcdefghijklmnopqrstuvwxyz"], 12)) for _ in range(2000)})
    coder.encode([" ".join(words)])
    assert len(calls) < 200
