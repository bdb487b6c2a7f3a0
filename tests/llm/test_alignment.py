"""Token alignment against both libraries and a set of shared ends."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from rentlens.llm import token_alignment
from rentlens.llm.bpe import byte_letters
from rentlens.llm.common import prepare

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def by_hand(rows):
    first, second, letters = Tokenizer.from_file(BPE), sentencepiece.SentencePieceProcessor(model_file=PIECES), byte_letters()
    first.encode_special_tokens = True
    out, links = [], []
    for doc_id, text in rows:
        out.append((doc_id, 0, 0, 0, ""))
        links.append([])
        if not text:
            continue
        a, b = first.encode(" " + text, add_special_tokens=False), second.encode(text)
        raw_a = [bytes(letters[c] for c in t) for t in a.tokens]
        raw_b = [token_alignment.Aligner.piece_bytes(second.id_to_piece(i)) for i in b]
        if not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
            continue
        ends_a, ends_b = (dict(zip(np.cumsum([len(x) for x in raw]).tolist(), range(len(raw)))) for raw in (raw_a, raw_b))
        shared = sorted(set(ends_a) & set(ends_b))
        groups, i, j = [], 0, 0
        for e in shared:
            groups.append(",".join(map(str, a.ids[i : ends_a[e] + 1])) + "|" + ",".join(map(str, b[j : ends_b[e] + 1])))
            i, j = ends_a[e] + 1, ends_b[e] + 1
        out[-1] = (doc_id, len(raw_a), len(raw_b), len(shared), hashlib.sha256(";".join(groups).encode()).hexdigest())
        links[-1] = [(a.ids[ends_a[e]], b[ends_b[e]]) for e in shared]
    counts = Counter(x for some in links for x in some)
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [(d, na, nb, ng, len(some), sum(counts[x] == best[x[1]] for x in some), sum(counts[x] for x in some), sha) for (d, na, nb, ng, sha), some in zip(out, links)]


TEXTS = [
    None, "", " ", "a", "The quick brown fox.", "The quick brown fox.", "<|endoftext|> and <s> </s> <unk> as text", "naïve Été 漢字かな 🎉🎉 नमस्ते", "a▁b has the piece mark",
    "tabs\tand\nlines\r\n\r\n  spaces   ", "x" * 3000, "é combining, ﬁ ligature, Ａ full width", "word " * 4000, "<0x41> looks like a byte piece", "\u0000\u0007 control",
]


@pytest.mark.parametrize("size", [1, 1 << 23])
def test_against_the_libraries(spark, docs, monkeypatch, size):
    prepare(spark)
    monkeypatch.setattr(token_alignment, "BLOCK_BYTES", size)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (4, "The same id twice")]
    got = token_alignment.token_alignment(docs(rows, 2, ("block", "codes", "n_a")), BPE, PIECES).collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, got), key=order) == sorted(by_hand(rows), key=order)


def test_no_documents(spark, docs):
    prepare(spark)
    assert token_alignment.token_alignment(docs([]), BPE, PIECES).collect() == []


@pytest.mark.parametrize("seed", range(20))
def test_runs_are_skipped_right(seed):
    r = np.random.default_rng(seed)
    a = np.flatnonzero(r.random(2000) < 0.5) + 1
    share = r.choice([0.5, 0.99])
    b = np.array(sorted({*a[r.random(len(a)) < share].tolist(), *r.integers(1, 2000, r.integers(0, 50)).tolist()}))
    a, b = np.append(a, 2001), np.append(b, 2001)
    at_a, at_b = token_alignment.common_ends(a, b)
    shared = np.intersect1d(a, b)
    assert a[at_a].tolist() == b[at_b].tolist() == shared.tolist()


def test_stretches_around_the_first_windows_are_found_whole():
    import numpy as np

    from rentlens.llm.token_alignment import common_ends

    rng = np.random.default_rng(3)
    for length in [*range(1, 20), 31, 32, 33, 100, 1000]:
        for apart in (0, 1, 2):
            ends = np.cumsum(rng.integers(2, 5, 3 * length + 3))
            drop_a, drop_b = (rng.permutation(len(ends) - 1)[:apart] for _ in range(2))
            a, b = np.delete(ends, drop_a), np.delete(ends, drop_b)
            at_a, at_b = common_ends(a, b)
            np.testing.assert_array_equal(a[at_a], np.intersect1d(a, b))
            np.testing.assert_array_equal(b[at_b], np.intersect1d(a, b))


class Counted:
    """A piece model that adds up the characters it is asked to encode."""

    def __init__(self, model):
        self.model, self.characters = model, 0

    def encode(self, texts, num_threads):
        self.characters += sum(map(len, texts))
        return self.model.encode(texts, num_threads=num_threads)


def test_a_word_is_encoded_and_aligned_once(monkeypatch):
    walked, walk = [], token_alignment.common_ends
    monkeypatch.setattr(token_alignment, "common_ends", lambda a, b: walked.append(len(a)) or walk(a, b))
    tools = token_alignment.Aligner(BPE, PIECES)
    tools.b = Counted(tools.b)
    text = "Some words, and the same words again.\n" * 50
    first = tools.align([text] * 3)
    assert first[0] == first[2] and first[0][0] > 400
    assert tools.b.characters < 100 and sum(walked) < 30
    assert tools.align([text + "New"])[0][:3] == tuple(n + 1 for n in first[0][:3])
    assert tools.b.characters < 110


@pytest.mark.parametrize("units", [1, 1 << 20])
def test_units_of_odd_texts_against_the_libraries(monkeypatch, units):
    monkeypatch.setattr(token_alignment, "CACHE_UNITS", units)
    r = np.random.default_rng(7)
    parts = [*"ab cde \n\t .,'s1  23-_\r(){};é漢🎉  ́　ﬁ\x00\x1c<>|e t", "the", "ing", " and", "'re", "    ", "\n\n", ">\r", "();", "\r\n", "x" * 40]
    rows = [(i, "".join(r.choice(parts, r.integers(1, 60)))) for i in range(400)] + [(400, "a▁b"), (401, "a ▁"), (402, " " * 50)]
    wanted = sorted(by_hand(rows))
    tools, whole = token_alignment.Aligner(BPE, PIECES), token_alignment.Aligner(BPE, PIECES)
    whole.bonds = None  # as for a model whose tokens may depend on the whole text
    for start in range(0, len(rows), 50):
        texts = [t for _, t in rows[start : start + 50]]
        found = tools.align(texts)
        assert found == whole.align(texts)
        assert [(n_a, n_b, n, sha) for n_a, n_b, n, sha, _ in found] == [(w[1], w[2], w[3], w[-1]) for w in wanted[start : start + 50]]
        assert [len(codes) // 4 for *_, codes in found] == [w[4] for w in wanted[start : start + 50]]
    assert tools.bonds is not None
