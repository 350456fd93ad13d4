"""BPE and packing against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from llm_shared import docs, odd  # noqa: F401
from starloom.llm import bpe, packing as k

public_tokenizers = pytest.importorskip("public_tokenizers")
WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
LETTERS = "abcxyzABC é́Éß'sтк漢1２ \t\n\x1c\u0085　!?😀ﬁİ"


def texts(n, seed=2):
    r = random.Random(seed)
    made = []
    for _ in range(n):
        x = "".join(r.choice(LETTERS) for _ in range(r.randint(0, 25)))
        if r.random() < 0.2:
            x = x + r.choice(["<|endoftext|>", " <|startoftext|> ", "<|endoftext|> we'LL", "  ", "the end of it "]) + x
        made.append(x)
    return made


@pytest.fixture(scope="module")
def word_encoder():
    return bpe.encoder(WORD, bpe.lexicon_of(["the", "end", "of", "it", "abc", "ß", "c"], WORD))


def test_word_ids_equal_the_library(word_encoder):
    own = Tokenizer.from_file(WORD)
    for text in texts(4000):
        ids = own.encode(text, add_special_tokens=False).ids
        got = np.frombuffer(word_encoder.encode([text])[0], "<u4").tolist()
        assert got == ids, text
        assert word_encoder.coding.decode(got) == own.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("letters", ["a", "ab", "etaoinshrdlu", "漢字é", "!?-"])
def test_long_words_equal_the_library(word_encoder, letters):
    own, r = Tokenizer.from_file(WORD), random.Random(len(letters))
    for n in (bpe.LONG_WORD - 1, bpe.LONG_WORD, bpe.LONG_WORD + 1, 3_001, 20_000):
        text = "the " + "".join(r.choice(letters) for _ in range(n)) + " end"
        assert np.frombuffer(word_encoder.encode([text])[0], "<u4").tolist() == own.encode(text, add_special_tokens=False).ids


def test_a_very_long_word(word_encoder):
    r = random.Random(6)
    part = "".join(r.choice("etaoinshrdlu") for _ in range(200_000))
    ids = Tokenizer.from_file(WORD).encode(part, add_special_tokens=False).ids
    assert np.frombuffer(word_encoder.encode([part])[0], "<u4").tolist() == ids


def test_byte_ids_equal_the_library():
    own, mine = Tokenizer.from_file(BYTE), k.encoder(BYTE)
    for text in texts(4000, 3) + ["  a  b", "a \n b", " ", "a ", "\n\n a", "a\t b", "x" * 3000]:
        assert np.frombuffer(mine.ids(text), "<u4").tolist() == own.encode(text, add_special_tokens=False).ids, text


def test_transducer_is_minimal_and_finds_its_words_only():
    words = {w.encode(): [i, i + 1] for i, w in enumerate(["tap", "taps", "top", "tops", "stop", "stops", "é", ""])}
    lexicon = bpe.Lexicon(bpe.compile_lexicon(words))
    found = lexicon.find([*words, b"ta", b"tapss", b"zzz", b"st"])
    assert (found[: len(words)] >= 0).all() and (found[len(words) :] == -1).all()
    for word, number in zip(words, found):
        assert np.frombuffer(lexicon.ids_of(number), "<u4").tolist() == words[word]
    # t(a|o)p(s) and st + op(s): root, t, s, st, ta|to, tap = top = stop, end, two bytes of é
    assert lexicon.n_states == 8
    assert (bpe.Lexicon(bpe.compile_lexicon({})).find([b"a"]) == -1).all()


def test_digests(docs, odd):
    own = Tokenizer.from_file(WORD)
    rows = [(i, t) for i, t in enumerate(["The the END", "", None, "漢 <|endoftext|>é", "it " * 50])]
    frame = docs(*rows)
    words = bpe.frequent_words(frame, 10)
    assert words[0] == "it"
    block = bpe.lexicon_of(words, WORD)
    got = {r["doc_id"]: r for r in bpe.digests(frame, WORD, block).collect()}
    for i, text in rows:
        ids = own.encode(text or "", add_special_tokens=False).ids
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        decoded = own.decode(ids, skip_special_tokens=False)
        assert got[i]["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
    full = {r["doc_id"]: r for r in bpe.encode_decode(frame, WORD, block).collect()}
    assert full[0]["decoded"] == "the</w> the</w> end</w>"
    assert bpe.digests(odd, WORD, block).count() == 7
    assert bpe.digests(docs(), WORD, bpe.lexicon_of(bpe.frequent_words(docs()), WORD)).count() == 0


def check_packing(rows, tokens, capacity):
    per_doc, per_sequence = {}, {}
    for r in rows:
        per_doc.setdefault(r["doc_id"], []).append(r)
        per_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(per_doc) == set(tokens)
    for doc_id, ids in tokens.items():
        mine = sorted(per_doc[doc_id], key=lambda r: r["piece"])
        assert [r["piece"] for r in mine] == list(range(len(mine)))
        at = 0
        for r in mine:
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids) and all(r["length"] == capacity for r in mine[1:])
    for mine in per_sequence.values():
        at = 0
        for r in sorted(mine, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len(per_sequence)


@pytest.mark.parametrize("per_task", [1_000_000, 20])
def test_packing(docs, per_task):
    r = random.Random(6)
    own = Tokenizer.from_file(BYTE)
    rows = [(i, " ".join(r.choice(["one", "two", "éx", "33"]) for _ in range(r.choice([0, 3, 20, 90, 300])))) for i in range(150)]
    rows.append((1000, None))
    tokens = {i: np.array([*own.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for i, t in rows}
    got = k.pack(k.pieces(docs(*rows), BYTE, capacity=128), capacity=128, most=8, per_task=per_task).collect()
    used = check_packing(got, tokens, 128)
    least = -(-sum(map(len, tokens.values())) // 128)
    assert used <= 1.1 * least + 2


def test_the_fullest_bin_closes_first():
    packer = k.Packer(10, 2)
    assert packer.add("a", 6) == [] and packer.add("b", 5) == []
    assert packer.add("c", 7) == [[("a", 6)]]
    # best fit: into the bin with 3 free, not the one with 5
    assert packer.add("d", 3) == [[("c", 7), ("d", 3)]]
    assert packer.add("e", 10) == [[("e", 10)]]
    assert list(packer.rest()) == [[("b", 5)]]


def test_odd_rows_and_an_empty_table(odd, docs):
    got = k.pack(k.pieces(odd, BYTE)).collect()
    assert len(got) == 7 and len({r["sequence_id"] for r in got}) == 1
    assert k.pack(k.pieces(docs(), BYTE)).count() == 0


def test_pieces_of_exact_multiples():
    ids = np.arange(7, dtype="<u4").tobytes()
    assert [(p[1], p[2]) for p in k.cut(ids, 4)] == [(0, 4), (4, 4)]
    assert [(p[1], p[2]) for p in k.cut(ids + ids[:4], 4)] == [(0, 1), (1, 4), (5, 4)]
    assert [(p[1], p[2]) for p in k.cut(b"", 4)] == [(0, 1)]
