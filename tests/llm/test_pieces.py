import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from codesieve.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def table():
    return pieces.PieceTable(pieces.usable(pieces.read_model(MODEL)))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


CASES = ["", " ", "  ", " a", "a  b", "\t", "\n", "a\r\nb", "\x00", "é", "e\u0301", "\u2581x", "x\u2581y", "日本",
         "\U0001F600", "<s>", "</s>", "<unk>", "<0x41>", "\u00a0a", "\u3000", "\ufeffx", "\ufffd", "a" * 300, " " * 90,
         "== ==" * 40, "thththhehe" * 30, "Ｘ\u0e01\u0e33 ก", "word,word.word;(word)"]


def test_library_agrees(table, library):
    for text in CASES:
        ids = library.encode(text)
        assert table.encode(text).tolist() == ids, text
        assert table.decode(ids) == library.decode(ids), text


def test_random_texts_agree(table, library):
    random.seed(5)
    voices = list(table.ids)
    for k in range(3000):
        text = ("".join(random.choice(voices).replace(pieces.SPACE, " ") for _ in range(random.randint(1, 6))) if k % 2
                else "".join(random.choice("abeghinorst  theñé.,-=\n") for _ in range(random.randint(1, 40))))
        assert table.encode(text).tolist() == library.encode(text), text


def test_lockstep_and_single_parts_agree(table):
    random.seed(6)
    parts = list({"".join(random.choice("▁abcdehinorst,.'") for _ in range(random.randint(1, 31))) for _ in range(500)})
    together = table.lockstep.encode(parts)
    assert set(together) == set(parts)
    for part in parts:
        assert together[part] == table._encode_cut(part), part


def test_random_ids_decode_alike(table, library):
    random.seed(7)
    for _ in range(2000):
        ids = [random.choice([random.randrange(32_000), random.randrange(3, 259)]) for _ in range(random.randint(1, 9))]
        assert table.decode(ids) == library.decode(ids), ids


def test_operator(docs, library):
    long = "lorem ipsum ñ " * 20_000
    rows = [(1, "Hello world"), (2, None), (3, ""), (1, "Hello world"), (None, long)]
    got = pieces.digests(pieces.encode_and_decode(docs(*rows), MODEL)).collect()
    want = []
    for i, text in rows:
        ids = library.encode(text or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert pieces.encode_and_decode(docs((1, "a")).limit(0), MODEL).collect() == []
