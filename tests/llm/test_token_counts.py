"""Token counts, cuts and tables against the tokenizers library."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from merclake.llm import token_counts as tc
from merclake.llm.common import documents

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return tc.Counter(tc.WordBpe(PATH))


def count(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


ODD = [
    "", " ", "don't you'll we've I'D 'S ''s '", "<|endoftext|>", "x<|startoftext|>y <|endoftext|><|endoftext|> <|endof", "ÀÉÎ é ́a ŉ İstanbul ΣΑΣ ß",
    "a b\u0085c d\x1ce\x00f", "漢字 かな 한국어 ไทย हिन्दी 🙂🙂👩‍👩‍👧", "x" * 3000, "!?" * 500, "1234567890 ²½Ⅷ", "…“”–— ﬁ Ａ", "퟿\U0010ffff", "the of and" * 30, "é" * 100 + "!",
]


def test_odd_texts(library, own):
    for text in ODD:
        assert own.count(text.encode()) == count(library, text), text[:40]


def test_random_texts(library, own):
    rng = random.Random(3)
    alphabet = "abcdefghiklmnoprstuvwyz" * 6 + "ABCXYZ0159" + " \t\n" * 8 + "'’.,!?#$%&*()-_éüñßÉçøœž" + "漢字がПривет́ 🙂"
    for _ in range(1500):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 60)))
        assert own.count(text.encode()) == count(library, text), text


def test_every_prefix_of_a_piece(library, own):
    """Both tables: inside a word and closed at every prefix."""
    model = own.model
    for piece in ("internationalization", "ththereofing", "aaaaaaaaaaaaaaaa", "straßenbahnhaltestellé"):
        for n in range(1, len(piece) + 1):
            assert model.piece_count(piece[:n].encode()) == count(library, piece[:n])
        data = piece.encode()
        counts, _, _ = model.prefix_counts(data)
        assert counts[1:] == [len(model.merged(data[:n], False)) for n in range(1, len(data) + 1)]


def test_fit(library, own):
    rng = random.Random(6)
    texts = [t for t in ODD if "\x1c" not in t] + [" ".join(rng.choices(["the", "internationalization", "don't", "ééàâ", "x<|endoftext|>y", "漢字かな交じり", "a!b?c", "we'll"], k=12)) for _ in range(40)]
    for text in texts:
        data = text.strip().encode()
        total = count(library, data.decode())
        for limit in {0, 1, 2, 5, total // 2, max(0, total - 1)} - {total}:
            if limit > total:
                continue
            best = max(n for n in range(len(data.decode()) + 1) if n <= 400 and count(library, data.decode()[:n]) <= limit) if len(data) < 400 else None
            got = own.fit(data, limit)
            assert count(library, data[:got].decode()) <= limit
            if best is not None:
                assert len(data[:got].decode().rstrip()) == len(data.decode()[:best].rstrip()), (text, limit)


def test_whole_table(spark, library):
    rows = documents(spark, SF).collect()
    got = {r["doc_id"]: r for r in tc.op6_token_counts(spark, SF).collect()}
    assert len(got) == len(rows)
    for r in rows:
        n = count(library, r["text"])
        assert (got[r["doc_id"]]["n_bytes"], got[r["doc_id"]]["n_tokens"], got[r["doc_id"]]["over_limit"]) == (len(r["text"].encode()), n, n > 2048)
        kept = r["text"].encode()[: got[r["doc_id"]]["fit_bytes"]].decode()
        assert count(library, kept) <= 2048 and (n <= 2048) == (kept == r["text"])


def test_odd_rows(spark, docs_of, library):
    rows = [(1, None), (2, ""), (3, "The cat"), (3, "The cat"), (None, "x"), (4, "word " * 50000)] + [(10 + i, t) for i, t in enumerate(ODD[3:6])]
    got = tc.token_counts(docs_of(rows, clashing=True), PATH, limit=2).collect()
    want = sorted((str(d), len((t or "").encode()), count(library, t or "")) for d, t in rows)
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in got) == want
    assert tc.token_counts(docs_of([]), PATH).count() == 0
