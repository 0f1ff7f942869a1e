"""Alignment against both libraries over whole texts and every pair of tokens."""

import hashlib
import random
import sys
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from merclake.llm import alignment as al
from merclake.llm.common import documents

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

ODD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "end.\n The\n\n  next\t \tx", "don't you'll  we've I'D", "<|endoftext|> <s> </s><unk> <0x0A>", "a▁b c", "▁", "漢字 かな 한국어 ไทย 🙂🙂👩‍👩‍👧 x",
    "a b   c　 d", "x\x00y \x1c z\x1f q\x85 r", "١٢٣ ²½Ⅷ ﬁ Ａ é é", "x" * 3000, "!?" * 500 + " " * 50 + "1234567890" * 30, "\r\n \r\n", "퟿\U0010ffff ﻿a",
]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def tokens(libraries, text):
    """Ids and byte ends of both sides, or nothing."""
    if not text:
        return None
    a, b = libraries
    symbols = al.byte_symbols()
    ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    spelled = [[bytes(symbols[c] for c in a.id_to_token(i)) for i in ids[0]], [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]]]
    if any(b"".join(s) != (" " + text).encode() for s in spelled):
        return None
    ends = []
    for s in spelled:
        at, own = 0, []
        for x in s:
            at += len(x)
            own.append(at)
        ends.append(own)
    return ids, ends


def one(libraries, text):
    """Links as (a id, b id), and the groups."""
    found = tokens(libraries, text)
    if found is None:
        return None
    (ia, ib), (ea, eb) = found
    links, j = [], 0
    for i in range(len(ia)):
        start = ea[i - 1] if i else 0
        while eb[j] <= start:
            j += 1
        k = j
        while k < len(ib) and (eb[k - 1] if k else 0) < ea[i]:
            links.append((ia[i], ib[k]))
            k += 1
    cut = sorted(set(ea) & set(eb))
    groups, last = [], 0
    for c in cut:
        groups.append((last, c, [x for x, e in zip(ia, ea) if last < e <= c], [x for x, e in zip(ib, eb) if last < e <= c])) if len(ia) < 400 else None
        last = c
    if len(ia) >= 400:  # the same in one pass
        where = {c: n for n, c in enumerate(cut)}
        parts = [([], []) for _ in cut]
        for side, (ids, ends) in enumerate(((ia, ea), (ib, eb))):
            n = 0
            for x, e in zip(ids, ends):
                parts[n][side].append(x)
                n = where[e] + 1 if e in where else n
        groups = [(a, c, *p) for a, c, p in zip([0, *cut], cut, parts)]
    return len(ia), len(ib), links, groups


def brute(libraries, rows):
    found = [(doc_id, one(libraries, text)) for doc_id, text in rows]
    n = Counter(link for _, x in found if x for link in x[2])
    top = {}
    for (_, b), c in n.items():
        top[b] = max(c, top.get(b, 0))
    out = []
    for doc_id, x in found:
        if x is None:
            out.append((str(doc_id), 0, 0, 0, 0, 0, 0, ""))
            continue
        written = ";".join(",".join(map(str, g[2])) + "|" + ",".join(map(str, g[3])) for g in x[3])
        out.append((str(doc_id), x[0], x[1], len(x[3]), len(x[2]), sum(n[k] == top[k[1]] for k in x[2]), sum(n[k] for k in x[2]), hashlib.sha256(written.encode()).hexdigest()))
    return sorted(out), n


def got(df):
    return sorted((str(r["doc_id"]), *(r[c] for c in al._DIGEST), r["groups_sha256"]) for r in df.collect())


def test_whole_table(spark, libraries):
    rows = [(r["doc_id"], r["text"]) for r in documents(spark, SF).collect()]
    assert got(al.op13_token_alignment(spark, SF)) == brute(libraries, rows)[0]


def test_odd_rows(spark, docs_of, libraries, monkeypatch):
    monkeypatch.setattr(al, "GROUP", 500)
    rng = random.Random(4)
    mixed = [" ".join(rng.choices(ODD[3:16] + ["the", "of", "straße", "x\ny"], k=20)) for _ in range(20)]
    rows = [(1, None), (2, ""), (None, "null id"), (None, None), (3, "the same"), (3, "the same"), (3, "the other"), (4, "word " * 40000)] + [(10 + i, t) for i, t in enumerate(ODD + mixed)]
    want, n = brute(libraries, rows)
    docs = docs_of(rows, clashing=True)
    assert got(al.alignment_digest(docs, A, B)) == want
    pairs = {(r["a_id"], r["b_id"]): r["n"] for r in al.pair_counts(docs, A, B).collect()}
    assert pairs == n
    found = sorted((str(r["doc_id"]), r["start"], r["stop"], r["a_ids"], r["b_ids"]) for r in al.groups(docs, A, B).collect())
    assert found == sorted((str(d), *g) for d, t in rows for g in (one(libraries, t) or (0, 0, 0, []))[3])
    assert al.alignment_digest(docs_of([]), A, B).count() == 0
    assert got(al.alignment_digest(docs_of([(1, None)]), A, B)) == [("1", 0, 0, 0, 0, 0, 0, "")]


def test_every_character(libraries):
    """Ids of the fast encoder are those of the library, whatever the character beside letters, digits and signs."""
    pair = al.pair_of(A, B)
    for at in range(0, sys.maxunicode + 1, 400):
        chars = [chr(c) for c in range(at, min(at + 400, sys.maxunicode + 1)) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{c}b 1{c}2 {c} {c}{c} .{c}! " for c in chars)
        if text:
            assert pair.a.encode_ordinary(text) == libraries[0].encode(text, add_special_tokens=False).ids, hex(at)
