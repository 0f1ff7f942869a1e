"""Exact token counts by prefix dynamic programming.

A byte-pair encoding has one property that makes its counts a recurrence: every prefix of an encoding is the encoding
of the string it spells. So the encoding of a prefix ends in the one token whose left neighbour, the last token of the
shorter prefix, it may follow; two tokens may follow each other if their joint string encodes to just these two. The
table of last tokens and counts at every prefix answers what any truncation costs, and what fits a budget,
without encoding again.

The vocabulary marks the end of a word, so the last token of a piece is looked for among the tokens with that mark.
Text is cut at white space, each distinct word is normalised, split and counted once, and a document's count is the
sum over its words. The file of the vocabulary is a parameter.

Defined results: a null text is empty and has no tokens. Special strings inside a text count as the library counts them
by default, as one token. Rows that repeat are counted each. Without rows the result is empty. Further
columns are not read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Tokenizer

from merclake.llm.common import documents, small_batches, text_bytes
from merclake.llm.registry import query

#: Words, and pieces of words, whose counts a Python worker remembers, and the longest of these.
REMEMBERED, LONGEST = 500_000, 64
#: White space that separates words here; all of it is white space to the library.
SPACE = b"\t\n\x0b\x0c\r "
#: Characters that this module normalises itself: printable ASCII and precomposed Latin letters. Words with others go
#: through the library's normaliser and splitter.
_PLAIN = re.compile("[\x21-\x7eÀ-įı-ɏ]*")


def byte_symbols() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte: itself if printable, else the next
    one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(c): b for c, b in [*zip(shown, shown), *zip(range(256, 256 + len(hidden)), hidden)]}


class WordBpe:
    """A byte-level BPE with an end-of-word mark, from a file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.special = [t["content"] for t in model["added_tokens"]]
        split = next(s for s in model["pre_tokenizer"]["pretokenizers"] if s["type"] == "Split")
        self.pieces = regex.compile(split["pattern"]["Regex"])
        self.mark = model["model"]["end_of_word_suffix"]
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(model["model"]["merges"])}
        symbol = byte_symbols()
        self.symbol_of = {b: c for c, b in symbol.items()}
        special = set(self.special)
        self.names: list[str] = []
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        for name in model["model"]["vocab"]:
            if name in special:
                continue
            ends = name.endswith(self.mark)
            body = name[: -len(self.mark)] if ends else name
            data = bytes(symbol[c] for c in body)
            if self.merged(data, ends) == [name]:  # else no text gives it
                (self.final if ends else self.inner)[data] = len(self.names)
            self.names.append(name)
        self.tails = {data[i:] for data in [*self.inner, *self.final] for i in range(len(data))}
        self.follows: dict[int, bool] = {}
        self.counted: dict[bytes, int] = {}

    def merged(self, data: bytes, ends: bool) -> list[str]:
        """The encoding of a short string by its definition: merge the pair of least rank, the leftmost of equals."""
        parts = [self.symbol_of[b] for b in data]
        if ends:
            parts[-1] += self.mark
        ranks, last = self.ranks.get, len(self.ranks)
        while True:
            least, at = last, 0
            for i in range(len(parts) - 1):
                rank = ranks((parts[i], parts[i + 1]), last)
                if rank < least:
                    least, at = rank, i
            if least == last:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def may_follow(self, left: int, right: int, data: bytes, ends: bool) -> bool:
        """Whether ``data``, the joint string of two tokens, encodes to just these two; remembered by their pair."""
        known = self.follows[left << 20 | right] = self.merged(data, ends) == [self.names[left], self.names[right]]
        return known

    def _last(self, piece: bytes, i: int, tokens: dict[bytes, int], last: list[int], back: list[int], ends: bool) -> tuple[int, int]:
        """The last token of the encoding of piece[:i], and its length."""
        for at in range(i - 1, -1, -1):
            tail = piece[at:i]
            if tail not in self.tails:
                break
            token = tokens.get(tail)
            if token is not None:
                if not at:
                    return token, i
                known = self.follows.get(last[at] << 20 | token)
                if known or known is None and self.may_follow(last[at], token, piece[at - back[at] : i], ends):
                    return token, i - at
        raise ValueError("the vocabulary lacks a byte")

    def prefix_counts(self, piece: bytes) -> tuple[list[int], list[int], list[int]]:
        """For every i, the tokens of piece[:i] inside a longer word; and each one's last token and its length."""
        n = len(piece)
        counts, last, back = [0] * (n + 1), [-1] * (n + 1), [0] * (n + 1)
        tails, inner, follows = self.tails, self.inner, self.follows
        for i in range(1, n + 1):  # as _last, without a call for every prefix
            for at in range(i - 1, -1, -1):
                tail = piece[at:i]
                if tail not in tails:
                    raise ValueError("the vocabulary lacks a byte")
                token = inner.get(tail)
                if token is not None:
                    if at:
                        known = follows.get(last[at] << 20 | token)
                        if known is None:
                            known = self.may_follow(last[at], token, piece[at - back[at] : i], False)
                        if not known:
                            continue
                    last[i], back[i], counts[i] = token, i - at, counts[at] + 1
                    break
        return counts, last, back

    def piece_count(self, piece: bytes) -> int:
        """Tokens of a whole piece."""
        count = self.counted.get(piece)
        if count is None:
            if len(self.counted) > REMEMBERED:
                self.counted.clear()
            counts, last, back = self.prefix_counts(piece[:-1])
            _, size = self._last(piece, len(piece), self.final, last, back, True)
            count = counts[len(piece) - size] + 1
            if len(piece) <= LONGEST:
                self.counted[piece] = count
        return count

    def split(self, word: str) -> list[bytes]:
        """The pieces of a word without white space, as bytes."""
        if _PLAIN.fullmatch(word):
            return [m.encode() for m in self.pieces.findall(word.lower())]
        symbol = byte_symbols()
        parts = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(word))
        return [bytes(symbol[c] for c in p) for p, _ in parts]

    def fit(self, word: str, limit: int) -> int:
        """Characters of the longest prefix of a word that has at most ``limit`` tokens."""
        if not _PLAIN.fullmatch(word) or any(s in word for s in self.special):
            # a count may fall by a few tokens where a character joins those before it, never by more
            low, high = 0, len(word)
            while low < high:
                middle = (low + high + 1) // 2
                low, high = (middle, high) if self.word_count(word[:middle]) <= limit else (low, middle - 1)
            return next((n for n in range(min(len(word), low + 16), 0, -1) if self.word_count(word[:n]) <= limit), 0)
        for found in self.pieces.finditer(word.lower()):
            piece = found.group()
            count = self.piece_count(piece.encode())
            if count > limit:
                return found.start() + self._fit_piece(piece, limit)
            limit -= count
        return len(word)

    def _fit_piece(self, piece: str, limit: int) -> int:
        if piece[0] == "'":  # a shorter contraction may be two pieces
            return next((n for n in range(len(piece) - 1, 0, -1) if self.word_count(piece[:n]) <= limit), 0)
        data = piece.encode()
        counts, last, back = self.prefix_counts(data)
        end = len(data)
        for n in range(len(piece) - 1, 0, -1):
            end -= len(piece[n].encode())
            _, size = self._last(data, end, self.final, last, back, True)
            if counts[end - size] + 1 <= limit:
                return n
        return 0

    def word_count(self, word: str) -> int:
        if any(s in word for s in self.special):
            return len(self.library.encode(word, add_special_tokens=False).ids)
        return sum(map(self.piece_count, self.split(word)))


class Counter(dict):
    """Token counts of words as they stand in a text, in UTF-8."""

    def __init__(self, model: WordBpe):
        super().__init__()
        self.model = model

    def __missing__(self, word: bytes) -> int:
        count = self.model.word_count(word.decode())
        if len(word) <= LONGEST:
            self[word] = count
        return count

    def count(self, text: bytes) -> int:
        return sum(map(self.__getitem__, text.split()))

    def fit(self, text: bytes, limit: int) -> int:
        """Bytes of the longest prefix of whole characters that has at most ``limit`` tokens."""
        words = text.split()
        whole = 0
        for total in accumulate(map(self.__getitem__, words)):
            if total > limit:
                break
            whole += 1
        if whole == len(words):
            return len(text)
        rest = text.split(None, whole)[whole]  # begins with the word that no longer fits
        left = limit - sum(map(self.__getitem__, words[:whole]))
        word = words[whole].decode()
        inside = self.model.fit(word, left)
        trimmed = text.rstrip(SPACE)
        return len(trimmed) - len(rest.rstrip(SPACE)) + len(word[:inside].encode())


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """This worker's counter for a vocabulary file."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(WordBpe(path))
    return _COUNTERS[path]


def _counts(path: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in batches:
            texts = text_bytes(batch.column("text"))
            counts = []
            for text in texts:
                if len(own) > REMEMBERED:
                    own.clear()
                counts.append(own.count(text))
            fits = [own.fit(x, limit) if n > limit else len(x) for x, n in zip(texts, counts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x) for x in texts], pa.int64()), pa.array(counts, pa.int64()), pa.array([n > limit for n in counts]), pa.array(fits, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_bytes"],
            )

    return run


def token_counts(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, and fit_bytes: how much of the text a cut at ``limit`` tokens keeps."""
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_counts(path, limit), f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean, fit_bytes long")


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
