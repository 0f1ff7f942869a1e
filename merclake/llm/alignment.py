"""Alignment of two tokenizers' tokens over one text.

Tokens of a byte-level encoding (A) and of a piece encoding (B) cover the same bytes, space + text. For each token's
start ``pandas.merge_asof`` finds the other side's covering token, the last one that starts there or before; the union
of both directions has every pair that overlaps. Where tokens of both sides end together, a group ends.

Neither encoding has a token that reaches over a space between two visible characters: A's pattern splits there, and no
piece of B has a space behind another character (checked when the vocabulary is read). So a document is cut there, and
each distinct cut of a group of documents is one document of the two frames that are joined. A document's tokens,
groups and links are those of its cuts. Aligning every document's tokens anew instead would join three times the rows
(measured: 1.2 million tokens of distinct cuts against 4.0 million in 10 MB of text).

How often an id pair is linked in the corpus is counted per group of documents (about ``GROUP`` bytes of text, by hash)
before the shuffle; every group gets the totals of its own pairs back, sorted before its documents. What a task holds is
bounded by a group's text and by its longest text, not by the vocabulary or the corpus.

Defined results: a null or empty text, and one whose tokens do not spell space + text (it holds U+2581, which B takes
for a space), has no tokens: zeros and an empty digest; it counts nowhere. Rows that repeat a doc_id, or have none, are
rows of their own. Without rows the result is empty. Further columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merclake.llm.common import documents, small_batches, store
from merclake.llm.registry import query

#: Bytes of text in a group of documents, and characters encoded in one call.
GROUP, CALL = 8 << 20, 1 << 16
#: What B writes for a space.
MARK = "▁"
#: A's pattern: contractions, words, numbers and signs with the space before them, white space. Fixed values.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_SPACES = re.compile(r"\s\s")
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")


def byte_symbols() -> dict[str, int]:
    """The characters by which a byte-level vocabulary writes bytes: visible Latin-1 as itself, the others from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """Both vocabularies."""

    def __init__(self, a: str, b: str):
        import sentencepiece
        import tiktoken

        with open(a, encoding="utf-8") as file:
            model = json.load(file)
        symbols, special = byte_symbols(), {t["content"] for t in model["added_tokens"] if t["special"]}
        self.bytes_a = {bytes(symbols[c] for c in name): i for name, i in model["model"]["vocab"].items() if name not in special}
        # ids rise in the order of the merges, so they serve as ranks
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=self.bytes_a, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b)
        self.size_a = np.zeros(max(self.bytes_a.values()) + 1, dtype=np.int64)
        for data, i in self.bytes_a.items():
            self.size_a[i] = len(data)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.size_b = np.array([len(x) for x in self.bytes_b])
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece reaches over a space")


_PAIRS: dict[tuple[str, str], Pair] = {}


def pair_of(a: str, b: str) -> Pair:
    if (a, b) not in _PAIRS:
        _PAIRS[a, b] = Pair(a, b)
    return _PAIRS[a, b]


def cuts(text: str) -> list[str]:
    """The text cut at single spaces between visible characters; the spaces are left out."""
    if _SPACES.search(text) or text[0].isspace() or text[-1].isspace():
        return _BETWEEN.split(text)
    return text.split(" ")


class Aligned:
    """Tokens, links and groups of distinct texts. Arrays of tokens are in order of the texts."""

    def __init__(self, pair: Pair, texts: list[str]):
        self.pair = pair
        good = [MARK not in t for t in texts]
        self._encode([t for t, g in zip(texts, good) if g])
        if not all(good) or not self._spelled:  # a rare text may not be spelled by its pieces
            good = [g and b"".join(map(pair.bytes_b.__getitem__, pair.b.encode(t))) == b" " + t.encode() for t, g in zip(texts, good)]
            self._encode([t for t, g in zip(texts, good) if g])
        #: Whether each text has tokens, and its place among those that do.
        self.good = np.array(good, dtype=bool)
        self.place = np.cumsum(self.good) - 1
        self._align()

    def _encode(self, texts: list[str]) -> None:
        a: list[list[int]] = []
        b: list[list[int]] = []
        self._spelled = True
        at = 0
        # a text with white space at its edges is encoded alone, the others joined by the space they were cut at
        alone = [i for i, t in enumerate(texts) if t[0].isspace() or t[-1].isspace()]
        single = set(alone)
        bounds = np.array([*alone, len(texts)], dtype=np.int64)
        stops = np.cumsum([len(t) for t in texts])
        while at < len(texts):
            end = int(np.searchsorted(stops, (stops[at - 1] if at else 0) + CALL))
            end = at + 1 if at in single else max(at + 1, min(end, int(bounds[np.searchsorted(bounds, at)])))
            joined = " ".join(texts[at:end])
            a.append(self.pair.a.encode_ordinary(" " + joined))
            b.append(self.pair.b.encode(joined))
            self._spelled &= b"".join(map(self.pair.bytes_b.__getitem__, b[-1])) == b" " + joined.encode()
            at = end
        self.ids = [np.fromiter(chain.from_iterable(x), np.int64) for x in (a, b)]
        self.n = len(texts)
        self.begin = np.cumsum([0] + [len(t.encode()) + 1 for t in texts])

    def _align(self) -> None:
        ends = [np.cumsum(size[ids]) for size, ids in zip((self.pair.size_a, self.pair.size_b), self.ids)]
        starts = [end - size[ids] for end, size, ids in zip(ends, (self.pair.size_a, self.pair.size_b), self.ids)]
        self.owner = [np.searchsorted(self.begin, s, side="right") - 1 for s in starts]
        frames = [pd.DataFrame({"at": s, "document": o, "token": np.arange(len(s))}) for s, o in zip(starts, self.owner)]
        over_a = pd.merge_asof(frames[0], frames[1], on="at", by="document", suffixes=("_a", "_b"))
        over_b = pd.merge_asof(frames[1], frames[0], on="at", by="document", suffixes=("_b", "_a"))
        found_a, found_b = (over_b[c].to_numpy().astype(np.int64) for c in ("token_a", "token_b"))
        new = starts[0][found_a] != starts[1][found_b] if len(found_a) else np.zeros(0, bool)  # those with equal starts are in both
        #: Every link: its token of A, its token of B, its text.
        self.link_a = np.concatenate((over_a["token_a"].to_numpy().astype(np.int64), found_a[new]))
        self.link_b = np.concatenate((over_a["token_b"].to_numpy().astype(np.int64), found_b[new]))
        self.link_owner = self.owner[0][self.link_a]
        self.link_key = self.ids[0][self.link_a] << 32 | self.ids[1][self.link_b]
        common = np.intersect1d(ends[0], ends[1], assume_unique=True)
        #: The group of each token, numbered through all texts, and the end of each group.
        self.group = [np.searchsorted(common, end) for end in ends]
        self.group_end = common
        self.group_owner = np.searchsorted(self.begin, common, side="left") - 1
        self.ends = ends

    def counts(self) -> list[np.ndarray]:
        """Of each text with tokens: tokens of A and B, groups, links."""
        return [np.bincount(x, minlength=self.n) for x in (*self.owner, self.group_owner, self.link_owner)]

    def written(self) -> list[str]:
        """The groups of each text as 'a1,a2|b1;', each closed by a semicolon."""
        if not self.n:
            return []
        side = np.repeat([0, 1], [len(x) for x in self.ids])
        group = np.concatenate(self.group)
        order = np.argsort(group * 2 + side, kind="stable")
        group, side, ids, owner = group[order], side[order], np.concatenate(self.ids)[order], np.concatenate(self.owner)[order]
        sign = np.full(len(ids), ",", dtype=object)
        sign[:-1][(side[:-1] == 0) & (side[1:] == 1)] = "|"
        sign[:-1][group[:-1] != group[1:]] = ";"
        sign[-1] = ";"
        cells = pc.binary_join_element_wise(pa.array(ids).cast(pa.large_string()), pa.array(sign, pa.large_string()), pa.scalar("", pa.large_string()))
        offsets = np.searchsorted(owner, np.arange(self.n + 1))
        return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets), cells), pa.scalar("", pa.large_string())).to_pylist()


class Laid:
    """The documents of a group as cuts: ``index`` of every cut among the distinct ones, ``stop`` of each document."""

    def __init__(self, pair: Pair, texts: list[str | None]):
        lists = [cuts(t) if t else [] for t in texts]
        known: dict[str, int] = {}
        self.index = np.fromiter((known.setdefault(c, len(known)) for c in chain.from_iterable(lists)), np.int64)
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        self.start = np.cumsum(sizes) - sizes
        self.aligned = Aligned(pair, list(known))
        bad = np.append(0, np.cumsum(~self.aligned.good[self.index]))
        sizes[bad[self.start + sizes] > bad[self.start]] = 0  # one cut without tokens leaves the document without
        self.size = sizes

    def cuts_of(self, i: int) -> np.ndarray:
        return self.aligned.place[self.index[self.start[i] : self.start[i] + self.size[i]]]

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Per document the sum of a value of its cuts."""
        live = np.zeros(len(self.aligned.good), dtype=np.int64)
        live[self.aligned.good] = values
        total = np.append(0, np.cumsum(live[self.index]))
        return total[self.start + self.size] - total[self.start]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Linked id pairs of all documents and how many links each has."""
        used = np.zeros(len(self.index) + 1, dtype=np.int64)
        np.add.at(used, self.start, self.size > 0)
        np.add.at(used, self.start + self.size, -(self.size > 0).astype(np.int64))
        live = self.index[np.cumsum(used)[:-1] > 0]
        times = np.bincount(self.aligned.place[live], minlength=self.aligned.n)
        keys, at = np.unique(self.aligned.link_key, return_inverse=True)
        n = np.zeros(len(keys), dtype=np.int64)
        np.add.at(n, at, times[self.aligned.link_owner])
        return keys[n > 0], n[n > 0]


def _by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """The rows of each group; rows come sorted by group."""
    held: list[pa.Table] = []
    now: int | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        groups = table.column("part").to_numpy()
        edges = np.flatnonzero(np.append(True, groups[1:] != groups[:-1])).tolist() + [len(groups)] if len(groups) else []
        for a, b in zip(edges, edges[1:]):
            if held and groups[a] != now:
                yield now, pa.concat_tables(held)
                held = []
            now = int(groups[a])
            held.append(table.slice(a, b - a))
    if held:
        yield now, pa.concat_tables(held)


def _pairs(a: str, b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(a, b)
        for part, table in _by_group(batches):
            keys, n = Laid(pair, table.column("text").to_pylist()).pairs()
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), part)), pa.array(keys), pa.array(n)], ["part", "pair", "n"])

    return run


_DIGEST = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def _digests(a: str, b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(a, b)
        for _, table in _by_group(batches):
            mine = table.filter(pc.equal(table.column("kind"), 0))
            docs = table.filter(pc.equal(table.column("kind"), 1))
            if not docs.num_rows:
                continue
            laid = Laid(pair, docs.column("text").to_pylist())
            al = laid.aligned
            known, n, best = (mine.column(c).to_numpy() for c in ("pair", "n", "best"))
            order = np.argsort(known)
            at = np.searchsorted(known, al.link_key, sorter=order)
            at = order[np.minimum(at, max(0, len(order) - 1))] if len(order) else np.zeros(len(al.link_key), np.int64)
            counted = len(order) > 0
            link_n = n[at] if counted else np.zeros(len(at), np.int64)
            link_best = best[at] if counted else np.zeros(len(at), np.int64)
            sums = [np.zeros(al.n, np.int64), np.zeros(al.n, np.int64)]
            np.add.at(sums[0], al.link_owner, link_best)
            np.add.at(sums[1], al.link_owner, link_n)
            columns = [laid.sums(v) for v in (*al.counts(), *sums)]
            written, digests = al.written(), []
            for i in range(docs.num_rows):
                own = laid.cuts_of(i)
                if not len(own):
                    digests.append("")
                    continue
                digest = hashlib.sha256()
                for k in range(0, len(own), 1 << 16):  # a long document need not be written out at once
                    more = "".join([written[c] for c in own[k : k + (1 << 16)].tolist()])
                    digest.update((more if k + (1 << 16) < len(own) else more[:-1]).encode())
                digests.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([docs.column("doc_id").combine_chunks(), *map(pa.array, columns), pa.array(digests, pa.string())], ["doc_id", *_DIGEST, "groups_sha256"])

    return run


def _parted(docs: DataFrame) -> DataFrame:
    """doc_id, text and the group of each document, by hash; as many groups as the texts' bytes ask for."""
    texts = docs.select("doc_id", "text")
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return texts.withColumn("part", F.pmod(F.xxhash64("doc_id", "text"), F.lit(size // GROUP + 1)))


def pair_counts(docs: DataFrame, a: str, b: str) -> DataFrame:
    """a_id, b_id, n, best: how many links of all documents hold the pair, and whether no other of its B id has more."""
    small_batches(docs.sparkSession)
    return _totals(_per_part(_parted(docs), a, b)).select(F.shiftright("pair", 32).alias("a_id"), F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b_id"), "n", "best")


def _per_part(texts: DataFrame, a: str, b: str) -> DataFrame:
    dealt = texts.select("part", "text").repartition("part").sortWithinPartitions("part")
    return store(dealt.mapInArrow(_pairs(a, b), "part long, pair long, n long"), "pairs")


def _totals(per_part: DataFrame) -> DataFrame:
    """pair, n, best over all groups. The B ids of a vocabulary are few, their best counts a small table."""
    total = store(per_part.groupBy("pair").agg(F.sum("n").alias("n")), "totals").withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF))
    top = total.groupBy("b").agg(F.max("n").alias("top"))
    return total.join(top, "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def alignment_digest(docs: DataFrame, a: str, b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    small_batches(docs.sparkSession)
    texts = _parted(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    per_part = _per_part(texts, a, b)
    back = store(per_part.select("part", "pair").join(_totals(per_part), "pair"), "pairs-back")
    left = back.select("part", F.lit(0).alias("kind"), F.lit(None).cast(kind).alias("doc_id"), F.lit(None).cast("string").alias("text"), "pair", "n", F.col("best").cast("long").alias("best"))
    right = texts.select("part", F.lit(1).alias("kind"), "doc_id", "text", *(F.lit(0).cast("long").alias(c) for c in ("pair", "n", "best")))
    dealt = left.unionByName(right).repartition("part").sortWithinPartitions("part", "kind")
    return dealt.mapInArrow(_digests(a, b), f"doc_id {kind}, {', '.join(f'{c} long' for c in _DIGEST)}, groups_sha256 string")


def groups(docs: DataFrame, a: str, b: str) -> DataFrame:
    """doc_id, start, stop, a_ids, b_ids: every group of every document; bytes ``start`` to ``stop`` of space + text."""
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(a, b)
        for batch in batches:
            laid = Laid(pair, batch.column("text").to_pylist())
            al = laid.aligned
            first = np.searchsorted(al.group_owner, np.arange(al.n + 1))
            bounds = [np.searchsorted(g, np.arange(len(al.group_end) + 1)) for g in al.group]
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                rows, at = [], 0
                for c in laid.cuts_of(i).tolist():
                    for g in range(first[c], first[c + 1]):
                        size = int(al.group_end[g] - (al.group_end[g - 1] if g else 0))
                        ids = [al.ids[s][bounds[s][g] : bounds[s][g + 1]].tolist() for s in (0, 1)]
                        rows.append((doc_id, at, at + size, *ids))
                        at += size
                if rows:
                    kinds = [batch.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], ["doc_id", "start", "stop", "a_ids", "b_ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, start long, stop long, a_ids array<long>, b_ids array<long>")


@query("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return alignment_digest(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
