"""Removal of repeated byte strings by distributed prefix doubling.

A byte goes if a string of ``length`` bytes that covers it also starts in a document with a smaller doc_id. Prefix
doubling ranks the positions of all texts by their first k bytes, then by pairs of ranks at growing offsets, and
drops a position as soon as its rank is unique. Here

* only *anchors* are ranked: in every string of ``length`` bytes the places whose k bytes have the least name.
  Equal strings have equal anchors, so none is missed, and about one position in twenty takes part;
* the name of a string (a 64-bit polynomial) serves as its rank, so the rank at any offset needs no join;
* round 1 sorts by (rank of k bytes, rank of the whole context): an anchor whose k bytes are alone drops out, one whose
  context (all strings that contain it) also occurs in a smaller document is settled, and one that shares neither of
  the two strings of about double length, to the left and to the right, drops out too;
* round 2 sorts what is left, the places where repeats begin, end or are edited, by the rank at full length, the
  threshold, past which no rank is refined.

Each round packs the rows of a batch of text into a few blobs per bucket of ranks; Spark shuffles and sorts the
buckets. A string that stands in very many documents is reduced to one row per batch before the shuffle, and where
its contexts differ, its strings of full length are dealt out by their own names, so no bucket gets the whole group.

Defined results: a null text is empty. A row without doc_id keeps all its bytes and gives no reason to remove any.
Rows that repeat a doc_id never remove bytes from each other; they may have different texts. Strings never span two
documents. Without rows the result is empty. Further columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merclake.llm.common import documents, scramble, small_batches, store, text_bytes
from merclake.llm.registry import query
from merclake.llm.suffixes import Names, deltas, group_of, names_of_rows, pack, runs, sliding, unpack

#: Bytes of text whose positions are ranked at once, and anchors that are packed together.
PIECE, PACKED = 1 << 19, 1 << 19
#: More contexts than this of one anchor in one batch, or in all, count as a crowd.
CROWD_HERE, CROWD = 64, 256
#: Buckets of ranks for each shuffle partition. Every task sends a blob to each, so more of them mean smaller blobs.
BUCKETS = 3
#: Kinds of blobs. Those up to CROWDED travel by bucket of ranks, the others by group of documents.
ANCHORS, CROWDED, CONTEXTS, STRINGS, COVERS, WANTED, TEXT = range(7)
_BLOBS = "place int, kind int, data binary"
_LOW32 = np.uint64(0xFFFFFFFF)
_COVER = ("<i8", "<u4", "<u4", "<u4")
_WANT = ("<i8", "<u4", "<u4", "u1")
_ANCHOR = ("<u8", "<u8", "<i8", "<u4", "<u4", "u1", "<u2", "<u2")
_ANCHOR_WIDTHS = (4, 6, 8, 4, 4, 1, 2, 2)
_STRING = ("<u8", "<u4", "<i8", "<u4", "<u4")
_CONTEXT = ("<u8", "<i8", "<u4", "<u4", "u1", "u1")


class Plan:
    """The numbers that all tasks of one run share."""

    def __init__(self, length: int, name: int, groups: int, tagged: frozenset[int] | None):
        self.length, self.name, self.groups, self.buckets, self.tagged = length, name, groups, groups * BUCKETS, tagged
        self.side = length - name  # bytes a string may reach beyond its anchor on either side
        self.reach = (self.side + 1) // 2  # of these it has so many on one side at least

    def tag(self, doc_id: int, text: bytes) -> int:
        """Tells apart the different texts of one doc_id; 0 where there is one only."""
        return zlib.crc32(text) | 1 if self.tagged is None or doc_id in self.tagged else 0


def _record(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    place, kind, data = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), pa.array(kind, pa.int32()), pa.array(data, pa.binary())], ["place", "kind", "data"])


def _by_place(place: np.ndarray, kind: int, columns: list[np.ndarray], widths=None, id_column: int = 0) -> list[tuple[int, int, bytes]]:
    """One blob for each place; ids as differences, as neighbours mostly are of one document."""
    if not len(place):
        return []
    order = np.argsort(place, kind="stable")
    place, columns = place[order], [c[order] for c in columns]
    starts = np.flatnonzero(runs(place))
    columns[id_column] = deltas(columns[id_column], starts)
    ends = np.append(starts[1:], len(place))
    return [(int(place[a]), kind, pack(*(c[a:b] for c in columns), widths=widths)) for a, b in zip(starts, ends)]


def _unpacked(blobs: list[bytes], kinds, widths=None, id_column: int = 0) -> list[np.ndarray]:
    parts = [unpack(b, kinds, widths) for b in blobs]
    for p in parts:
        p[id_column] = np.cumsum(p[id_column])
    return [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, k) for k in kinds]


class Marks:
    """Covers and wanted contexts, gathered and packed by group of documents."""

    def __init__(self, plan: Plan):
        self.plan, self.held, self.size = plan, {COVERS: [], WANTED: []}, 0

    def add(self, kind: int, ids: np.ndarray, *columns: np.ndarray) -> None:
        if len(ids):
            self.held[kind].append([ids, *columns])
            self.size += len(ids)

    def out(self) -> Iterator[pa.RecordBatch]:
        for kind, kinds in ((COVERS, _COVER), (WANTED, _WANT)):
            if self.held[kind]:
                cols = [np.concatenate(x).astype(k) for x, k in zip(zip(*self.held[kind]), kinds)]
                rows = _by_place(group_of(cols[0], self.plan.groups), kind, cols)
                for at in range(0, len(rows), 10000):
                    yield _record(rows[at : at + 10000])
        self.held, self.size = {COVERS: [], WANTED: []}, 0


def _slices(plan: Plan, ids: list, texts: list[bytes]) -> Iterator[list[tuple]]:
    """Lists of slices (id, tag, text length, offset, first and last string start, bytes) of about PIECE bytes. A
    long text is cut into slices that overlap by all that a string or a context may need."""
    held, size = [], 0
    for doc_id, text in zip(ids, texts):
        n = len(text)
        if doc_id is None or n < plan.length:
            continue
        tag = plan.tag(doc_id, text)
        for first in range(0, n - plan.length + 1, PIECE):
            last = min(first + PIECE, n - plan.length + 1)
            a, b = max(0, first - plan.length), min(n, last + 2 * plan.length)
            held.append((doc_id, tag, n, a, first - a, last - a, text[a:b]))
            size += b - a
            if size >= PIECE:
                yield held
                held, size = [], 0
    if held:
        yield held


def anchors(plan: Plan, slices: list[tuple]) -> list[np.ndarray]:
    """Name, name of the context, doc_id, tag, position, bytes of context to the right, and names of the strings
    that reach left and right, for each anchor of the slices."""
    length, k = plan.length, plan.name
    sizes = np.array([len(s[6]) for s in slices])
    begins = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(s[6] for s in slices), dtype=np.uint8)
    of = np.repeat(np.arange(len(slices)), sizes)
    names = Names(data)
    grams = names.all_of(k) | np.uint64(1)
    width = length - k + 1
    least = sliding(grams, width, True)
    n = len(least)
    starts = np.arange(n)
    begin = begins[of[:n]]
    valid = (of[:n] == of[length - 1 : length - 1 + n]) & (starts >= begin + np.array([s[4] for s in slices])[of[:n]])
    valid &= starts < begin + np.array([s[5] for s in slices])[of[:n]]
    least = np.where(valid, least, np.uint64(0))
    edge = np.zeros(width - 1, dtype=np.uint64)
    most = sliding(np.concatenate((edge, least, edge)), width, False)
    at = np.flatnonzero(most == grams)
    own = of[at]
    lo = np.maximum(begins[own], at - plan.side)
    hi = np.minimum(begins[own] + sizes[own], at + length)
    left, right = (at - lo).astype(np.uint64), (hi - at).astype(np.uint64)
    context = scramble(names.of(lo, hi) ^ (left << np.uint64(32) | right))
    reach = plan.reach
    has_left, has_right = left >= reach, right >= k + reach
    to_left = names.of(np.maximum(at - reach, 0), at + k) >> np.uint64(48) | np.uint64(1)
    to_right = names.of(at, np.minimum(at + k + reach, len(data))) >> np.uint64(48) | np.uint64(1)
    pos = at - begins[own] + np.array([s[3] for s in slices])[own]
    return [
        grams[at], context, np.array([s[0] for s in slices], dtype=np.int64)[own], np.array([s[1] for s in slices], dtype=np.uint32)[own],
        pos.astype(np.uint32), right.astype(np.uint8), np.where(has_left, to_left, 0).astype(np.uint16), np.where(has_right, to_right, 0).astype(np.uint16),
    ]


def _first_round(plan: Plan):
    """Texts in; blobs of anchors by bucket out, and what the batch settles by itself."""

    def send(held: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        name, context, ids, tag, pos, right, hl, hr = (np.concatenate(x) for x in zip(*held))
        marks = Marks(plan)
        order = np.argsort(name ^ (context << np.uint64(1)), kind="stable")
        first = runs(name[order], context[order])
        group = np.cumsum(first) - 1
        least = np.minimum.reduceat(ids[order], np.flatnonzero(first))[group]
        later = order[ids[order] > least]
        left = np.minimum(pos, plan.side)
        marks.add(COVERS, ids[later], tag[later], (pos - left)[later], (left + right)[later])
        crowd, many = np.unique(name[order[first]], return_counts=True)
        crowd = crowd[many > CROWD_HERE]
        keep = np.ones(len(name), dtype=bool)
        keep[later] = False
        if len(crowd):
            at = np.minimum(np.searchsorted(crowd, name), len(crowd) - 1)
            packed = keep & (crowd[at] == name)
            marks.add(WANTED, ids[packed], tag[packed], pos[packed], np.ones(packed.sum(), np.uint8))
            keep &= ~packed
            bucket = (crowd >> np.uint64(32)).astype(np.int64) % plan.buckets
            yield _record(_by_place(bucket, CROWDED, [(crowd & _LOW32).astype(np.int64)]))
        cols = [name & _LOW32, context, ids, tag, pos, right, hl, hr]
        rows = _by_place((name[keep] >> np.uint64(32)).astype(np.int64) % plan.buckets, ANCHORS, [c[keep] for c in cols], _ANCHOR_WIDTHS, 2)
        for at in range(0, len(rows), 10000):
            yield _record(rows[at : at + 10000])
        yield from marks.out()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for slices in _slices(plan, batch.column("doc_id").to_pylist(), text_bytes(batch.column("text"))):
                held.append(anchors(plan, slices))
                size += len(held[-1][0])
                if size >= PACKED:
                    yield from send(held)
                    held, size = [], 0
        if size:
            yield from send(held)

    return run


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[int, list[bytes]]]:
    """The blobs of each place, by kind, from rows sorted by place."""
    place, blobs = None, {}
    for batch in batches:
        for p, kind, data in zip(*(batch.column(c).to_pylist() for c in ("place", "kind", "data"))):
            if p != place and blobs:
                yield blobs
                blobs = {}
            place = p
            blobs.setdefault(kind, []).append(data)
    if blobs:
        yield blobs


def _settled(plan: Plan, settle):
    """mapInArrow function: settle each bucket of ranks; the marks that tasks of the round before have made join those
    made here, so that a group of documents gets few blobs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = Marks(plan)
        for blobs in _places(batches):
            for kind, kinds in ((COVERS, _COVER), (WANTED, _WANT)):
                if kind in blobs:
                    marks.add(kind, *_unpacked(blobs[kind], kinds))
            settle(plan, blobs, marks)
            if marks.size >= PACKED:
                yield from marks.out()
        yield from marks.out()

    return run


def _settle_anchors(plan: Plan, blobs: dict[int, list[bytes]], marks: Marks) -> None:
    name, context, ids, tag, pos, right, hl, hr = _unpacked(blobs.get(ANCHORS, []), _ANCHOR, _ANCHOR_WIDTHS, 2)
    if not len(name):
        return
    order = np.lexsort((context, name))
    name, context, ids, tag, pos, right, hl, hr = (c[order] for c in (name, context, ids, tag, pos, right, hl, hr))
    own, ctx = runs(name), runs(name, context)
    group, kind = np.cumsum(own) - 1, np.cumsum(ctx) - 1
    firsts = np.flatnonzero(ctx)
    least = np.minimum.reduceat(ids, firsts)
    later = ids > least[kind]
    left = np.minimum(pos, plan.side)
    marks.add(COVERS, ids[later], tag[later], (pos - left)[later], (left + right)[later])
    crowded = _unpacked(blobs.get(CROWDED, []), ("<i8",))[0].astype(np.uint64)
    crowded = np.isin(name[own], crowded)
    begins = np.flatnonzero(own)
    several = np.minimum.reduceat(ids, begins) < np.maximum.reduceat(ids, begins)
    several &= np.add.reduceat(ctx.astype(np.int64), begins) > 1
    # one row for each context of a group of several; it stays if it shares a longer string with another
    g = group[firsts]
    stays = crowded[g].copy()
    for longer in (hl[firsts], hr[firsts]):
        key = g.astype(np.int64) << 16 | longer
        _, inverse, n = np.unique(key, return_inverse=True, return_counts=True)
        stays |= several[g] & (longer > 0) & (n[inverse] > 1)
    crowd = crowded | (np.bincount(g[stays], minlength=len(begins)) > CROWD)
    wanted = ~later & stays[kind]
    marks.add(WANTED, ids[wanted], tag[wanted], pos[wanted], crowd[group[wanted]].astype(np.uint8))


def _contexts(plan: Plan, want: list[np.ndarray], texts: dict[tuple[int, int], bytes]) -> tuple[np.ndarray, ...]:
    """Matrix of the bytes around each wanted position, bytes of context to its left and right."""
    ids, tag, pos, _ = want
    keys = list(texts)
    begin = dict(zip(keys, np.cumsum([0] + [len(texts[k]) for k in keys[:-1]]).tolist()))
    data = np.frombuffer(b"".join(texts.values()), dtype=np.uint8)
    doc = list(zip(ids.tolist(), tag.tolist()))
    at = np.array([begin[d] for d in doc], dtype=np.int64) + pos
    left = np.minimum(pos, plan.side).astype(np.int64)
    right = np.minimum(np.array([len(texts[d]) for d in doc], dtype=np.int64) - pos, plan.length)
    columns = np.arange(-plan.side, plan.length)[None, :]
    rows = np.empty((len(at), columns.shape[1]), dtype=np.uint8)
    for a in range(0, len(at), 8192):  # the places take far more memory than the bytes
        b = slice(a, a + 8192)
        part = data[np.clip(at[b, None] + columns, 0, len(data) - 1)]
        part[(columns < -left[b, None]) | (columns >= right[b, None])] = 0
        rows[b] = part
    return rows, left, right


def _second_round(plan: Plan):
    """Wanted positions and texts by group in; contexts by bucket out, strings of crowds by their own names."""

    def strings(want, rows, left, right, marks) -> Iterator[pa.RecordBatch]:
        ids, tag, pos, _ = want
        parts = []
        for back in range(plan.side + 1):  # the string that starts so many bytes before the anchor
            ok = np.flatnonzero((back <= left) & (plan.length - back <= right))
            if len(ok):
                sub = rows[ok, plan.side - back : plan.side - back + plan.length]
                second = names_of_rows(sub[:, ::-1], 0, plan.length) >> np.uint64(32)
                parts.append((names_of_rows(sub, 0, plan.length), second.astype(np.uint32), ids[ok], tag[ok], pos[ok] - np.uint32(back)))
        if not parts:
            return
        cols = [np.concatenate(x) for x in zip(*parts)]
        order = np.lexsort((cols[4], cols[3], cols[2], cols[1], cols[0]))
        cols = [c[order] for c in cols]
        cols = [c[runs(*cols)] for c in cols]
        first = runs(cols[0], cols[1])
        least = np.minimum.reduceat(cols[2], np.flatnonzero(first))[np.cumsum(first) - 1]
        later = cols[2] > least
        marks.add(COVERS, cols[2][later], cols[3][later], cols[4][later], np.full(later.sum(), plan.length, np.uint32))
        cols = [c[~later] for c in cols]
        bucket = (cols[0] >> np.uint64(24)).astype(np.int64) % plan.buckets
        yield _record(_by_place(bucket, STRINGS, cols, id_column=2))

    def send(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        want = [np.concatenate(x) for x in zip(*(h[0] for h in held))]
        rows, left, right = (np.concatenate(x) for x in zip(*(h[1] for h in held)))
        marks = Marks(plan)
        crowd = want[3] > 0
        yield from strings([c[crowd] for c in want], rows[crowd], left[crowd], right[crowd], marks)
        ids, tag, pos, _ = (c[~crowd] for c in want)
        rows, left, right = rows[~crowd], left[~crowd], right[~crowd]
        name = names_of_rows(rows, plan.side, plan.name) | np.uint64(1)
        bucket = (name >> np.uint64(32)).astype(np.int64) % plan.buckets
        order = np.argsort(bucket, kind="stable")
        starts = np.flatnonzero(runs(bucket[order]))
        out = []
        for a, b in zip(starts, np.append(starts[1:], len(order))):
            o = order[a:b]
            cols = [name[o], deltas(ids[o], np.array([0])), tag[o], pos[o], left[o].astype(np.uint8), right[o].astype(np.uint8)]
            out.append((int(bucket[o[0]]), CONTEXTS, pack(*cols) + rows[o].tobytes()))
        yield _record(out)
        yield from marks.out()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        place, want, keys, texts, bulk = None, None, frozenset(), {}, 0

        def gather() -> tuple:
            there = np.fromiter(((d, t) in texts for d, t in zip(want[0].tolist(), want[1].tolist())), dtype=bool, count=len(want[0]))
            own = [c[there] for c in want]
            return own, _contexts(plan, own, texts)

        for batch in batches:
            for p, kind, ids, data in zip(*(batch.column(c).to_pylist() for c in ("place", "kind", "doc_id", "data"))):
                if p != place:
                    if texts:
                        held.append(gather())
                        size += len(held[-1][0][0])
                    place, want, keys, texts, bulk, blobs = p, None, frozenset(), {}, 0, []
                if kind == WANTED:
                    blobs.append(data)
                elif kind == TEXT and blobs:
                    if want is None:
                        want = _unpacked(blobs, _WANT)
                        keys = frozenset(zip(want[0].tolist(), want[1].tolist()))
                    key = (ids, plan.tag(ids, data)) if ids is not None else None
                    if key in keys and key not in texts:
                        texts[key] = data
                        bulk += len(data)
                        if bulk >= 4 * PIECE:
                            held.append(gather())
                            size += len(held[-1][0][0])
                            texts, bulk = {}, 0
                if size >= PACKED // 8:
                    yield from send(held)
                    held, size = [], 0
        if texts:
            held.append(gather())
        if held:
            yield from send(held)

    return run


def _settle_contexts(plan: Plan, blobs: dict[int, list[bytes]], marks: Marks) -> None:
    wide = plan.side + plan.length
    if CONTEXTS in blobs:
        parts, matrices = [], []
        for b in blobs[CONTEXTS]:
            p = unpack(b, _CONTEXT)
            p[1] = np.cumsum(p[1])
            parts.append(p)
            matrices.append(np.frombuffer(b, np.uint8)[len(b) - len(p[0]) * wide :].reshape(-1, wide))
        name, ids, tag, pos, left, right = (np.concatenate(x) for x in zip(*parts))
        rows = np.concatenate(matrices)
        nearest, farthest = np.full(len(name), wide), np.full(len(name), -1)
        for back in range(plan.side + 1):
            ok = np.flatnonzero((back <= left) & (plan.length - back <= right))
            if len(ok) < 2:
                continue
            full = names_of_rows(rows[ok], plan.side - back, plan.length)
            order = np.lexsort((full, name[ok]))
            o = ok[order]
            first = runs(name[o], full[order])
            least = np.minimum.reduceat(ids[o], np.flatnonzero(first))[np.cumsum(first) - 1]
            later = o[ids[o] > least]
            nearest[later] = np.minimum(nearest[later], back)
            farthest[later] = np.maximum(farthest[later], back)
        hit = np.flatnonzero(farthest >= 0)  # all strings hold the anchor, so their union has no gap
        marks.add(COVERS, ids[hit], tag[hit], pos[hit] - farthest[hit], farthest[hit] - nearest[hit] + plan.length)
    if STRINGS in blobs:
        one, two, ids, tag, start = _unpacked(blobs[STRINGS], _STRING, None, 2)
        order = np.lexsort((two, one))
        one, two, ids, tag, start = (c[order] for c in (one, two, ids, tag, start))
        first = runs(one, two)
        least = np.minimum.reduceat(ids, np.flatnonzero(first))[np.cumsum(first) - 1]
        later = ids > least
        marks.add(COVERS, ids[later], tag[later], start[later], np.full(later.sum(), plan.length, np.uint32))


def merge(start: np.ndarray, size: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs that the intervals cover."""
    if not len(start):
        return []
    order = np.argsort(start, kind="stable")
    start, end = start[order].astype(np.int64), (start[order].astype(np.int64) + size[order])
    reach = np.maximum.accumulate(end)
    begins = np.concatenate(([True], start[1:] > reach[:-1]))
    at = np.flatnonzero(begins)
    return list(zip(start[at].tolist(), reach[np.append(at[1:] - 1, len(reach) - 1)].tolist()))


def without(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The bytes outside the spans, concatenated."""
    at, parts = 0, []
    for a, b in spans:
        parts.append(data[at:a])
        at = b
    return b"".join((*parts, data[at:]))


def whole_characters(data: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans widened to whole UTF-8 characters."""
    out: list[tuple[int, int]] = []
    for a, b in spans:
        while a > 0 and data[a] & 0xC0 == 0x80:
            a -= 1
        while b < len(data) and data[b] & 0xC0 == 0x80:
            b += 1
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def _cut(plan: Plan):
    """Covers and texts by group in; rest, n_bytes, n_removed, spans, kept_sha256 and the kept text out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, blobs, covers = None, [], None
        for batch in batches:
            picked, out = [], []
            for i, (p, kind, ids, data) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("place", "kind", "doc_id", "data")))):
                if p != place:
                    place, blobs, covers = p, [], None
                if kind == COVERS:
                    blobs.append(data)
                    continue
                if kind != TEXT:
                    continue
                if covers is None:
                    cols = _unpacked(blobs, _COVER)
                    order = np.lexsort((cols[1], cols[0]))
                    cols = [c[order] for c in cols]
                    at = np.flatnonzero(runs(cols[0], cols[1])) if len(order) else np.zeros(0, np.int64)
                    covers = {(int(cols[0][a]), int(cols[1][a])): (cols[2][a:b], cols[3][a:b]) for a, b in zip(at, np.append(at[1:], len(order)))}
                found = covers.get((ids, plan.tag(ids, data))) if ids is not None and covers else None
                spans = merge(*found) if found else []
                picked.append(i)
                kept = without(data, spans)
                text = without(data, whole_characters(data, spans)) if spans else data
                out.append((len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest(), text.decode()))
            if picked:
                rest = batch.column("rest").take(pa.array(picked))
                n_bytes, removed, spans, digest, text = zip(*out)
                spans = pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
                yield pa.RecordBatch.from_arrays(
                    [rest, pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()), spans, pa.array(digest), pa.array(text)],
                    ["rest", "n_bytes", "n_removed", "spans", "kept_sha256", "kept"],
                )

    return run


def remove_repeats(docs: DataFrame, length: int = 50, name: int = 16, keep: list[str] | None = None) -> DataFrame:
    """For every row its doc_id, or a struct ``row`` of the columns ``keep``; n_bytes, n_removed, spans (the maximal
    removed runs, in bytes), kept_sha256 (of the remaining bytes) and kept (the remaining text; a character that loses
    a byte goes whole)."""
    spark = small_batches(docs.sparkSession)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    twins = rows.groupBy("doc_id").agg(F.min(F.xxhash64("text")).alias("a"), F.max(F.xxhash64("text")).alias("b")).where("a <> b")
    found = [r["doc_id"] for r in twins.select("doc_id").limit(100_001).collect()]
    plan = Plan(length, name, partitions, frozenset(found) if len(found) <= 100_000 else None)

    def dealt(blobs: DataFrame, *more: str) -> DataFrame:
        return blobs.repartition(partitions, "place").sortWithinPartitions("place", "kind", *more)

    first = dealt(rows.mapInArrow(_first_round(plan), _BLOBS)).mapInArrow(_settled(plan, _settle_anchors), _BLOBS)
    first = store(first, "repeats-1")
    group = F.coalesce(F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(plan.groups)), F.lit(0)).cast("int").alias("place")
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("data")
    none = F.lit(None).cast("long").alias("doc_id")
    texts = rows.select(group, F.lit(TEXT).alias("kind"), F.col("doc_id").cast("long"), body)
    wanted = first.where(F.col("kind") == WANTED).select("place", "kind", none, "data")
    second = dealt(wanted.union(texts)).mapInArrow(_second_round(plan), _BLOBS)
    second = store(dealt(second).mapInArrow(_settled(plan, _settle_contexts), _BLOBS), "repeats-2")
    rest = F.struct(*(keep or ["doc_id"])).alias("rest")
    texts = docs.select(group, F.lit(TEXT).alias("kind"), F.col("doc_id").cast("long"), body, rest)
    kept = texts.schema["rest"].dataType
    covers = first.union(second).where(F.col("kind") == COVERS).select("place", "kind", none, "data", F.lit(None).cast(kept).alias("rest"))
    schema = f"rest {kept.simpleString()}, n_bytes long, n_removed long, spans array<struct<start:bigint,end:bigint>>, kept_sha256 string, kept string"
    cut = dealt(covers.union(texts)).mapInArrow(_cut(plan), schema)
    return cut.select(F.col("rest").alias("row") if keep else "rest.doc_id", "n_bytes", "n_removed", "spans", "kept_sha256", "kept")


@query("op8_suffix_dedup")
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
