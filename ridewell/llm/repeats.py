"""Suffix-array dedup: bytes inside 50-byte strings that a document with a smaller id also has."""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucketed, by_bucket, mix, partitions, pieces, prefix_sums, spill, stretch, stretches, table, utf8

#: Bytes of an anchor, by which windows of a repeat find each other.
ANCHOR = 20
_PLACE = np.uint64(23)
_PLACES = np.uint64((1 << int(_PLACE)) - 1)
_NONE = np.zeros(0, np.uint64)


def regions(data: np.ndarray, offsets: np.ndarray, width: int, crowded: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor hash, region hash, row, start in the row and length of every region.

    The anchor of a window of `width` bytes is its ANCHOR-byte string of least hash, the first of
    equals. Windows that follow each other with one anchor are a region; each window is in exactly
    one. Equal windows have equal anchors at equal places, so they meet under the anchor's hash, and
    regions with equal bytes are alike in all their windows. Under the anchors of `crowded` (sorted
    hashes) each window is a region by itself, with its own hash in place of the anchor's.
    """
    n, span = len(data), width - ANCHOR + 1
    if n < width:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    sums = prefix_sums(data)
    hashes = stretches(sums, ANCHOR)
    least = hashes & ~_PLACES
    least |= np.arange(len(least), dtype=np.uint64)
    size = 1
    while size * 2 <= span:
        least = np.minimum(least[: len(least) - size], least[size:])
        size *= 2
    if span > size:
        least = np.minimum(least[: len(least) - (span - size)], least[span - size :])
    edge = np.ones(len(least) + width, bool)
    np.not_equal(least[1:], least[:-1], out=edge[1 : len(least)])
    edge[offsets] = True
    edge[np.maximum(offsets[1:] - (width - 1), offsets[:-1])] = True
    first = np.flatnonzero(edge[: len(least)])
    count = np.diff(first, append=len(least))
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(first, offsets)))
    keep = first + width <= offsets[row + 1]
    first, count, row = first[keep], count[keep], row[keep]
    anchor = (least[first] & _PLACES).astype(np.int64)
    length = count + (width - 1)
    content = mix(stretch(sums, first, first + length) + (anchor - first).astype(np.uint64))
    key = hashes[anchor]
    if len(crowded):
        split = crowded[np.minimum(np.searchsorted(crowded, key), len(crowded) - 1)] == key
        many = np.where(split, count, 1)
        of = np.repeat(np.arange(len(first)), many)
        first = first[of] + np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
        split, key, content, length, row = split[of], key[of], content[of], length[of], row[of]
        key[split] = content[split] = stretch(sums, first[split], first[split] + width)
        length[split] = width
    return key, content, row, first - offsets[row], length


def place_of(doc: np.ndarray, parts: int) -> np.ndarray:
    return (doc ^ (doc >> 7) ^ (doc >> 19)) % parts


def place_column(parts: int):
    d = F.col("doc_id")
    return F.pmod(d.bitwiseXOR(F.shiftright(d, 7)).bitwiseXOR(F.shiftright(d, 19)), F.lit(parts)).cast("int")


def merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans in order, those of a document that touch or overlap made one."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    if not len(doc):
        return doc, start, end
    group = np.concatenate([[True], doc[1:] != doc[:-1]])
    # Lifting each document above the one before makes the running maximum restart with it.
    base = (np.cumsum(group) - 1) << 40
    reach = np.maximum.accumulate(end + base)
    first = group.copy()
    first[1:] |= start[1:] + base[1:] > reach[:-1]
    at = np.flatnonzero(first)
    return doc[at], start[at], np.maximum.reduceat(end + base, at) - base[at]


def _rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], ["part", "kind", "packed"])


_FORM = "part int, kind int, packed binary"
_SPANS, _LEADERS, _ASKED, _TEXTS = range(4)


def _pack(*columns: np.ndarray) -> bytes:
    """Columns one after the other, behind their number of rows; each in its own width."""
    return b"".join([len(columns[0]).to_bytes(4, "little"), *(c.tobytes() for c in columns)])


def _unpack(packed: bytes, *types: str) -> list[np.ndarray]:
    n, at, out = int.from_bytes(packed[:4], "little"), 4, []
    for t in types:
        out.append(np.frombuffer(packed, t, n, at))
        at += n * np.dtype(t).itemsize
    return out


def _gather(blobs: list[bytes], *types: str) -> list[np.ndarray]:
    parts = [_unpack(b, *types) for b in blobs]
    return [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, t) for i, t in enumerate(types)]


def _span_rows(doc: np.ndarray, start: np.ndarray, end: np.ndarray, parts: int) -> list[tuple[int, int, bytes]]:
    doc, start, end = merged(doc, start, end)
    return [(b, _SPANS, _pack(d, s.astype(np.uint32), (e - s).astype(np.uint32))) for b, (d, s, e) in by_bucket(place_of(doc, parts), parts, doc, start, end)]


def _classes(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by key, where in it each class of equals begins, and how many it has."""
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(len(key), 1), bool), key[1:] != key[:-1]]))
    return order, first, np.diff(first, append=len(key))


def _leads(content: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which rows have their content's smallest document."""
    order, first, size = _classes(content)
    out, doc = np.zeros(len(doc), bool), doc[order]
    if len(first):
        out[order] = doc == np.repeat(np.minimum.reduceat(doc, first), size)
    return out


def _regions(batches: Iterator[pa.RecordBatch], width: int, crowded: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Anchor hash, region hash, document, start and length of the regions of a slice of texts at a time."""
    for batch in batches:
        for part in pieces(batch, "text", 1 << 17):
            ids = np.asarray(part["doc_id"].cast(pa.int64()))
            data, offsets = utf8(part["text"])
            most = 1 << int(_PLACE)
            if len(data) < most:
                h, c, r, s, n = regions(data, offsets, width, crowded)
                yield h, c, ids[r], s, n
            else:  # one long text, in slices that overlap by what a window needs
                for a in range(0, len(data), most - width):
                    cut = data[a : a + most - 1]
                    h, c, r, s, n = regions(cut, np.array([0, len(cut)]), width, crowded)
                    yield h, c, ids[r], s + a, n


def _crowds(batches: Iterator[pa.RecordBatch], width: int, least: int, flush: int = 1_200_000) -> Iterator[pa.RecordBatch]:
    """Anchors with `least` different regions or more in a stretch of a task's texts, and how many.

    What stays untold is less than `least` of each `flush` regions, far less than a part's share.
    """
    held: list[tuple[np.ndarray, ...]] = []
    rows = 0

    def counted() -> pa.RecordBatch:
        anchor, content = map(np.concatenate, zip(*held, strict=True))
        held.clear()
        order, first, _ = _classes(content)
        anchor, n = np.unique(anchor[order[first]], return_counts=True)
        many = n >= least
        return pa.RecordBatch.from_arrays([pa.array(anchor[many].view(np.int64)), pa.array(n[many], pa.int64())], ["anchor", "n"])

    for h, c, *_ in _regions(batches, width, _NONE):
        held.append((h, c))
        rows += len(h)
        if rows > flush:
            yield counted()
            rows = 0
    if held:
        yield counted()


def _anchors(batches: Iterator[pa.RecordBatch], width: int, parts: int, crowded: np.ndarray, flush: int = 1_200_000) -> Iterator[pa.RecordBatch]:
    """Regions of the texts by anchor. Of equal regions in a task only those of the smallest document go on.

    The others lie in a larger document than an equal region does, so all their bytes go.
    """
    held: list[tuple[np.ndarray, ...]] = []
    waiting = 0

    def sent() -> pa.RecordBatch:
        anchor, content, doc, start, length = map(np.concatenate, zip(*held, strict=True))
        held.clear()
        leads = _leads(content, doc)
        rows = _span_rows(doc[~leads], start[~leads], start[~leads] + length[~leads], parts)
        anchor = anchor[leads]
        bucket = ((anchor >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
        # The regions of a document follow each other, and do so in each bucket.
        for b, (h, c, d, s, n) in by_bucket(bucket, parts, anchor, content[leads], doc[leads], start[leads], length[leads]):
            at = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
            rows.append((b, _LEADERS, _pack(d[at], np.diff(at, append=len(d)).astype(np.uint32)) + _pack(h.astype(np.uint32), c, s.astype(np.uint32), n.astype(np.uint8))))
        return _rows(rows)

    for made in _regions(batches, width, crowded):
        held.append(made)
        waiting += len(made[0])
        if waiting > flush:
            yield sent()
            waiting = 0
    if held:
        yield sent()


def _meet(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Equal regions again give spans; unequal ones under one anchor ask for their texts.

    Windows of crowded anchors, known by their key, all ask: a task has sent those of one document.
    """
    blobs: list[bytes] = []
    for batch in batches:
        for part, kind, packed in zip(*(batch[c].to_pylist() for c in ("part", "kind", "packed")), strict=True):
            if kind == _SPANS:
                yield _rows([(part, kind, packed)])
            else:
                blobs.append(packed)
    if not blobs:
        return
    docs, columns = [], []
    for b in blobs:
        d, n = _unpack(b, "<i8", "<u4")
        docs.append(np.repeat(d, n))
        columns.append(_unpack(b[4 + 12 * len(d) :], "<u4", "<u8", "<u4", "u1"))
    blobs.clear()
    doc = np.concatenate(docs)
    anchor, content, start, length = (np.concatenate([c[i] for c in columns]) for i in range(4))
    columns.clear()
    leads = _leads(content, doc) | (anchor == content.astype(np.uint32))
    start = start.astype(np.int64)
    rows = _span_rows(doc[~leads], start[~leads], start[~leads] + length[~leads], parts)
    doc, anchor, start, length = doc[leads], anchor[leads], start[leads], length[leads]
    order, first, size = _classes(anchor)
    if len(first):
        owner = doc[order]
        ask = order[np.repeat(np.minimum.reduceat(owner, first) != np.maximum.reduceat(owner, first), size)]
        for b, (dd, ss, nn, hh) in by_bucket(place_of(doc[ask], parts), parts, doc[ask], start[ask], length[ask], anchor[ask]):
            rows.append((b, _ASKED, _pack(dd, ss.astype(np.uint32), nn, hh)))
    for a in range(0, len(rows), 500):
        yield _rows(rows[a : a + 500])


def _stretched(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places start to start + size of each row, one row after the other."""
    end = np.cumsum(size, dtype=np.int64)
    return np.repeat(start - (end - size), size) + np.arange(end[-1] if len(end) else 0)


def _fetch(parts: int, key, texts: pa.Table, asked: pa.Table) -> pa.Table:
    """The texts that were asked for, dealt out by their anchors."""
    doc, start, length, anchor = _gather(asked["packed"].to_pylist(), "<i8", "<u4", "u1", "<u4")
    ids, row = np.unique(texts["doc_id"].to_numpy(), return_index=True)
    if not len(ids):
        return pa.Table.from_batches([_rows([])])
    at = np.minimum(np.searchsorted(ids, doc), len(ids) - 1)
    there = ids[at] == doc
    row, doc, start, length, anchor = row[at][there], doc[there], start[there], length[there], anchor[there]
    order = np.argsort(row)
    row, doc, start, length, anchor = row[order], doc[order], start[order], length[order], anchor[order]
    found, a, below = [np.zeros(0, np.uint8)], 0, 0
    for batch in texts.select(["text"]).to_batches():
        data, offsets = utf8(batch["text"])
        b = int(np.searchsorted(row, below + len(batch)))
        found.append(data[_stretched(offsets[row[a:b] - below] + start[a:b], length[a:b])])
        a, below = b, below + len(batch)
    data, begin = np.concatenate(found), np.cumsum(length, dtype=np.int64) - length
    rows = []
    bucket = (mix(anchor.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
    for b, (d, s, n, h, t) in by_bucket(bucket, parts, doc, start, length, anchor, begin):
        rows.append((b, _TEXTS, _pack(d, s, n, h) + data[_stretched(t, n)].tobytes()))
    return pa.Table.from_batches([_rows(rows)])


class _Columns:
    """Columns of the growing transform in sequential files: each round reads them once and writes them once."""

    def __init__(self, folder: str, **types: str):
        self.files = {k: (tempfile.TemporaryFile(dir=folder), t) for k, t in types.items()}  # noqa: SIM115

    def read(self, name: str) -> np.ndarray:
        file, kind = self.files[name]
        file.seek(0)
        return np.frombuffer(file.read(), kind)

    def write(self, name: str, values: np.ndarray) -> None:
        file, kind = self.files[name]
        file.seek(0)
        file.truncate()
        file.write(np.ascontiguousarray(values, kind).data)

    def close(self) -> None:
        for file, _ in self.files.values():
            file.close()


def transform(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """symbol, common prefix with the row before, string and suffix length of each row of the collection's sorted suffixes.

    Column-wise: round j inserts for every string the symbol before its suffix of length j, at that
    suffix's row. Where the suffix longer by that symbol goes follows from how often the symbol
    occurs above; what it shares with the rows around it is one more than the least common prefix
    between their places in this round. Symbol 0 ends a string; ends are all different.
    """
    n = len(strings)
    sizes = np.array([len(s) for s in strings])
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(strings), np.uint8)
    with tempfile.TemporaryDirectory() as folder:
        held = _Columns(folder, symbol="u2", common="u2", string="<i4", suffix="u2")
        alive, rows = np.arange(n), np.arange(n)
        above, below, next_row = np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, -1)
        for j in range(int(sizes.max(initial=0)) + 1):
            over = sizes[alive] == j
            symbol = np.where(over, 0, data[np.minimum(ends[alive] - j - 1, len(data) - 1)].astype(np.int64) + 1)
            old = held.read("symbol")
            fresh = np.zeros(len(old) + len(rows), bool)
            fresh[rows] = True
            made = {}
            for name, values in (("symbol", symbol), ("common", above), ("string", alive), ("suffix", np.full(len(rows), j))):
                column = np.empty(len(fresh), held.files[name][1])
                column[~fresh] = old if name == "symbol" else held.read(name)
                column[fresh] = values[np.argsort(rows)] if name != "common" else 0
                made[name] = column
            made["common"][rows] = above
            after = next_row >= 0
            made["common"][next_row[after]] = below[after]
            for name, column in made.items():
                held.write(name, column)
            symbols, common = made["symbol"], made["common"]
            order = np.argsort(symbols, kind="stable")
            none = int((symbols == 0).sum())
            to = np.empty(len(symbols), np.int64)
            to[order] = np.arange(len(symbols))
            go = ~over
            alive, place, symbol = alive[go], rows[go], symbol[go]
            if not len(alive):
                break
            at = to[place]
            rows = n + at - none
            same_up = (at > none) & (symbols[order[at - 1]] == symbol)
            down = np.minimum(at + 1, len(order) - 1)
            same_down = (at + 1 < len(order)) & (symbols[order[down]] == symbol)
            above = np.where(same_up, 1 + _least(common, order[at - 1], place, symbol), 0)
            below = np.where(same_down, 1 + _least(common, place, order[down], symbol), 0)
            # A row already there that comes next learns its new common prefix; new ones have their own.
            next_row = np.where(at + 1 < len(order), rows + 1, -1)
        out = tuple(held.read(k) for k in ("symbol", "common", "string", "suffix"))
        held.close()
    return out


def _least(common: np.ndarray, first: np.ndarray, last: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """The least common prefix in rows first + 1 to last, for each pair of rows of one symbol."""
    out = np.zeros(len(first), np.int64)
    order = np.lexsort((last, symbol))
    a, b = np.minimum(first[order] + 1, len(common) - 1), last[order]
    bad = a > b
    a = np.where(bad, b, a)
    padded = np.append(common, 0)
    out[order] = np.minimum.reduceat(padded, np.column_stack([a, b + 1]).ravel())[::2]
    return out


def repeated(data: np.ndarray, start: np.ndarray, size: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(string, offset) of every window that a string of a smaller document holds too.

    The transform column by column, as in transform(), of strings laid out by their anchors. Equal
    windows have equal anchors at equal places, so only suffixes that begin at one place from the
    anchor are sorted among each other: a round handles each string once, whatever rounds went
    before. It puts the symbol before each suffix in front, which sorts the longer suffixes stably
    by it; what neighbours share is one more than the least common prefix between their places in
    the round before. Symbol 0 stands where a string is not; no window reaches there. Bytes of
    UTF-8 are below 255.
    """
    n, before = len(size), width - ANCHOR
    at = start + np.arange(before + 1)[:, None]
    place = (stretch(prefix_sums(data), at, at + ANCHOR) & ~_PLACES).argmin(0)
    zero, behind = start + place, size - place
    order, common = np.arange(n), np.zeros(n + 1, np.uint8)
    edges, same = np.zeros(n + 1, np.int64), np.zeros(n, bool)
    strings, offsets = [], []
    for at in range(width - 1, -before - 1, -1):
        inside = behind[order] > at if at >= 0 else place[order] >= -at
        symbol = np.where(inside, data[np.clip(zero[order] + at, 0, len(data) - 1)] + np.uint8(1), np.uint8(0))
        to = np.argsort(symbol, kind="stable")
        order, symbol = order[to], symbol[to]
        np.add(to, 1, out=edges[1:])
        np.equal(symbol[1:], symbol[:-1], out=same[1:])
        # Of rows of one symbol, each begins behind the one above; at other rows nothing is shared.
        common[:n] = (np.minimum.reduceat(common, edges)[:n] + np.uint8(1)) * same
        if at > 0:
            continue
        run = np.flatnonzero(common[:n] < width)
        owner = doc[order]
        found = owner > np.repeat(np.minimum.reduceat(owner, run), np.diff(run, append=n))
        found &= (place[order] >= -at) & (behind[order] >= width + at)
        strings.append(order[found])
        offsets.append(place[order[found]] + at)
    return np.concatenate(strings), np.concatenate(offsets)


def _resolve(batches: Iterator[pa.RecordBatch], width: int, parts: int, least: int = 1 << 14) -> Iterator[pa.RecordBatch]:
    """Spans of the windows that repeat among a part's strings.

    Strings of different anchors have no window in common, so the collection of whole anchors from
    `least` strings on is sorted by itself, while its columns still fit a processor's cache.
    """
    columns, texts = [], []
    for batch in batches:
        for packed in batch["packed"].to_pylist():
            columns.append(_unpack(packed, "<i8", "<u4", "u1", "<u4"))
            texts.append(packed[4 + 17 * len(columns[-1][0]) :])
    if not columns:
        return
    doc, start, size, anchor = (np.concatenate([c[i] for c in columns]) for i in range(4))
    start, size = start.astype(np.int64), size.astype(np.int64)
    data, begin = np.frombuffer(b"".join(texts), np.uint8), np.cumsum(size) - size
    columns.clear()
    texts.clear()
    order, first, _ = _classes(anchor)
    edges = np.append(first, len(order))
    a = 0
    while a < len(order):
        b = int(edges[min(np.searchsorted(edges, a + least), len(edges) - 1)])
        mine = order[a:b]
        string, offset = repeated(data[_stretched(begin[mine], size[mine])], np.cumsum(size[mine]) - size[mine], size[mine], doc[mine], width)
        at = start[mine][string] + offset
        yield _rows(_span_rows(doc[mine][string], at, at + width, parts))
        a = b


def _cut(key, texts: pa.Table, spans: pa.Table) -> pa.Table:
    """What is left of each text of a part."""
    doc, start, size = _gather(spans["packed"].to_pylist(), "<i8", "<u4", "<u4")
    doc, start, end = merged(doc, start.astype(np.int64), start.astype(np.int64) + size)
    out = []
    for d, text in zip(texts["doc_id"].to_pylist(), texts["text"].to_pylist(), strict=True):
        raw = (text or "").encode()
        a, b = np.searchsorted(doc, [d, d + 1])
        left, at, gone = [], 0, 0
        for s, e in zip(start[a:b].tolist(), end[a:b].tolist(), strict=True):
            left.append(raw[at:s])
            at, gone = e, gone + e - s
        left.append(raw[at:])
        out.append((d, len(raw), gone, int(b - a), b"".join(left)))
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    return pa.table({k: pa.array([r[i] for r in out], pa.binary() if k == "kept" else pa.int64()) for i, k in enumerate(names)})


def remove_repeats(docs: DataFrame, width: int = 50, crowd: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept, the bytes that are left, of every row of docs (doc_id, text).

    A byte goes if a string of `width` bytes over it also starts in a document with a smaller
    doc_id; the input decides, not what is left. Texts are UTF-8 bytes, null is empty. Rows that
    repeat a doc_id must repeat its text; they stay alike. Rows with a null doc_id lose nothing and
    take nothing. Other columns are ignored; an empty table gives an empty result.

    Windows are grouped in regions under anchors, see regions(). Equal regions, the bulk of any copy,
    collapse to the one of the smallest document, in the task and then under the anchor, so that a
    text with very many copies never gathers anywhere. The different regions under one anchor,
    of `width` to 2 * width bytes, are the collection whose suffixes repeated() sorts. Anchors of
    more than `crowd` different regions, as over the borders of a common passage, are counted first:
    their windows meet one by one, those of the smallest document in each task, so that such a
    collection grows with the tasks and not with the documents. A region's length is a byte, so
    widths go from ANCHOR to 137; others are refused.
    """
    if not ANCHOR <= width <= 137:
        raise ValueError(f"width {width}: from {ANCHOR} to 137 bytes")
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    named = docs.filter("doc_id is not null")
    mb = (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / 1e6
    parts = partitions(spark, mb)
    texts = bucketed(named.withColumn("part", place_column(parts)), "part", parts)
    crowds = named.mapInArrow(partial(_crowds, width=width, least=max(1, crowd // 512)), "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    # At most 8 bytes for `crowd` regions of the input.
    crowded = np.sort(crowds.filter(F.col("n") > crowd).select("anchor").toArrow()["anchor"].to_numpy().astype(np.int64).view(np.uint64))
    met = named.mapInArrow(partial(_anchors, width=width, parts=parts, crowded=crowded), _FORM).repartitionById(parts, F.col("part")).mapInArrow(partial(_meet, parts=parts), _FORM)
    met = spill(met)
    asked = met.filter(F.col("kind") == _ASKED)
    fetched = texts.groupBy("part").cogroup(asked.groupBy("part")).applyInArrow(lambda k, a, b: _fetch(parts, k, a, b), _FORM)
    solved = fetched.repartitionById(parts, F.col("part")).mapInArrow(partial(_resolve, width=width, parts=parts), _FORM)
    spans = met.filter(F.col("kind") == _SPANS).unionByName(solved)
    done = texts.groupBy("part").cogroup(spans.groupBy("part")).applyInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    zero = F.lit(0).cast("long")
    rest = docs.filter("doc_id is null").select(F.col("doc_id").cast("long"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.coalesce("text", F.lit("")).cast("binary").alias("kept"))
    return done.unionByName(rest)


def op4(spark, sf_dir: str) -> DataFrame:
    kept = remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(texts: dict[int, str | None], width: int) -> dict[int, tuple[int, int, int, str]]:
    """The same for a few texts, window by window."""
    first: dict[bytes, int] = {}
    raws = {d: (t or "").encode() for d, t in texts.items()}
    for d in sorted(raws):
        for i in range(len(raws[d]) - width + 1):
            first.setdefault(raws[d][i : i + width], d)
    out = {}
    for d, raw in raws.items():
        gone = bytearray(len(raw) + 1)
        for i in range(len(raw) - width + 1):
            if first[raw[i : i + width]] < d:
                gone[i : i + width] = b"\1" * width
        spans = sum(1 for i in range(len(raw)) if gone[i] and (i == 0 or not gone[i - 1]))
        left = bytes(b for i, b in enumerate(raw) if not gone[i])
        out[d] = (len(raw), sum(gone), spans, hashlib.sha256(left).hexdigest())
    return out
