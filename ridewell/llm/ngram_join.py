"""N-gram Jaccard join: universe partitions by size band, pigeonhole signatures, exact verification."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_bucket, components, mix, partitions, pieces, shingle_sets, spill, table, utf8

#: Documents of a block; two blocks are verified together.
BLOCK = 256
#: Segments whose signatures go together.
STRETCH = 16


class Bands:
    """Size bands such that two linked sets lie in one band or in two that follow each other."""

    def __init__(self, num: int, den: int, largest: int):
        self.num, self.den, self.low, low = num, den, [], 1
        while low <= largest:
            self.low.append(low)
            low = low * den // num + 1
        self.low += [low, low * den // num + 1]

    def of(self, n: int) -> int:
        return int(np.searchsorted(self.low, n, "right")) - 1

    def differ(self, g: int) -> int:
        """The most tokens in which two linked sets of group g (bands g and g - 1) differ."""
        return self.apart(2 * (self.low[g + 1] - 1))

    def apart(self, sizes: int) -> int:
        """The most tokens in which two linked sets differ whose sizes sum to `sizes`."""
        return (self.den - self.num) * sizes // (self.den + self.num)


def allocate(differ: int, size: int, population: int, common: float = 0.25, kin: float = 0.02) -> tuple[int, int, int]:
    """Numbers of plain segments and of segments with one-deletion neighbourhoods, and `differ`, at least cost.

    By the pigeonhole, segments that allow 0 or 1 differing tokens suffice when plain + 2 * deletion
    exceeds `differ`. Empty segments tell nothing, and where a set has enough others it is found
    without them, so there are a few plain segments more than that, as many as will likely be empty,
    and without deletions a seventh more, so that linked sets share several.
    Cost: signatures of a set, and partners it meets for want of a token of its own in enough
    segments, where a share `kin` of the population has a share `common` of its tokens from the same
    passages; that falls as segments get larger, so small sets of large populations get deletions.
    """
    best = None
    for deletion in sorted({round((differ + 1) * f / 2) for f in (0, 0.25, 0.5, 0.75, 1)}):
        plain = max(0, differ + 1 - 2 * deletion)
        void = plain * math.exp(-size / (plain + deletion))
        spare = 0 if deletion else math.ceil((differ + 1) / 7)
        plain += math.ceil(void + 3 * math.sqrt(void)) + spare if plain else 0
        m = plain + deletion
        mean = size / m
        chance = math.exp(-2 * mean * (1 - common)) * (plain + deletion * (1 + mean))
        # At least spare + 1 of so many chance matches, by Chernoff.
        need = spare + 1
        met = min(1.0, chance) if need == 1 else min(1.0, math.exp(min(0.0, need - chance - need * math.log(need / chance))) if need > chance else 1.0)
        cost = plain + deletion * (1 + mean) + kin * population * met
        if best is None or cost < best[0]:
            best = cost, plain, deletion
    return best[1], best[2], differ


def spread(plan: dict[int, tuple[int, int, int]], population: dict[int, int], lows: list[int], most: int = 2_000_000) -> dict[int, int]:
    """In how many buckets the signatures of STRETCH segments of a group go, so that none has many more than `most`.

    A set's signatures under one bucket share a head, so there are no more buckets than that.
    """
    out = {}
    for g, (plain, deletion, _) in plan.items():
        people = population.get(g, 0) + population.get(g - 1, 0)
        each = min(STRETCH, plain + deletion) * (1 + (lows[g] / (plain + deletion) if deletion else 0))
        out[g] = max(1, math.ceil(people * each / most))
    return out


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices with the edges of their rows' sets, the sets' hashes and node ids."""
    for batch in batches:
        for part in pieces(batch, "text", 1 << 20):
            row, hashes = shingle_sets(*utf8(part["text"]), k)
            edges = np.searchsorted(row, np.arange(part.num_rows + 1))
            nodes = np.fromiter((int.from_bytes(hashlib.blake2b(hashes[a:b].tobytes(), digest_size=8).digest(), "little", signed=True) for a, b in zip(edges[:-1], edges[1:], strict=True)), np.int64, part.num_rows)
            yield part, edges, hashes, nodes


def _nodes(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for part, _, _, nodes in _sets(batches, k):
        yield pa.RecordBatch.from_arrays([part["text"], pa.array(nodes)], ["text", "node"])


def _classes(batches: Iterator[pa.RecordBatch], k: int, bands: Bands) -> Iterator[pa.RecordBatch]:
    """doc_id, text hash, size and node of each set, and how its tokens fall into the cells of its two groups."""
    for part, edges, hashes, nodes in _sets(batches, k):
        sketches: tuple[list[bytes], list[bytes]] = ([], [])
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            band = bands.of(b - a) if b > a else 0
            spread = mix(hashes[a:b] ^ np.uint64(0x5BD1E995)) >> np.uint64(33)
            for i in (0, 1):
                cells = max(8, bands.low[band + i] // 3)
                sketches[i].append(np.minimum(np.bincount((spread % np.uint64(cells)).astype(np.int64), minlength=cells), 255).astype(np.uint8).tobytes())
        columns = [part["doc_id"].cast(pa.int64()), part["same"], pa.array(np.diff(edges)), pa.array(nodes), *(pa.array(x, pa.binary()) for x in sketches)]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "same", "n_shingles", "node", "sketch", "next_sketch"])


def _near(batches: Iterator[pa.RecordBatch], bands: Bands) -> Iterator[pa.RecordBatch]:
    """Of the nodes of each block pair and group, those whose sketch is not too far from some partner's.

    Where two sets differ in the number of tokens of a cell, they differ in as many tokens at least.
    """

    def done(key: tuple, rows: list[tuple]) -> list[tuple]:
        side = np.array([r[0] for r in rows])
        size = np.array([r[2] for r in rows])
        cells = np.frombuffer(b"".join(r[3] for r in rows), np.uint8).reshape(len(rows), -1).astype(np.int16)
        two = bool(side.any())
        found = np.zeros(len(rows), bool)
        for i in np.flatnonzero(side == 0):
            other = np.flatnonzero(side == 1) if two else np.arange(i + 1, len(rows))
            most = (bands.den - bands.num) * (size[other] + size[i]) // (bands.den + bands.num)
            other, most = other[np.abs(size[other] - size[i]) <= most], most[np.abs(size[other] - size[i]) <= most]
            hit = other[np.abs(cells[other] - cells[i]).sum(1) <= most]
            found[hit] = True
            found[i] |= len(hit) > 0
        return [(rows[i][1], key[0], key[1], rows[i][0]) for i in np.flatnonzero(found)]

    key, held = None, []
    for batch in batches:
        out = []
        for bi, bj, band, *row in zip(*(batch[c].to_pylist() for c in ("bi", "bj", "band", "side", "node", "n_shingles", "sketch")), strict=True):
            if (bi, bj, band) != key:
                out += done(key, held) if len(held) > 1 else []
                key, held = (bi, bj, band), []
            held.append(row)
        yield _asks(out)
    yield _asks(done(key, held) if len(held) > 1 else [])


def _asks(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.int32()))], ["node", "bi", "bj", "side"])


def pack(sigs: list[np.ndarray], places: list[np.ndarray], heads: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    """Signatures by bucket: heads (node, kind, need, count) and four bytes of each of their signatures. Empties the lists."""
    sig, place, names, counts = np.concatenate(sigs), np.concatenate(places), np.array([h[:3] for h in heads], np.int64), [h[3] for h in heads]
    head = np.repeat(np.arange(len(heads)), counts)
    for x in (sigs, places, heads):
        x.clear()
    buckets, code = np.unique(place, return_inverse=True)
    rows = []
    for x, (own_head, own_sig) in by_bucket(code, len(buckets), head, sig.astype(np.uint32)):
        which, n = np.unique(own_head, return_counts=True)  # by_bucket keeps the order, so heads ascend
        node, kind, need = names[which].T
        rows.append((int(buckets[x]), b"".join((np.uint32(len(which)).tobytes(), node.tobytes(), kind.astype(np.uint16).tobytes(), need.astype(np.uint8).tobytes(), n.astype(np.uint32).tobytes(), own_sig.tobytes()))))
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["bucket", "packed"])


def places_of(sig: np.ndarray, at: np.ndarray, g: int, subs: int) -> np.ndarray:
    """Buckets of signatures at so many segments of group g: by stretch of segments, and by head where a stretch is dealt to several."""
    return (mix(((sig >> np.uint64(32)) % np.uint64(subs) << np.uint64(40)) + (at // STRETCH).astype(np.uint64) + np.uint64(g << 24)) >> np.uint64(33)).astype(np.int64)


def _segments(batches: Iterator[pa.RecordBatch], k: int, bands: Bands, plan: dict[int, tuple[int, int, int]], subs: dict[int, int], recent: int = 100_000, flush: int = 400_000) -> Iterator[pa.RecordBatch]:
    """Signatures by bucket, packed: heads (node, kind, need, count) and four bytes of each of their signatures.

    An odd kind lacks one token, kind // 2 is the group. A node that a task has met among its last
    `recent` ones sends nothing again, so that many copies of a text weigh little.
    """
    golden = np.uint64(0x9E3779B97F4A7C15)
    seen: set[int] = set()
    sigs: list[np.ndarray] = []
    places: list[np.ndarray] = []
    heads: list[tuple[int, int, int, int]] = []

    for _, edges, hashes, nodes in _sets(batches, k):
        for a, b, node in zip(edges[:-1], edges[1:], nodes.tolist(), strict=True):
            if a == b or node in seen:
                continue
            if len(seen) >= recent:
                seen.clear()
            seen.add(node)
            mine = hashes[a:b]
            band = bands.of(b - a)
            for g in (band, band + 1):
                if g not in plan:
                    continue
                plain, deletion, differ = plan[g]
                m = plain + deletion
                segment = (mix(mine + np.uint64(g)) >> np.uint64(33)).astype(np.int64) % m
                order = np.argsort(segment, kind="stable")
                seg, tok = segment[order], mix(mine[order])
                sums = np.zeros(len(tok) + 1, np.uint64)
                np.cumsum(tok, out=sums[1:])
                at = np.searchsorted(seg, np.arange(m + 1))
                totals = sums[at[1:]] - sums[at[:-1]]
                salt = mix((np.arange(m, dtype=np.uint64) << np.uint64(16)) + np.uint64(g)) * golden
                full = at[1:] > at[:-1]
                size, own = b - a, int(full[:plain].sum())
                # Each plain segment with a token that the partner's is unlike is a differing token.
                widest = min(bands.low[g + 1] - 1, size * bands.den // bands.num)
                need = 1 if deletion else max(1, own - bands.apart(size + widest))
                if own + 2 * deletion <= differ:
                    full[:] = True  # too few to find every partner by: its empty segments count, too
                    need = 1
                full[plain:] = True
                parts = [(mix(totals + salt)[full], np.flatnonzero(full))]
                if deletion:
                    dropped = seg >= plain
                    parts.append((mix(totals[seg[dropped]] - tok[dropped] + salt[seg[dropped]]), seg[dropped]))
                for kind, (x, at) in enumerate(parts):
                    sigs.append(x)
                    places.append(places_of(x, at, g, subs[g]))
                    heads.append((node, 2 * g + kind, min(need, 255), len(x)))
        if sum(map(len, sigs)) > flush:
            yield pack(sigs, places, heads)
    if sigs:
        yield pack(sigs, places, heads)


def _unpacked(bucket: int, x: bytes) -> tuple[np.ndarray, ...]:
    """Signature, node, kind and need of each packed signature; only those of a group can be equal."""
    h = int(np.frombuffer(x, np.uint32, 1)[0])
    node, kind = np.frombuffer(x, np.int64, h, 4), np.frombuffer(x, np.uint16, h, 4 + 8 * h)
    need, n = np.frombuffer(x, np.uint8, h, 4 + 10 * h), np.frombuffer(x, np.uint32, h, 4 + 11 * h)
    low = np.frombuffer(x, np.uint32, -1, 4 + 15 * h).astype(np.uint64)
    kind = np.repeat(kind, n)
    sig = mix((low | (kind // 2).astype(np.uint64) << np.uint64(32)) + mix(np.array([bucket + 1], np.uint64))[0])
    return sig, np.repeat(node, n), kind, np.repeat(need, n)


def _shared(batches: Iterator[pa.RecordBatch], most: int = 3_000_000) -> Iterator[pa.RecordBatch]:
    """Members of the signatures that two nodes or more share, each with the signature's centre, a first node.

    Signatures are merged `most` at a time into those met before, of which one node is held, so that
    memory grows with the signatures of a bucket, not with the members of one. A member may come
    once for each merge. `whole`: its signature lacks no token; `pair`: its or the centre's lacks none.
    Where one merge is all, signatures that every member has by leaving a token out are left out.
    """
    held = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint16), np.zeros(0, np.uint8), np.zeros(0, bool))

    def rows(sig, node, kind, need, centre, pair) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(sig), 1 << 16):
            part = slice(a, a + (1 << 16))
            columns = (sig[part].view(np.int64), node[part], (kind[part] // 2).astype(np.int32), need[part].astype(np.int32), centre[part], kind[part] % 2 == 0, pair[part])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["sig", "node", "band", "need", "centre", "whole", "pair"])

    def merged(parts: list[tuple[np.ndarray, ...]], only: bool = False) -> Iterator[pa.RecordBatch]:
        nonlocal held
        sig, node, kind, need = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((kind, node, sig))
        sig, node, kind, need = sig[order], node[order], kind[order], need[order]
        keep = np.ones(len(sig), bool)
        keep[1:] = (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])
        sig, node, kind, need = sig[keep], node[keep], kind[keep], need[keep]
        start = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        size = np.diff(start, append=len(sig))
        if only:
            able = (np.logical_or.reduceat(kind % 2 == 0, start) & (size > 1)) if len(start) else np.zeros(0, bool)
            pick = np.repeat(able, size)
            sig, node, kind, need, size = sig[pick], node[pick], kind[pick], need[pick], size[able]
            start = np.cumsum(size) - size
        hsig, hnode, hkind, hneed, told = held
        at = np.searchsorted(hsig, sig[start])
        old = np.zeros(len(start), bool)
        if len(hsig):
            old = hsig[np.minimum(at, len(hsig) - 1)] == sig[start]
        at = np.where(old, at, 0)
        centre, lead = node[start].copy(), kind[start].copy()
        if old.any():
            centre[old], lead[old] = hnode[at[old]], hkind[at[old]]
        group = np.repeat(np.arange(len(start)), size)
        other = node != centre[group]
        pair = (kind % 2 == 0) | (lead[group] % 2 == 0)
        yield from rows(sig[other], node[other], kind[other], need[other], centre[group][other], pair[other])
        met = np.bincount(group[other], minlength=len(start)) > 0
        # The centre's own row, once.
        first = met & ~old
        yield from rows(sig[start][first], node[start][first], kind[start][first], need[start][first], centre[first], np.ones(int(first.sum()), bool))
        late = np.flatnonzero(met & old)
        late = late[~told[at[late]]]
        yield from rows(sig[start][late], centre[late], lead[late], hneed[at[late]], centre[late], np.ones(len(late), bool))
        told[at[late]] = True
        new = ~old
        fresh = (sig[start][new], node[start][new], kind[start][new], need[start][new], met[new])
        if len(hsig):
            order = np.argsort(np.concatenate([hsig, fresh[0]]), kind="stable")
            held = tuple(np.concatenate([x, y])[order] for x, y in zip((hsig, hnode, hkind, hneed, told), fresh, strict=True))
        else:
            held = fresh

    parts, n = [], 0
    for batch in batches:
        for bucket, x in zip(batch["bucket"].to_pylist(), batch["packed"].to_pylist(), strict=True):
            parts.append(_unpacked(bucket, x))
            n += len(parts[-1][0])
            if n >= most:
                yield from merged(parts)
                parts, n = [], 0
    if parts:
        yield from merged(parts, only=not len(held[0]))


def _set_rows(batches: Iterator[pa.RecordBatch], k: int, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The sets of candidates, once for each block pair that asks for them."""

    def made(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["bi", "bj", "side", "node", "tokens"])

    for part, edges, hashes, nodes in _sets(batches, k):
        rows, held = [], 0
        for a, b, node, meant, asks in zip(edges[:-1], edges[1:], nodes.tolist(), part["node"].to_pylist(), part["asks"].to_pylist(), strict=True):
            tokens = hashes[a:b].tobytes()
            for x in asks if node == meant else ():
                rows.append((x["bi"], x["bj"], x["side"], node, tokens))
                held += len(tokens)
                if held > most:
                    yield made(rows)
                    rows, held = [], 0
        if rows:
            yield made(rows)


def _links(left: list[np.ndarray], right: list[np.ndarray] | None, num: int, den: int) -> np.ndarray:
    """Pairs (i, j) of linked sets, by counts of common tokens over slices of the shared tokens."""
    all_sets = left + (right or [])
    size = np.array([len(x) for x in all_sets])
    token = np.concatenate(all_sets)
    owner = np.repeat(np.arange(len(all_sets)), size)
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    start = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    many = np.diff(start, append=len(token))
    column = np.repeat(np.where(many > 1, np.cumsum(many > 1) - 1, -1), many)
    owner, column = owner[column >= 0], column[column >= 0]
    a = len(left)
    common = np.zeros((a, len(all_sets) - a if right else a), np.float64)
    step = 4096
    at = np.searchsorted(column, np.arange(0, (column[-1] + 1 if len(column) else 0) + step, step))
    for k in range(len(at) - 1):
        own, col = owner[at[k] : at[k + 1]], column[at[k] : at[k + 1]] - k * step
        has = np.zeros((len(all_sets), step), np.float32)
        has[own, col] = 1
        common += has[:a] @ (has[a:] if right else has).T
    rows, cols = size[:a, None], (size[a:] if right else size)[None, :]
    linked = den * common >= num * (rows + cols - common)
    i, j = np.nonzero(linked if right else np.triu(linked, 1))
    return np.stack([i, j + (a if right else 0)], 1)


def _forest(n: int, pairs: np.ndarray) -> list[tuple[int, int]]:
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i, j in pairs.tolist():
        if (a := find(i)) != (b := find(j)):
            root[max(a, b)] = min(a, b)
            out.append((i, j))
    return out


def _verify(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by block pair; each pair gives a spanning forest of its links."""
    key, side, nodes, sets = None, [], [], []

    def done() -> list[tuple[int, int]]:
        first = [i for i, x in enumerate(side) if x == 0]
        second = [i for i, x in enumerate(side) if x == 1]
        if len(first) + len(second) < 2:
            return []
        names = [nodes[i] for i in first + second]
        pairs = _links([sets[i] for i in first], [sets[i] for i in second] or None, num, den)
        return [(names[i], names[j]) for i, j in _forest(len(names), pairs)]

    for batch in batches:
        found = []
        for bi, bj, s, node, tokens in zip(*(batch[c].to_pylist() for c in ("bi", "bj", "side", "node", "tokens")), strict=True):
            if (bi, bj) != key:
                found += done()
                key, side, nodes, sets = (bi, bj), [], [], []
            side.append(s)
            nodes.append(node)
            sets.append(np.frombuffer(tokens, np.uint64))
        yield _edges(found)
    yield _edges(done())


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], ["a", "b"])


def _among(docs: DataFrame, asked: DataFrame, bits: int = 1 << 24) -> DataFrame:
    """Rows of docs but for most whose doc_id is not in asked: a bitmap of hashed ids keeps their texts from being shuffled.

    The bitmap has bits / 64 rows at most, however many ids there are; beyond some ten million it
    lets more and more pass, which the join that follows puts right.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
    bit = F.expr(f"shiftleft(1L, cast(pmod(xxhash64(doc_id), {bits}) % 64 as int))")
    words = asked.filter("doc_id is not null").groupBy(F.floor(place / 64).alias("word")).agg(F.bit_or(bit).alias("mask"))
    return docs.join(F.broadcast(words), F.floor(place / 64) == F.col("word")).filter(F.col("mask").bitwiseAND(bit) != 0).drop("word", "mask")


def _linked(docs: DataFrame, classes: DataFrame, asks: DataFrame, k: int, num: int, den: int, nameless: bool) -> DataFrame:
    """Links (a, b) among the nodes asked for: asks has node, bi, bj, side and part, which bounds the asks of a row to some 1000."""
    asks = asks.groupBy("node", "part").agg(F.collect_list(F.struct("bi", "bj", "side")).alias("asks"))
    # What each candidate is asked for is settled before its text moves, so that texts and sets move once.
    asked = classes.groupBy("node").agg(F.min("doc_id").alias("doc_id")).join(asks, "node")
    asked = spill(asked.drop("part"))
    texts = _among(docs, asked).join(asked, "doc_id").select("text", "node", "asks")
    if nameless:  # sets that only rows without an id hold
        own = docs.filter("doc_id is null").select("text").mapInArrow(partial(_nodes, k=k), "text string, node long").dropDuplicates(["node"])
        texts = texts.unionByName(own.join(asked.filter("doc_id is null").drop("doc_id"), "node").select("text", "node", "asks"))
    rows = texts.mapInArrow(partial(_set_rows, k=k), "bi long, bj long, side int, node long, tokens binary")
    return spill(rows.repartition("bi", "bj").sortWithinPartitions("bi", "bj", "side").mapInArrow(partial(_verify, num=num, den=den), "a long, b long"))


def _stars(shared: DataFrame) -> DataFrame:
    """Asks of each node to be verified with the centre of most of its signatures, in parts of a centre's nodes."""
    met = shared.filter("pair and node <> centre").groupBy("node", "centre", "band").agg(F.count("*").alias("n"), F.max("need").alias("need"))
    best = met.filter("n >= need").groupBy("node").agg(F.max_by("centre", F.struct("n", "centre")).alias("bi"))
    best = spill(best.select("node", "bi", F.pmod(F.xxhash64("node"), F.lit(1 << 30)).alias("r")))
    # Written, so that AQE may split a hot centre's nodes in the join.
    fans = spill(best.groupBy("bi").agg(F.ceil(F.count("*") / BLOCK).alias("parts")))
    leaves = best.join(fans, "bi").select("node", "bi", (F.col("r") % F.col("parts")).alias("bj"), F.lit(1).alias("side"), F.lit(0).cast("long").alias("part"))
    parts = fans.withColumn("bj", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    return leaves.unionByName(parts.select(F.col("bi").alias("node"), "bi", "bj", F.lit(0).alias("side"), F.floor(F.col("bj") / 1000).alias("part")))


def _apart(shared: DataFrame, joined: DataFrame, classes: DataFrame, bands: Bands, one_sided: bool = False) -> DataFrame | None:
    """Asks of the nodes that share a signature with a node of another component so far; None where there are none.

    Nodes of one component lie in blocks of their own, other nodes in blocks by the first node of
    the largest signature they are in; what shares no signature beyond its component is not asked for.
    Shared signatures are counted by node and block of others. `one_sided` counts those of the nodes
    of the lesser of two labels with all of the other, and asks for all nodes of its blocks: right
    where a node that shares enough with a large label does so with most of its blocks.
    """
    placed = shared.join(joined.select("node", F.col("label").alias("comp")), "node", "left").withColumn("part", F.coalesce("comp", "node"))
    wide = placed.groupBy("sig").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.max("whole").alias("any"), F.count("*").alias("members")).filter("lo <> hi and any").select("sig", "members")
    rest = spill(placed.join(wide, "sig").select("sig", "node", "band", "need", "centre", "comp", "members"))
    if rest.isEmpty():
        return None
    named = spill(rest.groupBy("node").agg(F.first("comp").alias("comp"), F.max(F.struct("members", "centre"))["centre"].alias("first")))
    further = named.select(F.col("node").alias("first"), F.col("first").alias("second"))
    label = F.when(F.col("comp").isNull(), F.xxhash64(F.lit("alone"), F.coalesce("second", "first"))).otherwise(F.xxhash64(F.lit("comp"), "comp"))
    named = named.join(further, "first", "left").select("node", label.alias("label"), F.col("comp").isNotNull().alias("one"))
    counts = spill(named.groupBy("label").count())
    named = named.join(counts, "label").select("node", "label", "one", F.struct("count", "label").alias("size"), F.xxhash64("label", F.expr(f"pmod(xxhash64(node), cast(ceil(count / {BLOCK}.0) as int))")).alias("block"))
    held = spill(rest.select("sig", "node", "band", "need").join(named, "node"))
    blocks = held.groupBy("sig", "label", "block").agg(F.count("node").alias("n"))
    labels = blocks.groupBy("sig", "label").agg(F.sum("n").alias("n"))
    alone = held.select("sig", "label", "one", "size").distinct().join(labels, ["sig", "label"])
    # Labels that meet under a signature; within one component nothing is left to ask.
    fars = alone.select("sig", F.col("label").alias("far"), F.col("size").alias("far_size"))
    lesser = F.col("size") < F.col("far_size") if one_sided else F.col("label") != F.col("far")
    duos = alone.join(fars, "sig").filter(lesser | ((F.col("label") == F.col("far")) & ~F.col("one") & (F.col("n") > 1))).select("sig", "label", "far")
    near = held.select("sig", "node", "band", "need", "label", "block").join(duos, ["sig", "label"])
    same, enough = (F.col("label") == F.col("far")).alias("same"), (F.count("*").alias("n"), F.max("need").alias("need"))
    if one_sided:
        places = named.select(F.col("label").alias("far"), F.col("block").alias("other")).distinct()
        met = near.groupBy("node", "band", "block", "far", same).agg(*enough).filter("n >= need").join(places, "far").select("node", "band", "block", "other", "same")
        met = spill(met)
        facing = met.filter("not same").select(F.col("other").alias("block"), F.col("block").alias("other"), "band").distinct()
        met = met.unionByName(held.select("node", "band", "block").distinct().join(facing, ["block", "band"]).withColumn("same", F.lit(False)))
    else:
        others = blocks.select("sig", F.col("label").alias("far"), F.col("block").alias("other"), F.col("n").alias("m"))
        met = near.join(others, ["sig", "far"]).filter("block <> other or m > 1").groupBy("node", "block", "other", "band", same).agg(*enough).filter("n >= need").select("node", "band", "block", "other", "same")
    bi, bj = F.least("block", "other"), F.greatest("block", "other")
    asks = met.select("node", "band", bi.alias("bi"), bj.alias("bj"), F.when(F.col("block") == bi, 0).otherwise(1).alias("side"))
    lows = F.array(*map(F.lit, bands.low))
    sketched = classes.groupBy("node").agg(F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("own"), F.first("next_sketch").alias("next"))
    of = F.size(F.filter(lows, lambda x: x <= F.col("n_shingles"))) - 1
    asks = asks.join(sketched, "node").select("bi", "bj", "band", "side", "node", "n_shingles", F.when(F.col("band") == of, F.col("own")).otherwise(F.col("next")).alias("sketch"))
    asks = spill(asks.repartition("bi", "bj", "band").sortWithinPartitions("bi", "bj", "band", "side", "node").mapInArrow(partial(_near, bands=bands), "node long, bi long, bj long, side int").distinct())
    loads = asks.groupBy("node").agg(F.ceil(F.count("*") / 1000).alias("parts"))
    return asks.join(loads, "node").withColumn("part", F.pmod(F.xxhash64("bi", "bj"), F.col("parts"))).drop("parts")


def _grouped(docs: DataFrame, k: int, num: int, den: int, plans=allocate, signed=_segments, one_sided: bool = False) -> DataFrame:
    """doc_id, text hash, size, node and the component's least (doc_id, text hash) of every row of docs (doc_id, text).

    plans tells how many signatures a group's sets have, signed makes them; candidates are nodes that share enough of them.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    bands = Bands(num, den, 1 << 40)
    hashed = docs.withColumn("same", F.xxhash64("text"))
    classes = spill(hashed.mapInArrow(partial(_classes, k=k, bands=bands), "doc_id long, same long, n_shingles long, node long, sketch binary, next_sketch binary"))
    sizes = classes.filter("n_shingles > 0").groupBy("node").agg(F.first("n_shingles").alias("n"))
    lows = F.array(*map(F.lit, bands.low))
    # One row per size band: about 80 for documents of a million words.
    counted = sizes.groupBy((F.size(F.filter(lows, lambda x: x <= F.col("n"))) - 1).alias("band")).agg(F.count("*").alias("nodes"), F.sum("n").alias("tokens")).collect()
    population, total = {r["band"]: r["nodes"] for r in counted}, sum(r["tokens"] for r in counted)
    plan = {}
    for g in range(len(bands.low) - 1):
        people = population.get(g, 0) + population.get(g - 1, 0)
        if population.get(g, 0) and people > 1 and bands.differ(g):
            plan[g] = plans(bands.differ(g), bands.low[g], people)
    buckets = partitions(spark, total * 7e-6)
    packed = docs.mapInArrow(partial(signed, k=k, bands=bands, plan=plan, subs=spread(plan, population, bands.low)), "bucket int, packed binary")
    shared = spill(packed.repartition(buckets, "bucket").mapInArrow(_shared, "sig long, node long, band int, need int, centre long, whole boolean, pair boolean"))
    # A linked set shares `need` signatures at least.
    enough = shared.groupBy("node", "band").agg(F.count("*").alias("n"), F.max("need").alias("most")).filter("n >= most").select("node", "band")
    shared = spill(shared.join(enough, ["node", "band"], "left_semi"))
    nameless = not classes.filter("doc_id is null and n_shingles > 0").isEmpty()
    # First each node with one centre; most copies meet there, and only what is left in different components meets further.
    links = _linked(docs, classes, _stars(shared), k, num, den, nameless)
    label = components(links)
    asks = _apart(shared, label, classes, bands, one_sided)
    if asks is not None:
        more = _linked(docs, classes, asks, k, num, den, nameless)
        label = components(label.filter("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b")).union(more))

    # Least ids by node, then by component; rows of the few nodes with over a thousandth of all rows get theirs by broadcast.
    own = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "same"))
    nodes = spill(classes.filter("n_shingles > 0").groupBy("node").agg(F.min(own).alias("own"), F.count("*").alias("rows")).join(label, "node", "left").withColumn("part", F.coalesce("label", "node")))
    least = spill(nodes.groupBy("part").agg(F.min("own").alias("least")))
    nodes = spill(nodes.join(least, "part").select("node", "rows", "least"))
    n_rows = nodes.agg(F.sum("rows")).first()[0] or 0
    hot = nodes.filter(F.col("rows") * 1000 > n_rows).select("node", "least")
    narrow = classes.select("doc_id", "same", "n_shingles", "node")
    filled = narrow.filter("n_shingles > 0")
    # At most 1000 rows.
    by_hot = filled.join(F.broadcast(hot), "node")
    rest = filled.join(F.broadcast(hot.select("node")), "node", "left_anti").join(nodes.select("node", "least"), "node")
    empty = narrow.filter("n_shingles = 0").withColumn("least", F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "same")))
    return by_hot.unionByName(rest).unionByName(empty)


def ngram_components(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """doc_id, n_shingles and component_id: documents link when their sets of k-word shingles have a Jaccard similarity of num / den or more.

    docs needs doc_id and text; other columns are ignored, whatever their names. Words are runs of
    anything but ASCII white space, A-Z in lower case; a text of fewer than k words is one shingle.
    Null or wordless texts have an empty set and link with nothing. Repeated rows and copies share a
    node; rows with a null doc_id link like others but name no component, unless all its ids are
    null. An empty table gives an empty result. Sets are compared by 64-bit shingle hashes.

    Size bands keep linked sets in one group; a group's token universe is hashed into segments
    whose sums are signatures (see allocate()). Each node is first verified with one node that it
    shares signatures with. Nodes of different components that still share a signature are then put
    in blocks of about 256; for two blocks, or one, those of their nodes that share a signature are
    verified exactly in one place, which sends on a spanning forest of the links only.
    """
    return _grouped(docs, k, num, den).select("doc_id", "n_shingles", F.col("least.doc_id").alias("component_id"))


def keep_one(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """Of each component the row with the least doc_id (then text hash); rows with a null doc_id all stay.

    Rows that share a doc_id but not the text are told apart, and each may stand for its own
    component. Of rows that are equal in both one stays, the first by the other columns' JSON.
    Empty texts are alone in their group.
    """
    least = _grouped(docs, k, num, den).filter("doc_id is not null and least.doc_id = doc_id and least.same <=> same")
    kept = least.groupBy("doc_id", "same").agg(F.count("*").alias("times")).select(F.struct(F.col("doc_id").alias("i"), "same", "times").alias("kept_row"))
    names = [F.col(f"`{c.replace('`', '``')}`") for c in docs.columns]
    rows = docs.select(F.struct(*names).alias("row")).filter("row.doc_id is not null")
    found = rows.join(kept, (F.col("row.doc_id") == F.col("kept_row.i")) & F.xxhash64("row.text").eqNullSafe(F.col("kept_row.same")))
    again = found.filter("kept_row.times > 1").groupBy("kept_row").agg(F.min_by("row", F.to_json("row")).alias("row"))
    kept_rows = found.filter("kept_row.times = 1").select("row").unionByName(again.select("row")).select("row.*")
    return kept_rows.unionByName(docs.filter("doc_id is null"))


def op8(spark, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"), k=4, num=85, den=100)


OP8_SQL = r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]) END) AS s FROM w),
n AS (SELECT doc_id, len(s) AS n FROM s),
t AS (SELECT doc_id, unnest(s) AS t FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM t a JOIN t b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
r AS (WITH RECURSIVE r(doc_id, reach) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.reach) SELECT doc_id, min(reach) AS c FROM r GROUP BY 1)
SELECT n.doc_id, n.n::BIGINT AS n_shingles, r.c AS component_id FROM n JOIN r USING (doc_id)
"""
