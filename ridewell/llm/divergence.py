"""Source divergence audit: exact L1 distances of term shares, dense for common terms, sparse corrections for rare ones."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pieces, prefix_sums, spill, stretch, table, utf8

#: Documents of a lang that a kept term is in, at least.
LEAST_DOCS = 30
#: Added to each count; shares are whole numbers of 1 / UNIT.
SMOOTH, UNIT = 5, 1_000_000_000
#: A term in at least this share of a lang's groups is heavy.
HEAVY = 0.25
#: Groups on a side of a tile, terms of a tile, and terms whose tiles one task adds up.
SIDE, TILE, RUN = 256, 1024, 65_536
TERM_RANKS = 50

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_COUNTS = "lang string, source string, term string, n long, docs long"
_NAMES = [c.split()[0] for c in _COUNTS.split(", ")]
_PAIRS = "lang string, a int, b int, value long"


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the runs of letters and characters beyond ASCII; runs never cross rows."""
    inside = _LETTER[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:-1]
    last[:-1] &= ~inside[1:] | cut[1:-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, "right") - 1


def _totals(group: np.ndarray, term: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sums of the values of equal (group, term)."""
    order = np.lexsort((term, group))
    group, term = group[order], term[order]
    start = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]) | (term[1:] != term[:-1])])) if len(group) else np.zeros(0, np.int64)
    return group[start], term[start], *(np.add.reduceat(v[order], start) if len(start) else v[:0] for v in values)


def _gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The stretches of the bytes as text."""
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    own = data[np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])]
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(own))


class _Tally:
    """Occurrences and documents of (group, term) in a task, until they are `most`; terms by their hashes."""

    def __init__(self, most: int):
        self.most, self.groups = most, {}
        self._clear()

    def _clear(self) -> None:
        self.held, self.names, self.words, self.n, self.groups, self.full = [], [], [], 0, {}, False

    def group(self, key: tuple[str, str]) -> int:
        return self.groups.setdefault(key, len(self.groups))

    def add(self, group: np.ndarray, term: np.ndarray, n: np.ndarray, docs: np.ndarray, names: np.ndarray, words: pa.Array) -> None:
        """names are the hashes of the terms `words`."""
        self.held.append((group, term, n, docs))
        self.names.append(names)
        self.words.append(words)
        self.n += len(group) + len(names)
        if self.n > self.most:
            self._merge()
            self.full = self.n > self.most // 2

    def _merge(self) -> None:
        self.held = [_totals(*(np.concatenate(x) for x in zip(*self.held, strict=True)))]
        names, at = np.unique(np.concatenate(self.names), return_index=True)
        self.names, self.words = [names], [pa.concat_arrays(self.words).take(pa.array(at))]
        self.n = len(names) + len(self.held[0][0])

    def rows(self) -> Iterator[pa.RecordBatch]:
        """What is held, and a row without a term for each group, so that groups without terms are known."""
        lang, source = (pa.array([k[i] for k in self.groups], pa.string()) for i in (0, 1))
        none = pa.array(np.zeros(len(lang), np.int64))
        yield pa.RecordBatch.from_arrays([lang, source, pa.nulls(len(lang), pa.string()), none, none], _NAMES)
        if self.held:
            self._merge()
            group, term, n, docs = self.held[0]
            which = np.searchsorted(self.names[0], term)
            for a in range(0, len(group), 1 << 16):
                part = slice(a, a + (1 << 16))
                of = pa.array(group[part])
                yield pa.RecordBatch.from_arrays([lang.take(of), source.take(of), self.words[0].take(pa.array(which[part])).cast(pa.string()), pa.array(n[part]), pa.array(docs[part])], _NAMES)
        self._clear()


def _counted(batches: Iterator[pa.RecordBatch], most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Occurrences of each term by lang and source, and the documents that it is in, summed over a task as far as memory allows."""
    tally = _Tally(most)
    for batch in batches:
        for part in pieces(batch, "text"):
            own = np.array([tally.group(k) for k in zip(part["lang"].to_pylist(), part["source"].to_pylist(), strict=True)], np.int64)
            data, offsets = utf8(part["text"])
            data = _LOWER[data]
            starts, ends, row = _terms(data, offsets)
            if not len(starts):
                continue
            hashes = stretch(prefix_sums(data), starts, ends)
            # Sums of powers of one base modulo 2**64 are equal for some unlike stretches of 1024 bytes and more.
            for i in np.flatnonzero(ends - starts > 200):
                hashes[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
            names, at, code = np.unique(hashes, return_index=True, return_inverse=True)
            in_doc, n = np.unique(row * len(names) + code, return_counts=True)
            where, back = np.unique(own[in_doc // len(names)] * len(names) + in_doc % len(names), return_inverse=True)
            n, docs = np.bincount(back, n).astype(np.int64), np.bincount(back)
            tally.add(where // len(names), names[where % len(names)], n, docs, names, _gathered(data, starts[at], ends[at]))
            if tally.full:
                yield from tally.rows()
    if tally.groups:
        yield from tally.rows()


def _share(count: str, total: str) -> Column:
    """1 + floor(UNIT * (count + SMOOTH) / (total + SMOOTH * kept)), in decimals that no count overflows; null where no term is kept."""
    return F.expr(f"1 + (cast({count} + {SMOOTH} as decimal(20,0)) * cast({UNIT} as decimal(10,0))) div nullif(cast({total} + {SMOOTH} * kept as decimal(20,0)), 0)")


def _one_sided(values: np.ndarray, times: np.ndarray, bases: np.ndarray) -> np.ndarray:
    """For each base the sum of times * abs(value - base)."""
    out = np.zeros(len(bases), np.int64)
    for a in range(0, len(values), 4096):
        out += times[a : a + 4096] @ np.abs(values[a : a + 4096, None] - bases[None, :])
    return out


class _Blocks:
    """Distances between the groups of two blocks (or of one) over the terms of a run, as rows come in order of their tiles."""

    def __init__(self, key: tuple):
        self.lang, self.two = key[0], key[1] != key[2]
        self.members: tuple[list, list] = ([], [])

    def member(self, row: dict) -> None:
        self.members[row["side"]].append((row["a"], row["base"], row["light"]))
        self.lights, self.first = row["lights"], row["run"] == 0
        self.at = None

    def _begin(self) -> None:
        i, j = (sorted(self.members[s if self.two else 0]) for s in (0, 1))
        self.names = [np.array([m[0] for m in x], np.int64) for x in (i, j)]
        self.bases = [np.array([-1 if m[1] is None else m[1] for m in x], np.int64) for x in (i, j)]
        light = [np.array([m[2] for m in x], np.int64) for x in (i, j)]
        self.at = [{m: k for k, m in enumerate(x.tolist())} for x in self.names]
        self.sums = np.zeros((len(i), len(j)), np.int64)
        if self.first:  # rare terms that neither group has
            self.sums += (self.lights - light[0][:, None] - light[1][None, :]) * np.abs(self.bases[0][:, None] - self.bases[1][None, :])
        self.tile, self.dense, self.width = None, ({}, {}), 0

    def add(self, row: dict) -> None:
        if self.at is None:
            self._begin()
        own, xs, ys = self.at[row["side"]][row["a"]], np.array(row["xs"], np.int64), np.array(row["ys"], np.int64)
        if row["tile"] < 0:  # shares of rare terms and how many terms have them, each against the others' bases
            if self.two and row["side"]:
                self.sums[:, own] += _one_sided(xs, ys, self.bases[0])
            else:
                far = _one_sided(xs, ys, self.bases[1])
                self.sums[own] += far
                if not self.two:
                    self.sums[:, own] += far
            return
        if row["tile"] != self.tile:
            self._flush()
            self.tile, self.width = row["tile"], row["width"]
        self.dense[row["side"]][own] = xs, ys

    def _flush(self) -> None:
        if self.tile is None:
            return
        sides = []
        for side in (0, 1) if self.two else (0,):
            tile = np.repeat(self.bases[side][:, None], self.width, 1)
            for own, (xs, ys) in self.dense[side].items():
                tile[own, xs] = ys
            sides.append(tile)
        for k, own in enumerate(sides[0]):
            self.sums[k] += np.abs(sides[-1] - own).sum(1)
        self.tile, self.dense = None, ({}, {})

    def rows(self) -> pa.RecordBatch:
        if self.at is None:
            self._begin()
        self._flush()
        a, b = np.nonzero(self.names[0][:, None] < self.names[1][None, :])
        return _pairs(self.lang, self.names[0][a], self.names[1][b], self.sums[a, b])


def _pairs(lang: str, a: np.ndarray, b: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang, pa.string()), len(a)), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(value, pa.int64())], ["lang", "a", "b", "value"])


def _tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by block pair, run and tile, the members first; one block pair's sums and one tile are held."""
    key, held = None, None
    for batch in batches:
        for row in batch.to_pylist():
            own = (row["lang"], row["bi"], row["bj"], row["run"])
            if own != key:
                if held is not None:
                    yield held.rows()
                key, held = own, _Blocks(own)
            held.member(row) if row["tile"] == -2 else held.add(row)
    if held is not None:
        yield held.rows()


def _corrected(batches: Iterator[pa.RecordBatch], most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """What the one-sided sums get wrong for two groups that both have a rare term, summed by pair over a task."""
    held: dict[str, list[tuple[np.ndarray, ...]]] = {}
    n, corners = 0, {}

    def rows() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            yield _pairs(lang, *_totals(*(np.concatenate(x) for x in zip(*parts, strict=True))))

    for batch in batches:
        for lang, who in zip(batch["lang"].to_pylist(), batch["who"].to_pylist(), strict=True):
            a, base, p = (np.array([w[c] for w in who], np.int64) for c in ("a", "base", "p"))
            order = np.argsort(a)
            a, base, p = a[order], base[order], p[order]
            i, j = corners.get(len(a)) or corners.setdefault(len(a), np.triu_indices(len(a), 1)) if len(a) < 64 else np.triu_indices(len(a), 1)
            wrong = np.abs(p[i] - p[j]) - np.abs(p[i] - base[j]) - np.abs(p[j] - base[i]) + np.abs(base[i] - base[j])
            held.setdefault(lang, []).append((a[i], a[j], wrong))
            n += len(i)
        if n > most:
            held = {k: [_totals(*(np.concatenate(x) for x in zip(*v, strict=True)))] for k, v in held.items()}
            n = sum(len(v[0][0]) for v in held.values())
            if n > most // 2:
                yield from rows()
                held, n = {}, 0
    yield from rows()


def _tables(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups with their totals, and the counts of kept terms by group, each with its group's columns."""
    text = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    counts = spill(text.mapInArrow(_counted, _COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    kept = counts.filter("term is not null").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"), F.count("*").alias("spread")).filter(F.col("docs") >= LEAST_DOCS)
    found = spill(counts.filter("term is not null").join(kept.drop("docs"), ["lang", "term"]).select("lang", "source", "term", "n", "lang_n", "spread"))
    # One row for each lang and for each group from here on; of a group with many terms every task sends one row.
    places = Window.partitionBy("lang").orderBy("source")
    groups = counts.filter("term is null").select("lang", "source", (F.row_number().over(places) - 1).alias("a"))
    sizes = groups.groupBy("lang").agg(F.count("*").alias("size"))
    heavy = F.col("spread") >= F.lit(HEAVY) * F.col("size")
    # Summed by spread first, so that few rows meet their lang's size.
    words = found.groupBy("lang", "term").agg(F.first("spread").alias("spread"), F.first("lang_n").alias("lang_n")).groupBy("lang", "spread").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_n"))
    langs = words.join(sizes, "lang").groupBy("lang").agg(F.sum("terms").alias("kept"), F.sum("lang_n").alias("lang_total"), F.sum(F.when(heavy, F.col("terms")).otherwise(0)).alias("heavies"))
    held = found.groupBy("lang", "source", "spread").agg(F.count("*").alias("terms"), F.sum("n").alias("n"))
    totals = held.join(sizes, "lang").groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum(F.when(heavy, 0).otherwise(F.col("terms"))).alias("light"))
    zero = {"kept": 0, "lang_total": 0, "heavies": 0, "total": 0, "light": 0}
    made = groups.join(sizes, "lang").join(langs, "lang", "left").join(totals, ["lang", "source"], "left").fillna(zero)
    made = made.withColumn("lights", F.col("kept") - F.col("heavies")).withColumn("base", _share("0", "total"))
    groups = spill(made)
    shares = found.join(groups, ["lang", "source"]).withColumn("p", _share("n", "total")).withColumn("q", _share("lang_n", "lang_total")).withColumn("heavy", heavy)
    return groups, spill(shares.select("lang", "source", "a", "term", "p", "q", "heavy", "base", "heavies", "lights", "size"))


def _distances(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """lang, a, b and value of every two groups a < b of a lang."""
    # A tile has about TILE terms, in an order of its own.
    tiles = F.greatest(F.lit(1), F.ceil(F.col("heavies") / TILE))
    placed = shares.filter("heavy").withColumn("tile", F.pmod(F.xxhash64("term"), tiles).cast("int"))
    terms = placed.groupBy("lang", "tile", "term").agg(F.lit(True).alias("_one"))
    terms = terms.select("lang", "tile", "term", (F.row_number().over(Window.partitionBy("lang", "tile").orderBy("term")) - 1).alias("at"), F.count("*").over(Window.partitionBy("lang", "tile")).alias("width"))
    placed = placed.join(terms, ["lang", "tile", "term"])
    told = ["lang", "a", "size", "run", "tile"]
    dense = placed.withColumn("run", F.floor(F.col("tile") / (RUN // TILE)).cast("int")).groupBy(*told).agg(F.first("width").alias("width"), F.collect_list(F.struct("at", "p")).alias("w"))
    dense = dense.select(*told, "width", F.col("w.at").cast("array<long>").alias("xs"), F.col("w.p").alias("ys"))
    # A rare term of a group counts by its share; few shares differ, as few small counts do.
    chunks = F.ceil(F.greatest(F.lit(1), F.col("lights")) / RUN)
    rare = shares.filter("not heavy").groupBy("lang", "a", "size", "lights", "p").agg(F.count("*").alias("m"))
    rare = rare.withColumn("run", F.pmod(F.xxhash64("p"), chunks).cast("int")).withColumn("tile", F.lit(-1)).groupBy(*told).agg(F.collect_list(F.struct("p", "m")).alias("w"))
    rare = rare.select(*told, F.lit(0).cast("long").alias("width"), F.col("w.p").alias("xs"), F.col("w.m").alias("ys"))
    runs = F.greatest(F.lit(1), F.ceil(F.ceil(F.col("heavies") / TILE) / (RUN // TILE)), F.ceil(F.col("lights") / RUN)).cast("int")
    nothing = F.array().cast("array<long>")
    members = groups.select("lang", "a", "size", F.explode(F.sequence(F.lit(0), runs - 1)).alias("run"), F.lit(-2).alias("tile"), F.lit(0).cast("long").alias("width"), nothing.alias("xs"), nothing.alias("ys"), "base", "light", "lights")
    none = F.lit(None).cast("long")
    rows = members.unionByName(dense.unionByName(rare).select("*", none.alias("base"), none.alias("light"), none.alias("lights")))
    block = F.floor(F.col("a") / SIDE).cast("int")
    rows = rows.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.floor((F.col("size") - 1) / SIDE).cast("int"))))
    rows = rows.withColumn("bi", F.least("block", "other")).withColumn("bj", F.greatest("block", "other")).withColumn("side", F.when(F.col("block") == F.col("bi"), 0).otherwise(1)).drop("block", "other", "size")
    by = ("lang", "bi", "bj", "run")
    near = rows.repartition(*by).sortWithinPartitions(*by, "tile").mapInArrow(_tiled, _PAIRS)
    posted = shares.filter("not heavy").groupBy("lang", "term").agg(F.collect_list(F.struct("a", "base", "p")).alias("who")).filter(F.size("who") > 1)
    return near.unionByName(posted.mapInArrow(_corrected, _PAIRS)).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value and rank: how far the sources of each lang differ in their terms, and by which.

    docs needs text, lang and source, null in any of which is ''; other columns, a doc_id among them,
    are ignored, and repeated rows are documents of their own. Terms are runs of letters and of
    characters beyond ASCII, A-Z in lower case; a lang keeps those in at least 30 of its documents.
    A group's share of a kept term is 1 + floor(10**9 * (count + 5) / (N + 5 * V)). Part `pair` has
    the sum of absolute differences to each other source of the lang (0 where nothing is kept), part
    `term` the 50 kept terms that the group has and whose share is most above the lang's. Ties go to
    the smaller item by UTF-8 bytes. An empty table gives an empty result; a lang with one source has
    no pairs.

    Terms in a quarter of a lang's groups are heavy: their shares lie in dense tiles of 256 groups by
    about 1024 terms, of which two at a time are subtracted. Of a rare term only the groups that have
    it are listed. Each of those is first compared with what the others have for lack of the term (a
    sum over its distinct shares); what that gets wrong for two groups that both have the term is put
    right for each two groups of the list, at most a quarter of the lang's groups. Both sums are
    whole numbers and add up exactly. Counts are summed within tasks before they are shuffled, so
    hot groups and terms weigh little; a task holds one tile, or one list, whatever the vocabulary.
    """
    groups, shares = _tables(docs)
    found = _distances(groups, shares)
    found = found.select("lang", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("x"), "value").select("lang", "x.a", "x.b", "value")
    names = groups.select("lang", "a", "source")
    pairs = found.join(names, ["lang", "a"]).join(names.select("lang", F.col("a").alias("b"), F.col("source").alias("item")), ["lang", "b"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    terms = shares.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.withColumn("rank", rank).unionByName(terms.withColumn("rank", rank).filter(F.col("rank") <= TERM_RANKS))


def op11(spark, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS i, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
w AS (SELECT i, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT i) AS docs FROM w GROUP BY ALL),
k AS (SELECT lang, term, sum(n)::BIGINT AS n FROM c GROUP BY ALL HAVING sum(docs) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v, sum(n)::BIGINT AS n FROM k GROUP BY 1),
x AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
t AS (SELECT lang, source, sum(n)::BIGINT AS n FROM x GROUP BY ALL),
p AS (SELECT x.lang, x.source, x.term, x.n, (1 + (1000000000::HUGEINT * (x.n + 5)) // (t.n + 5 * v.v))::BIGINT AS p, (1 + (1000000000::HUGEINT * (k.n + 5)) // (v.n + 5 * v.v))::BIGINT AS q
  FROM x JOIN t USING (lang, source) JOIN v USING (lang) JOIN k ON k.lang = x.lang AND k.term = x.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(s.value, 0) AS value FROM g JOIN g h ON g.lang = h.lang AND g.source <> h.source LEFT JOIN s ON s.lang = g.lang AND s.source = g.source AND s.item = h.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM r
QUALIFY part = 'pair' OR row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) <= 50
"""
