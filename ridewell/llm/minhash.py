"""MinHash near-dedup: fast similarity sketches, banding, exact verification."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, partial
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, table
from .ngram_join import Bands, _grouped, _sets, pack, places_of

#: Coordinates of a band, and bands: sketches have ROWS * BANDS coordinates.
ROWS, BANDS = 5, 96
#: The chance with which two linked sets may share too few bands.
MISS = 1e-9
#: Tokens and sets that are sketched together.
TOKENS, SETS = 400_000, 2048

_NONE = np.uint64(2**64 - 1)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


@cache
def needed(num: int, den: int, rows: int = ROWS, bands: int = BANDS, miss: float = MISS) -> int:
    """The most bands that sets of similarity num / den share but for a chance of `miss`, at least one; by the binomial tail.

    Fewer bands than that make no candidates, which keeps most sets apart that share a passage only.
    """
    chance, below, k = (num / den) ** rows, 0.0, 0
    while True:
        below += comb(bands, k) * chance**k * (1 - chance) ** (bands - k)
        if below > miss:
            return max(k, 1)
        k += 1


def sketches(tokens: np.ndarray, edges: np.ndarray, size: int) -> np.ndarray:
    """Fast similarity sketches: one row of `size` coordinates for each set, tokens[edges[i]:edges[i + 1]], none of which is empty.

    In each of `size` rounds every token falls into a bin and brings a hash; a bin keeps the least of
    the first round that reaches it. Rounds after those serve one bin each, so no coordinate stays
    empty, and a set leaves once its bins are full, which takes about size * log(size) tokens. Two
    sets agree in a coordinate with the chance of their similarity, and as bins are filled without
    replacement within a round, the number in which they agree is as concentrated as independent draws.
    """
    n = len(edges) - 1
    out = np.full(n * size, _NONE)
    row = np.repeat(np.arange(n), np.diff(edges))
    left = np.ones(n, bool)
    for i in range(2 * size):
        v = mix(tokens + np.uint64((2 * i + 1) * int(_GOLDEN) % 2**64))
        value = (np.uint64(i) << np.uint64(32)) | (v & np.uint64(0xFFFFFFFF))
        # The upper half chooses the bin; a later round's values are larger, so full bins stay as they are.
        bins = ((v >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64) if i < size else i - size
        np.minimum.at(out, row * size + bins, value)
        if i % 4 == 3 or i >= size - 1:
            left &= (out.reshape(n, size) == _NONE).any(1)
            if not left.any():
                break
            keep = left[row]
            if not keep.all():
                tokens, row = tokens[keep], row[keep]
    return out.reshape(n, size)


def _banded(batches: Iterator[pa.RecordBatch], k: int, bands: Bands, plan: dict[int, tuple[int, int, int]], subs: dict[int, int], need: int, recent: int = 100_000, flush: int = 400_000) -> Iterator[pa.RecordBatch]:
    """Band signatures by bucket, packed. A set signs in its own size band and in the next, so that only sets of near sizes meet.

    A node that a task has met among its last `recent` ones sends nothing again.
    """
    seen: set[int] = set()
    sigs: list[np.ndarray] = []
    places: list[np.ndarray] = []
    heads: list[tuple[int, int, int, int]] = []
    held: list[tuple[int, tuple[int, ...], np.ndarray]] = []
    tokens = 0

    def sign() -> None:
        nonlocal tokens
        edges = np.concatenate([[0], np.cumsum([len(h[2]) for h in held])])
        made = sketches(np.concatenate([h[2] for h in held]), edges, ROWS * BANDS).reshape(len(held), BANDS, ROWS)
        band = np.arange(BANDS, dtype=np.uint64)[None, :]
        sig = mix(band + _GOLDEN)
        for r in range(ROWS):
            sig = mix(sig * _GOLDEN + made[:, :, r])
        for (node, groups, _), own in zip(held, sig, strict=True):
            for g in groups:
                x = mix(own + np.uint64(g))
                sigs.append(x)
                places.append(places_of(x, np.arange(BANDS), g, subs[g]))
                heads.append((node, 2 * g, need, BANDS))
        held.clear()
        tokens = 0

    for _, edges, hashes, nodes in _sets(batches, k):
        for a, b, node in zip(edges[:-1], edges[1:], nodes.tolist(), strict=True):
            if a == b or node in seen:
                continue
            if len(seen) >= recent:
                seen.clear()
            seen.add(node)
            band = bands.of(b - a)
            if groups := tuple(g for g in (band, band + 1) if g in plan):
                held.append((node, groups, hashes[a:b]))
                tokens += int(b - a)
                if tokens > TOKENS or len(held) >= SETS:
                    sign()
            if len(sigs) * BANDS > flush:
                yield pack(sigs, places, heads)
    if held:
        sign()
    if sigs:
        yield pack(sigs, places, heads)


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id and kept: documents link when their sets of k-word shingles have a Jaccard similarity of num / den or more.

    docs needs doc_id and text; other columns are ignored, whatever their names. Words are runs of
    anything but ASCII white space, A-Z in lower case; a text of fewer than k words is one shingle.
    Null or wordless texts have an empty set, link with nothing and are kept. Repeated rows and
    copies share a node and a component. component_id is the smallest doc_id that links reach, and
    kept says that a row's doc_id is that one; rows with a null doc_id link like others but name no
    component, and are not kept unless nothing with a doc_id reaches them. An empty table gives an
    empty result.

    Every distinct set has a sketch of 480 coordinates in 96 bands. Linked sets share 7 bands or more
    at a similarity of 0.8 but for a chance of 1e-9 (see needed()); nodes that share so many are
    candidates, wherever they lie, without a cap on partners. Each is verified on full sets, with one
    node first; then nodes of different components that still share bands meet in blocks, as in the
    n-gram join, whose verification and components these are.
    """
    found = _grouped(docs, k, num, den, plans=lambda differ, size, population: (BANDS, 0, 0), signed=partial(_banded, need=needed(num, den)), one_sided=True)
    component = F.col("least.doc_id")
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def op12(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=2)


OP12_SQL = r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 2 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM w),
n AS (SELECT doc_id, len(s) AS n FROM s),
t AS (SELECT doc_id, unnest(s) AS t FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM t a JOIN t b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
r AS (WITH RECURSIVE r(doc_id, reach) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.reach) SELECT doc_id, min(reach) AS c FROM r GROUP BY 1)
SELECT n.doc_id, n.n::BIGINT AS n_shingles, r.c AS component_id, n.doc_id = r.c AS kept FROM n JOIN r USING (doc_id)
"""
