"""Operators 11 to 13 against plain versions: odd rows, ties, hot groups, huge numbers."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridewell.llm import divergence, minhash, whitening
from ridewell.llm.common import shingle_sets, utf8

import pyarrow as pa

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
EXTRA = ("node", "part", "block", "a", "term", "n", "kept", "x", "dim", "base", "component")


def plain_divergence(rows, least, ranks=50):
    rows = [tuple(v or "" for v in r) for r in rows]
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(LOWER))
        counts[lang, source].update(words)
        docs[lang].update(set(words))
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= least)

        def shares(count, kept=kept):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (n + 5 * len(kept)) for t in kept}

        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        p = {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources - {s}]
            terms = [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, ranks)):
                for i, (item, value) in enumerate(sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]):
                    out.append((lang, s, part, item, value, i + 1))
    return sorted(out)


@pytest.mark.parametrize(("side", "tile", "run", "heavy"), [(256, 1024, 65_536, 0.25), (2, 4, 8, 0.6), (3, 2, 4, 0.1), (2, 4, 8, 2.0)])
def test_divergence_equals_brute_force(spark, monkeypatch, side, tile, run, heavy):
    """Whatever is dense or sparse, and however tiles are cut; with nulls, empty texts, repeats and a group without terms."""
    for name, value in (("LEAST_DOCS", 3), ("SIDE", side), ("TILE", tile), ("RUN", run), ("HEAVY", heavy)):
        monkeypatch.setattr(divergence, name, value)
    rng = np.random.default_rng(3)
    words = [*"abcdefghij", "Éa", "éA", "漢字", "x1y", "Don't", "w" * 5000, "😀"]
    rows = [(" ".join(rng.choice(words, rng.integers(0, 25), p=np.arange(17, 0, -1) / 153)), f"l{rng.integers(2)}", f"s{rng.integers(7)}") for _ in range(150)]
    rows += [(None, None, None), ("", "l0", "empty"), ("1 2 3", "only", "one"), ("a b", "few", "p"), ("c d", "few", "q"), *[("same a a", "l1", None)] * 4]
    frame = spark.createDataFrame(rows, "text string, lang string, source string").withColumns({c: F.lit("x") for c in EXTRA})
    made = sorted(tuple(r) for r in divergence.divergence(frame).select("lang", "source", "part", "item", "value", "rank").collect())
    assert made == plain_divergence(rows, 3)
    assert any(r[0] == "few" and r[4] == 0 for r in made)


def test_shares_of_huge_counts(spark):
    n, total, kept = 5 * 10**17, 9 * 10**18, 10**6
    row = spark.createDataFrame([(n, total, kept)], "n long, total long, kept long").select(divergence._share("n", "total")).first()[0]
    assert row == 1 + 10**9 * (n + 5) // (total + 5 * kept)


def test_divergence_of_no_documents(spark):
    assert divergence.divergence(spark.createDataFrame([], "text string, lang string, source string")).count() == 0


def classes(texts, k, num, den):
    def shingles(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()

    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in combinations(range(len(texts)), 2):
        both = len(sets[i] & sets[j])
        if both and den * both >= num * len(sets[i] | sets[j]):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return sets, [find(i) for i in range(len(texts))]


def near_copies(rng, bases, times, words=400):
    out = []
    for _ in range(bases):
        n = int(rng.choice([2, 3, 5, 9, 20, 60, 150]))
        base = [f"w{i}" for i in rng.integers(0, words, n)]
        for _ in range(times):
            copy = list(base)
            for _ in range(int(rng.integers(0, max(2, n // 9)))):
                copy[int(rng.integers(n))] = f"x{rng.integers(1000)}"
            out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_equal_brute_force(spark, k):
    texts = [None, "", " \n", "one", "ONE", "One two", *near_copies(np.random.default_rng(k), 60, 7), "long " * 30_000]
    texts += [texts[10]] * 3
    rows = list(enumerate(texts)) + [(10, texts[10])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in EXTRA})
    sets, want = classes(texts, k, 4, 5)
    made = minhash.near_duplicates(frame, k=k).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert len(made) == len(rows)
    assert {tuple(r) for r in made} == {(i, len(s), c, i == c) for i, (s, c) in enumerate(zip(sets, want, strict=True))}


def test_near_duplicates_without_ids(spark):
    """A row without an id links others but names nothing; alone it is kept."""
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words), " ".join(["a", *words[1:56]]), " ".join(["a", *words[1:54], *"bcd"])]
    rows = [(1, texts[0]), (None, texts[1]), (3, texts[2]), (None, "nothing like it at all")]
    _, want = classes([r[1] for r in rows], 2, 4, 5)
    assert want == [0, 0, 0, 3]
    made = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=2).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in made) == [(-1, -1, True), (-1, 1, False), (1, 1, True), (3, 1, False)]


def test_near_duplicates_of_no_documents(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_sketches_fill_and_tell_similarity():
    """Every coordinate of a set of one token is filled; coordinates agree as often as sets are similar, with a narrow spread."""
    rng = np.random.default_rng(5)
    size, shares = minhash.ROWS * minhash.BANDS, {}
    for n, common in ((1, 1), (5, 4), (10, 8), (50, 40), (500, 400), (3000, 2000)):
        told = []
        for _ in range(25):
            tokens = rng.integers(0, 2**63, n, dtype=np.uint64)
            both = np.concatenate([tokens, tokens[:common]])
            made = minhash.sketches(both, np.array([0, n, n + common]), size)
            assert (made != minhash._NONE).all()
            told.append((made[0] == made[1]).mean())
        shares[n] = np.mean(told)
        assert abs(np.mean(told) - common / n) < 4 * math.sqrt(0.25 / size / 25), (n, np.mean(told))
        assert np.std(told) < 2.5 * math.sqrt(0.25 / size)
    assert shares[1] == 1.0


def test_bands_needed_have_the_promised_chance():
    need, chance = minhash.needed(4, 5), 0.8**minhash.ROWS
    below = [sum(math.comb(minhash.BANDS, k) * chance**k * (1 - chance) ** (minhash.BANDS - k) for k in range(n)) for n in (need, need + 1)]
    assert below[0] <= minhash.MISS < below[1]


def test_a_common_passage_makes_few_candidates(spark):
    """Unlike texts with one passage in common share too few bands to be compared."""
    rng = np.random.default_rng(8)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 10**6, 90)) + " " + passage for _ in range(300)]
    row, tokens = shingle_sets(*utf8(pa.array(texts)), 2)
    made = minhash.sketches(tokens, np.searchsorted(row, np.arange(301)), minhash.ROWS * minhash.BANDS).reshape(300, minhash.BANDS, minhash.ROWS)
    shared = sum((made[i] == made[j]).all(1).sum() >= minhash.needed(4, 5) for i, j in combinations(range(300), 2))
    assert shared < 0.01 * 300 * 299 / 2
    kept = minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), k=2)
    assert kept.filter("kept").count() == 300


def plain_whitening(vectors, k=4):
    """n, sums and the covariance as whole numbers of the distinct vectors."""
    x = [[math.floor(256 * c) for c in v] for v in vectors]
    fit = sorted(set(map(tuple, x)))
    n, d = len(fit), len(fit[0])
    sums = [sum(v[i] for v in fit) for i in range(d)]
    cov = [[(n * sum(v[i] * v[j] for v in fit) - sums[i] * sums[j]) / (n * n) for j in range(d)] for i in range(d)]
    return n, sums, np.array(cov), x


@pytest.mark.parametrize("scale", [1.0, 1e4, 1e8, 1e15])
def test_whitening_equals_whole_numbers(spark, scale):
    """Whole sums of any size: entries of one, two and four limbs, copies, odd vectors and other lengths beside them."""
    rng = np.random.default_rng(7)
    own = [(rng.normal(size=6) * scale * np.array([5, 4, 3, 2, 1, 0.5]) + scale).tolist() for _ in range(200)]
    other = [rng.normal(size=2).tolist() for _ in range(30)]
    odd = [(900, None), (901, []), (902, [None] + own[0][1:]), (903, [float("nan")] + own[0][1:]), (904, [float("inf")] + own[0][1:]), (905, [1e30] + own[0][1:])]
    rows = [*enumerate(own), *((1000 + i, v) for i, v in enumerate(other)), *odd, *[(7, own[7])] * 50, (None, own[3])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5).withColumns({c: F.lit("x") for c in EXTRA})
    made = whitening.whitened(frame).collect()
    assert len(made) == 4 * (200 + 50 + 1) + 2 * 30 and max(r.identity_error for r in made) < 1e-9
    for vectors, first in ((own, 0), (other, 1000)):
        n, sums, cov, x = plain_whitening(vectors)
        values, axes = np.linalg.eigh(cov)
        values, axes = values[::-1], axes[:, ::-1]
        mine = [r for r in made if r.vec_id is not None and first <= r.vec_id < first + 900]
        for r in mine:
            v = x[r.vec_id - first]
            deviation = sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True))
            assert r.n == n and r.deviation == (deviation if deviation < 2**63 else None)
            want = sum((n * c - s) / n * a for c, s, a in zip(v, sums, axes[:, r.component - 1], strict=True)) / math.sqrt(values[r.component - 1])
            assert abs(abs(r.whitened) - abs(want)) < 1e-6
            assert abs(r.explained - values[r.component - 1] / np.trace(cov)) < 1e-9
    signs = {(r.vec_id, r.component): r.whitened for r in made if r.vec_id in (3, None)}
    assert all(signs[3, c] == signs[None, c] for c in range(1, 5))


def test_whitening_without_variance(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whitened(spark.createDataFrame([], schema)).count() == 0
    one = whitening.whitened(spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25])], schema)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, None, 0.0)] * 4
    flat = whitening.whitened(spark.createDataFrame([(1, [0.0, 1.0]), (2, [1.0, 1.0]), (3, [-1.0, 1.0])], schema)).collect()
    told = {(r.vec_id, r.component): r for r in flat}
    assert told[1, 1].whitened == 0 and abs(abs(told[2, 1].whitened) - math.sqrt(1.5)) < 1e-12 and told[2, 2].whitened is None and told[2, 1].explained == 1.0


def test_sums_of_limbs_are_exact():
    rng = np.random.default_rng(2)
    whole, want = whitening._Whole(), np.zeros(9, object)
    for _ in range(300):
        x, at = rng.integers(-(2**52), 2**52, 9), int(rng.integers(0, 7))
        whole.add(at, x)
        want = want + x.astype(object) * 2 ** (whitening.LIMB * at)
    assert whole.value().tolist() == want.tolist()
