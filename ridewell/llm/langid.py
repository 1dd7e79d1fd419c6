"""Language ID: known words by per-language log frequency, unseen ones by ever shorter character n-grams."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import mix, table

ORDERS = (4, 3, 2, 1)
#: Unseen words whose costs a task remembers.
_MEMO = 300_000
_RUN = re.compile(r"[^\W\d_]+")


def runs(token: str) -> list[str]:
    """The runs of letters of a lower-case token."""
    if token.isalpha():
        return [token]
    return [w for run in _RUN.findall(token) for w in ([run] if run.isalpha() else "".join(c if c.isalpha() else " " for c in run).split())]


def grams(word: str, n: int) -> list[str]:
    word = f" {word} "
    return [word[i : i + n] for i in range(len(word) - n + 1)]


def gram_codes(text: str, n: int) -> np.ndarray:
    """64-bit codes of the n characters from each place of the text."""
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    many = max(0, len(chars) - n + 1)
    code = np.full(many, n, np.uint64)
    for j in range(n):
        code = mix(code * np.uint64(0x9E3779B97F4A7C15) + chars[j : j + many])
    return code


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: words (order 0) and n-grams of each language with their counts."""
    seen: Counter[tuple[str, str]] = Counter()
    for batch in batches:
        for text, lang in zip(batch["text"].to_pylist(), batch["lang"].to_pylist(), strict=True):
            for token, n in Counter((text or "").lower().split()).items():
                for word in runs(token):
                    seen[lang, word] += n
    out: Counter[tuple[str, int, str]] = Counter()
    for (lang, word), n in seen.items():
        out[lang, 0, word] += n
        for order in ORDERS:
            for gram in grams(word, order):
                out[lang, order, gram] += n
    keys = list(out)
    for a in range(0, len(keys), 50_000):
        part = keys[a : a + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in part], pa.string()), pa.array([k[1] for k in part], pa.int32()), pa.array([k[2] for k in part], pa.string()), pa.array([out[k] for k in part], pa.int64())], ["lang", "gram_order", "gram", "n"])


class Model:
    """Rows of -log10 relative frequencies, a column for each language; row 0 is the penalty of what is unknown."""

    def __init__(self, counts: pd.DataFrame):
        self.langs = sorted(counts["lang"].unique())
        column = {x: i for i, x in enumerate(self.langs)}
        self.index: list[dict[str, int]] = [{} for _ in range(max(ORDERS) + 1)]
        totals = np.ones((len(self.index), max(1, len(self.langs))))
        np.add.at(totals, (counts["gram_order"].to_numpy(int), counts["lang"].map(column).to_numpy(int)), counts["n"].to_numpy(float))
        self.penalty = float(np.log10(totals).max()) + 1
        rows = 1
        for order, gram in zip(counts["gram_order"], counts["gram"], strict=True):
            if gram not in self.index[order]:
                self.index[order][gram] = rows
                rows += 1
        self.cost = np.full((rows, len(self.langs)), self.penalty)
        at = np.fromiter((self.index[o][g] for o, g in zip(counts["gram_order"], counts["gram"], strict=True)), np.int64, len(counts))
        cols, orders = counts["lang"].map(column).to_numpy(int), counts["gram_order"].to_numpy(int)
        self.cost[at, cols] = np.log10(totals[orders, cols]) - np.log10(counts["n"].to_numpy(float))
        self.memo: dict[str, int] = {}
        self.extra = np.zeros((0, len(self.langs) + 1))
        self.keys = {}
        for n in ORDERS:
            known = list(self.index[n])
            codes = gram_codes("".join(known), n)[::n] if known else np.zeros(0, np.uint64)
            order = np.argsort(codes)
            self.keys[n] = codes[order], np.array([self.index[n][g] for g in known], np.int64)[order]

    def unseen(self, new: list[str]) -> np.ndarray:
        """For each word the mean cost of its longest n-grams of which any is known; all words advance together."""
        out = np.repeat(self.cost[:1], len(new), axis=0)
        left = np.arange(len(new))
        for n in ORDERS:
            if not len(left) or not len(self.keys[n][0]):
                continue
            long = np.fromiter((len(new[i]) + 2 >= n for i in left), bool, len(left))
            left, short = left[long], left[~long]
            if not len(left):
                left = short
                continue
            padded = [f" {new[i]} " for i in left]
            ends = np.cumsum([len(w) for w in padded])
            many = np.diff(ends, prepend=0) - n + 1
            at = np.repeat(ends - np.diff(ends, prepend=0) - (np.cumsum(many) - many), many) + np.arange(many.sum())
            codes, (keys, rows) = gram_codes("".join(padded), n)[at], self.keys[n]
            hit = np.minimum(np.searchsorted(keys, codes), len(keys) - 1)
            row = np.where(keys[hit] == codes, rows[hit], 0)
            first = np.cumsum(many) - many
            known = np.maximum.reduceat(row, first) > 0
            # Row 0, the penalty, stands for the unknown ones among them.
            out[left[known]] = (np.add.reduceat(self.cost[row], first) / many[:, None])[known]
            left = np.concatenate([left[~known], short])
        return out

    def learn(self, tokens: list[str]) -> None:
        """Remember rows for tokens: the summed cost of their words, and how many words they are."""
        found = [runs(t) for t in tokens]
        flat = [w for ws in found for w in ws]
        known = self.index[0]
        row = np.fromiter((known.get(w, 0) for w in flat), np.int64, len(flat))
        cost = self.cost[row]
        new = np.flatnonzero(row == 0)
        cost[new] = self.unseen([flat[i] for i in new])
        owner = np.repeat(np.arange(len(tokens)), [len(ws) for ws in found])
        rows = np.zeros((len(tokens), len(self.langs) + 1))
        np.add.at(rows, owner, np.column_stack([cost, np.ones(len(flat))]))
        at = len(self.memo)
        self.extra = np.concatenate([self.extra[:at], rows])
        self.memo.update(zip(tokens, range(at, at + len(tokens)), strict=True))

    def predict(self, texts: pd.Series) -> pd.DataFrame:
        split = [t.lower().split() if t and self.langs else [] for t in texts]
        if len(self.memo) > _MEMO:
            self.memo = {}
        if new := set().union(*split).difference(self.memo):
            self.learn(list(new))
        get, out = self.memo.__getitem__, []
        for tokens in split:
            *total, n = self.extra[np.fromiter(map(get, tokens), np.int64, len(tokens))].sum(0) if tokens else [0.0]
            if not n:
                out.append(("und", 0.0))
                continue
            total = np.array(total)
            odds = np.exp((total.min() - total) / n * min(n, 8) * np.log(10))
            best = int(total.argmin())
            out.append((self.langs[best], float(odds[best] / odds.sum())))
        return pd.DataFrame(out, columns=["lang_pred", "score"])


def train(docs: DataFrame, per_language: int = 400, training: Column | None = None) -> Model:
    """Fit on at most per_language labelled documents of each language, taken by a hash of doc_id.

    Every word and n-gram of that sample is kept, so the model's size is set by per_language and the
    number of languages.
    """
    usable = docs.filter("lang is not null and text is not null")
    if training is not None:
        usable = usable.filter(training)
    # First of parts of a language, then of what these leave, so that no task sees a whole language.
    ids = usable.select("doc_id", "lang", F.xxhash64("doc_id").alias("h")).withColumn("part", F.pmod("h", F.lit(64)))
    for by in (("lang", "part"), ("lang",)):
        order = Window.partitionBy(*by).orderBy("h", "doc_id")
        ids = ids.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= per_language)
    # At most per_language ids for each language.
    sample = usable.select("doc_id", "lang", "text").join(F.broadcast(ids.select("doc_id").distinct()), "doc_id", "left_semi")
    counts = sample.mapInArrow(_count, "lang string, gram_order int, gram string, n long").groupBy("lang", "gram_order", "gram").agg(F.sum("n").alias("n"))
    return Model(counts.toPandas().sort_values(["lang", "gram_order", "gram"], ignore_index=True))


def predictor(docs: DataFrame, model: Model):
    """A function of a text column that gives struct<lang_pred, score>."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield shared.value.predict(texts)

    return predict


def held_out(doc_id: Column, folds: int = 5) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def identify(docs: DataFrame, folds: int = 5, per_language: int = 400) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of docs (doc_id, text, lang; other columns are ignored).

    Learns from labelled documents outside fold 0 of crc32(doc_id); rows with a null doc_id count as
    held out. A text that is null or has no letter gets `und` and score 0, as does every text where
    nothing was learned. Ties between languages go to the first by code point. Repeated rows get
    equal answers; texts are read whole. score is the posterior of the language, each word's mean
    evidence counted at most eight times.
    """
    out = F.col("doc_id")
    model = train(docs, per_language, training=~held_out(out, folds))
    named = docs.select("doc_id", held_out(out, folds).alias("held_out"), predictor(docs, model)("text").alias("p"))
    return named.select("doc_id", "held_out", "p.lang_pred", "p.score")


def op10(spark, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
