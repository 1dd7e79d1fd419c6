"""Secret scans: a keyword automaton, anchored patterns at its hits only, then embedded checksums."""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib
from collections.abc import Callable

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

BASE = ("assign", "access", "hex")
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_ASSIGN = re.compile(r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_JSON = json.JSONDecoder()


def crc_ok(text: str) -> bool:
    """Tokens such as ghp_...: the last six characters are the CRC-32 of the thirty before them, in base 62."""
    body, check = text[4:-6], text[-6:]
    value, digits = zlib.crc32(body.encode()), ""
    while value:
        value, rest = divmod(value, 62)
        digits = _BASE62[rest] + digits
    return digits.rjust(6, "0") == check


def header_ok(text: str) -> bool:
    """JSON web tokens: the first part is base64url of an object that names its algorithm."""
    head = text.split(".")[0]
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except (ValueError, TypeError, binascii.Error, RecursionError):
        return False


class Heads:
    """The starts within one run of token characters from which the run, to its end, is a web token's first part.

    Starts with the same place modulo 4 decode to ends of the same bytes, so each of those is decoded
    once, however long, and read from a start only as far as it is JSON. header_ok() has the last word.
    """

    def __init__(self, text: str, end: int):
        self.text, self.end, self.decoded = text, end, {}

    def ok(self, start: int) -> bool:
        place = (self.end - start) % 4
        if place == 1 or self.end - start < 11:
            return False
        if place not in self.decoded:
            self.decoded[place] = start, base64.urlsafe_b64decode(self.text[start : self.end] + "=" * (-place % 4)).decode("latin-1").rstrip()
        first, told = self.decoded[place]
        if not told.endswith("}"):
            return False
        try:
            _, at = _JSON.raw_decode(told, (start - first) // 4 * 3)
        except (ValueError, RecursionError):
            return False
        return at == len(told) and header_ok(self.text[start : self.end])


def always(_: str) -> bool:
    return True


#: Kind, keywords that any match starts with, pattern anchored at the keyword, check of the matched text.
RULES: list[tuple[str, tuple[str, ...], re.Pattern, Callable[[str], bool]]] = [
    ("assign", ("password", "passwd", "secret", "token", "apikey", "api_key"), _ASSIGN, always),
    ("access", ("akia",), _ACCESS, always),
    ("github", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"), crc_ok),
    ("npm", ("npm_",), re.compile(r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])"), crc_ok),
    ("gitlab", ("glpat-",), re.compile(r"glpat-[A-Za-z0-9_-]{20,}"), always),
    ("slack", ("xoxb-", "xoxp-", "xoxa-", "xoxr-"), re.compile(r"xox[abpr]-[0-9A-Za-z-]{20,}"), always),
    ("stripe", ("sk_live_", "rk_live_"), re.compile(r"[sr]k_live_[0-9A-Za-z]{16,}"), always),
    ("jwt", ("eyj",), re.compile(r"eyJ"), always),
    ("pem", ("-----begin",), re.compile(r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----[A-Za-z0-9+/=\s]{32,}-----END [A-Z ]{0,20}PRIVATE KEY-----"), always),
]
#: A web token's first part, to its end, and what follows it.
_HEAD, _REST = re.compile(r"[A-Za-z0-9_-]*"), re.compile(r"\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,}")
SPANS = "array<struct<kind:string,start:int,end:int>>"
KINDS = (*BASE, *(r[0] for r in RULES if r[0] not in BASE))
_SHORT = {i: ord(chr(i).lower()) for i in range(65, 91)}
_automaton: list[ahocorasick.Automaton] = []


def automaton() -> ahocorasick.Automaton:
    if not _automaton:
        made = ahocorasick.Automaton()
        for rule, (_, keys, _, _) in enumerate(RULES):
            for key in keys:
                made.add_word(key, (rule, len(key)))
        made.make_automaton()
        _automaton.append(made)
    return _automaton[0]


def find(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then kind; leftmost and not overlapping within a kind."""
    if not text:
        return []
    low = text.lower()
    if len(low) != len(text):
        low = text.translate(_SHORT)
    found, over = [], [0] * len(RULES)
    hits = sorted((end - size + 1, rule) for end, (rule, size) in automaton().iter(low))
    head_end, rest, heads = -1, None, None
    for start, rule in hits:
        kind, _, pattern, ok = RULES[rule]
        if start < over[rule] or not (m := pattern.match(text, start)):
            continue
        if kind == "jwt":
            # All hits within one first part share its end and what follows, so either is read once.
            if start >= head_end:
                head_end = _HEAD.match(text, start).end()
                rest, heads = _REST.match(text, head_end), Heads(text, head_end)
            if rest and heads.ok(start):
                over[rule] = rest.end()
                found.append((kind, start, rest.end()))
            continue
        if kind == "assign":
            over[rule] = m.end()
            if len(m[2]) < 12:
                continue
        elif kind == "access":
            over[rule] = m.end()
            if m.end() - start < 18:
                continue
        elif not ok(m[0]):
            continue
        over[rule] = m.end()
        found.append((kind, start, m.end()))
    found += (("hex", m.start(), m.end()) for m in _HEX.finditer(text))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def spans(texts: pd.Series) -> pd.Series:
    return pd.Series([[{"kind": k, "start": a, "end": b} for k, a, b in find(t)] for t in texts], dtype=object)


def redact(texts: pd.Series) -> pd.Series:
    """Texts with every secret replaced by [SECRET]; overlapping spans are one."""
    out = []
    for text in texts:
        parts, at = [], 0
        for _, a, b in find(text):
            if a >= at:
                parts += [text[at:a], "[SECRET]"]
            at = max(at, b)
        out.append("".join([*parts, text[at:]]) if parts else text)
    return pd.Series(out, dtype=object)


def _joined(found: Column) -> Column:
    return F.concat_ws(",", F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and found, the secrets of every whole text, for docs with doc_id and text.

    Null and empty texts have none; other columns, null ids and repeated rows change nothing.
    """
    return docs.select("doc_id", F.pandas_udf(spans, SPANS)("text").alias("found"))


def op5(spark, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda x: x["kind"].isin(*BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, BASE), F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"))
