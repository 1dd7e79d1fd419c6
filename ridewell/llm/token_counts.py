"""Token counts: vocabulary strings proven to be one token count directly, only the rest is merged."""

from __future__ import annotations

import contextlib
import json
import os
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import table

#: The pre-token pattern of byte-level BPE, as its published files state it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_ALL = regex.compile(PATTERN)
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
#: The same for texts of ASCII and Latin-1 letters.
_LATIN = re.compile(PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"[^\s{_LETTERS}0-9]").replace(r"\p{L}", f"[{_LETTERS}]").replace(r"\p{N}", "[0-9]"), re.ASCII)
_LATIN_CHARS = frozenset(chr(i) for i in range(256) if i < 128 or re.match(f"[{_LETTERS}]", chr(i)))
_MEMO = 400_000


def byte_letters() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies, by rule: printable Latin-1 is itself, others follow from 256."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class Counter(dict):
    """Tokens by pre-token. Starts with the strings that the library encodes as one token."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        super().__init__()
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        self.special = [x["content"] for x in spec.get("added_tokens", [])]
        assert all(not (x["lstrip"] or x["rstrip"] or x["single_word"]) for x in spec.get("added_tokens", []))
        self.cut = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        ranks = {bytes([b]): b for b in range(256)}
        for i, (a, b) in enumerate(merges):
            ranks.setdefault(bytes(letters[c] for c in a + b), 256 + i)
        #: Merges a whole pre-token, which the caller has split off.
        self.merger = tiktoken.Encoding("own", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})
        self.sure: set[str] = set()
        self.proven: dict[str, int] = {}
        whole = []
        for piece in spec["model"]["vocab"]:
            raw = bytes(letters[c] for c in piece) if all(c in letters for c in piece) else b""
            with contextlib.suppress(UnicodeDecodeError):
                if _ALL.findall(text := raw.decode()) == [text]:
                    whole.append(text)
        for text, e in zip(whole, self.library.encode_batch_fast(whole, add_special_tokens=False), strict=True):
            if len(e.ids) == 1:
                self.proven[text] = 1
        self.update(self.proven)

    def __missing__(self, token: str) -> int:
        if len(self) > _MEMO:
            self.clear()
            self.update(self.proven)
        n = self[token] = len(self.merger.encode_ordinary(token))
        return n

    def split(self, text: str) -> list[str] | None:
        """Pre-tokens, or None where this Python may know a character's class otherwise than the library."""
        if text.isascii():
            return _LATIN.findall(text)
        chars = set(text)
        if chars <= _LATIN_CHARS:
            return _LATIN.findall(text)
        for c in chars - self.sure:
            if unicodedata.category(c) in ("Cn", "Co", "Cs"):
                return None
            self.sure.add(c)
        return _ALL.findall(text)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        parts = self.cut.split(text) if self.cut else [text]
        n = len(parts) - 1
        for part in parts:
            tokens = self.split(part)
            n += len(self.library.encode(part, add_special_tokens=False).ids) if tokens is None else sum(map(self.__getitem__, tokens))
        return n


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def count_tokens(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every whole text, for the byte-level BPE file at path.

    Null counts as the empty text, with 0 tokens. Strings of special tokens inside a text are that
    token, as the library has it by default. Repeated rows, null ids and other columns change nothing.
    """

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = counter(path).count
        for texts in batches:
            yield pd.Series([count(t) for t in texts], dtype="int64")

    counted = docs.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), tokens("text").alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op9(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
