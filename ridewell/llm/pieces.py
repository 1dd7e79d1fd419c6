"""SentencePiece encoding and decoding: equal-length words advance together through batched numpy steps."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, pieces, table

_UNIT = re.compile("▁*[^▁]+|▁+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MEMO = 500_000
_NONE = np.float32(-np.inf)
#: Types of pieces in model files, and the penalty of a character that is no piece.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
PENALTY = np.float32(10)


class Model:
    """A model file. Its own segmentation is that of its type: best total score (unigram) or merges (bpe)."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        with open(path, "rb") as f:
            proto = pb.ModelProto.FromString(f.read())
        spec, norm = proto.trainer_spec, proto.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or not norm.add_dummy_prefix or spec.treat_whitespace_as_suffix:
            raise ValueError("only models without normalisation, with a dummy prefix and escaped spaces, are supported")
        self.merges = spec.model_type == 2
        self.bytes: dict[int, int] = {}
        self.unknown, names, ids, scores, decoded = 0, [], [], [], []
        for i, p in enumerate(proto.pieces):
            raw = p.piece.replace("▁", " ").encode()
            if p.type == BYTE:
                self.bytes[int(p.piece[3:-1], 16)] = i
                raw = bytes([int(p.piece[3:-1], 16)])
            elif p.type == UNKNOWN:
                self.unknown, raw = i, " ⁇ ".encode()
            elif p.type == CONTROL:
                raw = b""
            elif p.type != NORMAL:
                raise ValueError(f"piece {i}: only normal, unknown, control and byte pieces are supported")
            else:
                names.append(p.piece)
                ids.append(i)
                scores.append(p.score)
            decoded.append(raw)
        if any("▁" in n.lstrip("▁") for n in names):
            raise ValueError("a piece holds a space behind another character, so words are not independent")
        self.decoded = decoded
        self.longest = max(map(len, names))
        self.least = np.float32(min(scores))
        codes = np.zeros(len(names), np.uint64)
        for n in range(1, self.longest + 1):
            at = [k for k, x in enumerate(names) if len(x) == n]
            if at:
                chars = np.frombuffer("".join(names[k] for k in at).encode("utf-32-le"), np.uint32).reshape(len(at), n)
                for code in substring_codes(chars.astype(np.uint64), n):
                    last = code
                codes[at] = last[:, 0]
        order = np.argsort(codes)
        self.keys, self.ids, self.scores = codes[order], np.array(ids, np.int32)[order], np.array(scores, np.float32)[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces have one hash")
        self.own: dict[str, bytes] = {}
        self.top: dict[str, bytes] = {}

    def probe(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece id (-1: none) and score of every substring: word, start, length - 1."""
        words, size = chars.shape
        most = min(self.longest, size)
        ids = np.full((words, size, most), -1, np.int32)
        scores = np.full((words, size, most), _NONE)
        for n, code in enumerate(substring_codes(chars, most)):
            at = np.minimum(np.searchsorted(self.keys, code), len(self.keys) - 1)
            hit = self.keys[at] == code
            width = code.shape[1]
            ids[:, :width, n] = np.where(hit, self.ids[at], -1)
            scores[:, :width, n] = np.where(hit, self.scores[at], _NONE)
        return ids, scores

    def best(self, ids: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Viterbi: length of the piece at each place of the best segmentation, 0 inside pieces.

        All words advance by a character at a time. Of equal totals the one with the longest last
        piece stays, as in the library; totals are 32-bit as there. But the library adds up from the
        start of the text, not of the word, so where the same pieces fit in two orders its rounding
        may favour the other one.
        """
        words, size, most = ids.shape
        scores = scores.copy()
        scores[:, :, 0] = np.where(ids[:, :, 0] < 0, self.least - PENALTY, scores[:, :, 0])
        total = np.full((words, size + 1), _NONE)
        total[:, 0] = 0
        back = np.zeros((words, size + 1), np.int64)
        for end in range(1, size + 1):
            reach = np.arange(min(most, end), 0, -1)
            sums = total[:, end - reach] + scores[:, end - reach, reach - 1]
            pick = sums.argmax(1)
            total[:, end] = sums[np.arange(words), pick]
            back[:, end] = reach[pick]
        out = np.zeros((words, size), np.int64)
        at, live = np.full(words, size), np.arange(words)
        while len(live):
            step = back[live, at[live]]
            at[live] -= step
            out[live, at[live]] = step
            live = live[at[live] > 0]
        return out

    def merged(self, scores: np.ndarray) -> np.ndarray:
        """Merges: in each round every word joins its neighbours with the best joint score, the first of equals."""
        words, size, most = scores.shape
        sizes = np.ones((words, size + 1), np.int64)
        sizes[:, size] = 0
        live = np.arange(words)
        place = np.arange(size)[None, :]
        while len(live):
            own = sizes[live]
            row = np.arange(len(live))[:, None]
            both = own[:, :size] + own[row, np.minimum(place + own[:, :size], size)]
            able = (own[:, :size] > 0) & (own[row, np.minimum(place + own[:, :size], size)] > 0) & (both <= most)
            joint = np.where(able, scores[live[:, None], place, np.clip(both, 1, most) - 1], _NONE)
            pick = joint.argmax(1)
            go = joint[np.arange(len(live)), pick] > _NONE
            live, pick, both = live[go], pick[go], both[np.arange(len(go)), pick][go]
            sizes[live, pick + sizes[live, pick]] = 0
            sizes[live, pick] = both
        return sizes[:, :size]

    def merged_long(self, scores: np.ndarray) -> np.ndarray:
        """merged() of one long word with a queue of pairs in place of rounds over all its places."""
        size, most = scores.shape[1:]
        score, length, before = scores[0], [1] * size, list(range(-1, size - 1))
        heap: list[tuple[float, int, int, int]] = []

        def offer(i: int) -> None:
            j = i + length[i]
            if j < size and length[i] + length[j] <= most and (s := score[i, length[i] + length[j] - 1]) > _NONE:
                heapq.heappush(heap, (-float(s), i, length[i], length[j]))

        for i in range(size):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = i + a
            if length[i] != a or length[j] != b:
                continue
            length[i], length[j] = a + b, 0
            if i + a + b < size:
                before[i + a + b] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return np.array([length])

    def segment(self, words: list[str]) -> tuple[list[bytes], list[bytes]]:
        """Ids of each word by the file's own way and by best total, as packed 32-bit integers. Words have their leading space character."""
        own: list[bytes] = [b""] * len(words)
        best: list[bytes] = own if not self.merges else [b""] * len(words)
        groups: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            groups.setdefault(len(w), []).append(i)
        for size, members in groups.items():
            step = max(1, 400_000 // (size * min(size, self.longest)))
            for a in range(0, len(members), step):
                part = members[a : a + step]
                chars = np.frombuffer("".join(words[i] for i in part).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(part), size).astype(np.uint64)
                ids, scores = self.probe(chars)
                self.emit(words, part, ids, self.best(ids, scores), best)
                if self.merges:
                    sizes = self.merged(scores) if size <= 64 else np.concatenate([self.merged_long(scores[k : k + 1]) for k in range(len(part))])
                    self.emit(words, part, ids, sizes, own)
        return own, best

    def emit(self, words: list[str], part: list[int], ids: np.ndarray, sizes: np.ndarray, out: list[bytes]) -> None:
        row, at = np.nonzero(sizes)
        flat = ids[row, at, sizes[row, at] - 1]
        edges = np.searchsorted(row, np.arange(len(part) + 1)).tolist()
        odd = set(row[flat < 0].tolist())
        packed = flat.tobytes()
        for k, i in enumerate(part):
            x, y = edges[k], edges[k + 1]
            if k not in odd:
                out[i] = packed[4 * x : 4 * y]
            else:
                out[i] = np.array([z for c, v in zip(at[x:y].tolist(), flat[x:y].tolist(), strict=True) for z in ([v] if v >= 0 else self.spelt(words[i][c]))], np.int32).tobytes()

    def spelt(self, char: str) -> list[int]:
        return [self.bytes[b] for b in char.encode("utf-8", "replace")] if self.bytes else [self.unknown]

    def units(self, text: str) -> list[str]:
        """Words without their first space character, which each of them has."""
        if "  " in text or "▁" in text or text[0] == " " or text[-1] == " ":
            return [u[1:] for u in _UNIT.findall("▁" + text.replace(" ", "▁"))]
        return text.split(" ")

    def encode(self, texts: list[str | None]) -> tuple[list[bytes], list[bytes]]:
        """Packed ids of each text by the file's own way, and by best total."""
        split = [self.units(t) if t else [] for t in texts]
        new = list(set().union(*split).difference(self.own))
        if self.own and len(self.own) + len(new) > _MEMO:
            self.own, self.top = {}, {}
            new = list(set().union(*split))
        own, best = self.segment(["▁" + w for w in new])
        self.own.update(zip(new, own, strict=True))
        self.top.update(zip(new, best, strict=True))
        get, top = self.own.__getitem__, self.top.__getitem__
        own = [self.joined(b"".join(map(get, units))) for units in split]
        return own, [self.joined(b"".join(map(top, units))) for units in split] if self.merges else own

    def joined(self, packed: bytes) -> bytes:
        """Unknown characters that follow each other are one unknown piece, where a file has no byte pieces."""
        if self.bytes:
            return packed
        ids = np.frombuffer(packed, np.int32)
        keep = np.ones(len(ids), bool)
        keep[1:] = (ids[1:] != self.unknown) | (ids[:-1] != self.unknown)
        return ids[keep].tobytes()

    def decode(self, ids: bytes) -> str:
        """Text of packed ids, without the dummy prefix; bytes that are no UTF-8 become U+FFFD."""
        raw = b"".join(map(self.decoded.__getitem__, np.frombuffer(ids, np.int32).tolist()))
        return raw.removeprefix(b" ").decode("utf-8", "replace")


def substring_codes(chars: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """For lengths 1 to most, 64-bit codes of the substrings from each place."""
    code = np.zeros(chars.shape, np.uint64)
    for n in range(most):
        code = mix(code[:, : chars.shape[1] - n] * _BASE + chars[:, n:] + np.uint64(1))
        yield code


_models: dict[str, Model] = {}


def model(path: str) -> Model:
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


def _lists(packed: list[bytes]) -> pa.Array:
    ends = np.cumsum([0] + [len(p) // 4 for p in packed])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), np.int32)))


def _encode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    m = model(path)
    for batch in batches:
        for part in pieces(batch, "text", 2 << 20):
            texts = part["text"].to_pylist()
            ids, best = m.encode(texts)
            back = [m.decode(x) for x in ids]
            yield pa.RecordBatch.from_arrays([part["doc_id"].cast(pa.int64()), _lists(ids), _lists(best), pa.array(back, pa.string()), pa.array([b == (t or "") for b, t in zip(back, texts, strict=True)])], ["doc_id", "ids", "best_ids", "decoded", "round_trip"])


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, best_ids, decoded and round_trip of every whole text of docs (doc_id, text), for the model file at path.

    ids are those of the library with that file: Viterbi where the file is a unigram model, merges
    where it is a BPE model. best_ids are the Viterbi segmentation with the best total of the
    pieces' scores in either case. Characters without a piece become byte pieces, or one unknown piece for
    each run of them where the file has none. decoded comes back
    from ids; round_trip tells whether it is the text (a text that holds U+2581 itself reads back with
    spaces there). Null counts as empty and has no ids. Null ids, repeated rows and other columns
    change nothing.
    """
    return docs.select("doc_id", "text").mapInArrow(partial(_encode, path=path), "doc_id long, ids array<int>, best_ids array<int>, decoded string, round_trip boolean")


def digests(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """Counts and SHA-256 of the ids (comma-joined) of encode(), and the ids themselves if asked for."""
    made = encode(docs, path)
    columns = [c for n, p in (("ids", ""), ("best_ids", "best_")) for c in (F.size(n).cast("long").alias(f"{p}n_tokens"), F.sha2(F.array_join(n, ",").cast("binary"), 256).alias(f"{p}ids_sha256"))]
    return made.select("doc_id", *(["ids"] if with_ids else []), *columns, F.length("decoded").cast("long").alias("decoded_chars"), "round_trip")


def op3(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
