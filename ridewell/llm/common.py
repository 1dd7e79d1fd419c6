"""Pieces that several operators share: scratch tables, byte-level word hashing, components."""

from __future__ import annotations

import atexit
import hashlib
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java and RE2 spelling of a word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_VALUES = np.random.Generator(np.random.PCG64(20240607)).integers(1, 2**64 - 1, 256, dtype=np.uint64)
_powers: dict[str, np.ndarray] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return small_batches(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def small_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """Fewer rows in an Arrow batch than Spark's default, as single texts may be very long."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return df


def shared_dir(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir; a temporary folder only where it is unset and the master is local, as in tests."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = f"file://{tempfile.mkdtemp(prefix='ridewell-')}"
        spark.conf.set("spark.checkpoint.dir", path)
    return path


@contextmanager
def let_go(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write are let go at its end; the written table stands for its rows from there on."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def spill(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    with let_go(spark):
        df.write.option("compression", "zstd").parquet(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """A scratch table bucketed by key, numbers below `buckets`, so that later joins on key leave these rows where they are.

    A number's rows are brought into one task and so into one file; else each task would write a file for each bucket.
    """
    spark = df.sparkSession
    name = f"llm_{uuid.uuid4().hex}"
    with let_go(spark):
        df.repartitionById(buckets, F.col(key)).write.bucketBy(buckets, key).option("compression", "zstd").format("parquet").saveAsTable(name)

    def drop() -> None:
        if spark._jsc is not None and spark._jsc.sc() is not None and not spark._jsc.sc().isStopped():
            spark.sql(f"DROP TABLE IF EXISTS {name}")

    atexit.register(drop)
    return spark.table(name)


def partitions(spark: SparkSession, mb: float = 0, per_mb: float = 24) -> int:
    """Shuffle partitions for so many MB: the session's number, more where that would overfill tasks."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(mb / per_mb) + 1)


def pieces(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about `most` bytes of text; a longer text is a slice by itself."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch[column]), 0), dtype=np.int64)
    part = (np.cumsum(sizes) - sizes) // most
    edge = np.diff(part, prepend=-1) != 0
    long = sizes > most
    edge |= long
    edge[1:] |= long[:-1]
    edges = np.flatnonzero(edge)
    for a, b in zip(edges, [*edges[1:], len(sizes)], strict=True):
        yield batch.slice(int(a), int(b - a))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    if column.offset:
        column = pa.concat_arrays([column])
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[ends[0] : ends[-1]], ends - ends[0]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the odd hashing base modulo 2**64, and their inverses."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which the hash of any stretch of the bytes follows, see stretch()."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * powers(len(data))[0], out=out[1:])
    return out


def stretch(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of bytes starts..ends, whose lengths are mixed in."""
    down = powers(len(sums))[1]
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def stretches(sums: np.ndarray, size: int) -> np.ndarray:
    """stretch() of `size` bytes from every place on."""
    out = sums[size:] - sums[:-size]
    out *= powers(len(sums))[1][: len(out)]
    out += np.uint64(size)
    return mix(out)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of all words; words never cross rows."""
    n = len(data)
    inside = ~_SPACE[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    before &= ~first[:n]
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after &= ~first[1:]
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash), sorted and distinct, of the k-word shingles of lower-cased texts; a shorter text is one shingle."""
    data = _LOWER[data]
    starts, ends, row = words(data, offsets)
    hashes = stretch(prefix_sums(data), starts, ends)
    # Sums of powers of one base modulo 2**64 are equal for some unlike stretches of 1024 bytes and more.
    for i in np.flatnonzero(ends - starts > 200):
        hashes[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    count = np.bincount(row, minlength=len(offsets) - 1)
    start_of = np.cumsum(count) - count
    with np.errstate(over="ignore"):
        rows, out = [], []
        if len(hashes) >= k:
            whole = np.flatnonzero(row[: len(row) - k + 1] == row[k - 1 :])
            h = np.full(len(whole), k, np.uint64)
            for j in range(k):
                h = mix(h * np.uint64(_BASE) + hashes[whole + j])
            rows.append(row[whole])
            out.append(h)
        for length in range(1, k):
            short = np.flatnonzero(count == length)
            h = np.full(len(short), length, np.uint64)
            for j in range(length):
                h = mix(h * np.uint64(_BASE) + hashes[start_of[short] + j])
            rows.append(short)
            out.append(h)
    rows_, out_ = np.concatenate(rows), np.concatenate(out)
    order = np.lexsort((out_, rows_))
    rows_, out_ = rows_[order], out_[order]
    keep = np.ones(len(rows_), bool)
    keep[1:] = (rows_[1:] != rows_[:-1]) | (out_[1:] != out_[:-1])
    return rows_[keep], out_[keep]


def by_bucket(bucket: np.ndarray, n: int, *columns: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Deal rows out to their buckets."""
    order = np.argsort(bucket.astype(np.min_scalar_type(n)), kind="stable")  # numbers of 16 bits are sorted in one pass
    edges = np.searchsorted(bucket[order], np.arange(n + 1))
    columns = tuple(c[order] for c in columns)
    for b in np.flatnonzero(np.diff(edges)):
        yield int(b), [c[edges[b] : edges[b + 1]] for c in columns]


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the undirected edges (a, b): label is its component's smallest node.

    Each round takes the smallest label among neighbours, then the label of the label; tables stay in
    the shared folder between rounds, nothing is collected but one sum.
    """
    both = spill(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("label"))
    total = None
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", F.least("label", "near").alias("label"))
        far = step.select(F.col("node").alias("label"), F.col("label").alias("far"))
        labels = spill(step.join(far, "label").select("node", F.least("label", "far").alias("label")))
        now = labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        if now == total:
            return labels
        total = now
