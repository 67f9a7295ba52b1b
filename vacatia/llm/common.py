"""Shared pieces: the shared work folder, materialising a stage, and vectorised tokenising of Arrow text."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import json
import re
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy pass handles; bounds a Python worker's memory (a longer document is a pass of its own).
SLICE_BYTES = 1 << 20

Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
#: Rows of an Arrow batch: some MB of text, in the JVM and in the worker.
ROWS_A_BATCH = 1000
_ASCII_SPACE = (9, 10, 11, 12, 13, 32)


def work_dir(spark: SparkSession) -> str:
    """The folder shared by driver and executors, from spark.checkpoint.dir. Where that is unset, a local one for a local
    session (tests), and an error on a cluster, whose executors would each write to their own disk."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"file:///tmp/checkpoints/vacatia-{spark.sparkContext.applicationId}"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def materialize(df: DataFrame, name: str, **options: object) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage and survives lost executors. options: of the writer."""
    spark = df.sparkSession
    path = f"{work_dir(spark)}/vacatia/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.options(**options).parquet(path)
    return spark.read.schema(schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a materialised table that no later step reads."""
    jvm = df.sparkSession._jvm
    conf = df.sparkSession._jsc.hadoopConfiguration()
    parents = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for parent in parents:
        if "/vacatia/" in parent:
            path = jvm.org.apache.hadoop.fs.Path(parent)
            path.getFileSystem(conf).delete(path, True)


def bounded_sample(df: DataFrame, most: int, seed: int, key: str, tie: str) -> DataFrame:
    """At most `most` rows of df, by the order of a hash of key; rows of equal keys by a hash of tie. Only keys are sorted
    for the bound, so a key with a third of all rows gives no more rows either."""
    order = F.xxhash64(F.col(key), F.lit(seed))
    edge, n = df.select(order.alias("o")).orderBy("o").limit(most).agg(F.max("o"), F.count("*")).first()
    if not n:
        return df.limit(0)
    below = df.filter(order < edge)
    return below.union(df.filter(order == edge).orderBy(F.xxhash64(tie), tie).limit(most - below.count()))


class Pieces:
    """An array to share that is never whole in memory: its kind, its length and its pieces."""

    def __init__(self, kind: np.dtype | type, length: int, pieces: Iterator[np.ndarray]):
        self.dtype, self.length, self.pieces = np.dtype(kind), length, pieces

    def __len__(self) -> int:
        return self.length


def share(spark: SparkSession, name: str, arrays: dict[str, np.ndarray | Pieces]) -> str:
    """Write arrays to a file of the shared folder, which workers map: one copy in the page cache of a machine, none in the
    workers. A folder of a mounted file system is written and mapped where it is; of any other, Spark hands the file to all
    executors. Gives the file's name for shared()."""
    file = f"{name}-{uuid.uuid4().hex}.bin"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{work_dir(spark)}/vacatia/{file}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    mounted = fs.getUri().getScheme() == "file"
    arrays = dict(sorted(arrays.items(), key=lambda x: -x[1].dtype.itemsize))  # so that all are aligned
    head = json.dumps([(k, x.dtype.str, len(x)) for k, x in arrays.items()]).encode()
    head = head.ljust(-(-(len(head) + 8) // 8) * 8 - 8)

    def parts() -> Iterator[memoryview]:
        yield memoryview(len(head).to_bytes(8, "little") + head)
        for x in arrays.values():
            for piece in x.pieces if isinstance(x, Pieces) else (x,):
                if len(piece):
                    yield memoryview(np.ascontiguousarray(piece, x.dtype)).cast("B")

    if mounted:
        local = Path(path.toUri().getPath())
        local.parent.mkdir(parents=True, exist_ok=True)
        with local.open("wb") as f:
            for part in parts():
                f.write(part)
        return str(local)
    out = fs.create(path, True)
    for part in parts():
        for i in range(0, len(part), 1 << 20):
            out.write(bytearray(part[i : i + (1 << 20)]))
    out.close()
    spark.sparkContext.addFile(path.toString())
    return file


def shared(file: str) -> dict[str, np.ndarray]:
    """The arrays of share(), mapped, in a task."""
    path = file if "/" in file else SparkFiles.get(file)
    with open(path, "rb") as f:
        size = int.from_bytes(f.read(8), "little")
        head = json.loads(f.read(size))
    at, out = 8 + size, {}
    for k, kind, n in head:
        out[k] = np.memmap(path, np.dtype(kind), "r", at, (n,)) if n else np.zeros(0, np.dtype(kind))
        at += n * np.dtype(kind).itemsize
    return out


def trim() -> None:
    """Give freed memory back to the system: idle workers wait for other stages, beside those that run."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library than glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def lean(run: Batches) -> Batches:
    """run, a function for mapInArrow, that gives back its memory when it is done."""

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        trim()

    return out


#: Parts that a group's rows are dealt into where a group may hold a third of all rows.
SALTS = 16


def join_spread(rows: DataFrame, groups: DataFrame, key: str, by: str, how: str = "inner") -> DataFrame:
    """rows with their group's row of groups (one a key). A group's rows are dealt over SALTS tasks, by a hash of `by`."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))
    each = salted.select(key, "_salt").distinct().join(groups, key)
    return salted.join(each, [key, "_salt"], how).drop("_salt")


def with_group(rows: DataFrame, key: str, by: str, keep: str = "true", **of: tuple[str, str]) -> DataFrame:
    """rows with aggregates of their group, dealt as in join_spread; of: name -> (min, max or count, column); keep: which groups.

    rows is read twice, so it should be a table or a cheap projection of one."""
    parts = rows.groupBy(key, F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int").alias("_salt")).agg(*[getattr(F, kind)(c).alias(n) for n, (kind, c) in of.items()])
    whole = parts.groupBy(key).agg(*[getattr(F, "sum" if kind == "count" else kind)(n).alias(n) for n, (kind, _) in of.items()]).filter(keep)
    return join_spread(rows, whole, key, by)


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A table of the folder; from here on the session hands texts to Python in batches of ROWS_A_BATCH.

    spread: deal the rows out where the files give fewer tasks than there are cores (one small file); else as they lie."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_A_BATCH))
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if spread and 2 * df.rdd.getNumPartitions() <= cores else df


# --- tokenising -------------------------------------------------------------------------------------------------

_MUL = np.uint64(0x9E3779B97F4A7C15)
#: Words up to so many bytes are hashed together, eight bytes at a time; longer ones one by one.
_SHORT_WORD = 64
_MASK = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

SPACE = np.zeros(256, bool)
SPACE[list(_ASCII_SPACE)] = True

#: Everything but ASCII letters, digits and bytes of non-ASCII characters separates words.
NON_WORD = np.ones(256, bool)
NON_WORD[48:58] = NON_WORD[65:91] = NON_WORD[97:123] = NON_WORD[128:] = False

def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that all bits depend on all others."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes from start to end. Not linear in the bytes, so no words of a regular make collide.

    Words of up to eight bytes and equal length never collide; others do by chance only, about n * n / 2 ** 65 of n words."""
    size = end - start
    eight = np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(16, np.uint8)]), strides=(1,))
    h = mix(size.astype(np.uint64) * _MUL)
    h = mix(h ^ (eight[start] & _MASK[np.minimum(size, 8)]))
    more = np.flatnonzero((size > 8) & (size <= _SHORT_WORD))
    at = 8
    while len(more):
        left = np.minimum(size[more] - at, 8)
        h[more] = mix(h[more] ^ (eight[start[more] + at] & _MASK[left]))
        at += 8
        more = more[size[more] > at]
    for i in np.flatnonzero(size > _SHORT_WORD).tolist():
        h[i] = xxhash.xxh3_64_intdigest(data[start[i] : end[i]].tobytes(), 7)
    return h


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and len + 1 offsets of a string array; nulls are empty."""
    col = col.cast(pa.large_string()) if not pa.types.is_large_string(col.type) else col
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most so many bytes each, or one row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


class Words:
    """The words of some rows: row (of the slice), start and end (bytes from the slice's start), hash; first has each row's first word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separators: np.ndarray, lower: bool = True):
        base, self.n_rows = offsets[0], len(offsets) - 1
        d = data[base : offsets[-1]]
        if lower:
            d = LOWER[d]
        self.data = d
        off = offsets - base
        self.offsets = off
        inside = np.zeros(len(d) + 2, np.int8)
        inside[1:-1] = ~separators[d]
        # a row's end also ends a word: split at row starts
        step = np.diff(inside)
        starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        cuts = off[1:-1]
        cuts = np.unique(cuts[(cuts > 0) & (cuts < len(d))])
        cuts = cuts[(inside[cuts] == 1) & (inside[cuts + 1] == 1)]  # a word on both sides
        if len(cuts):
            starts = np.sort(np.concatenate([starts, cuts]))
            ends = np.sort(np.concatenate([ends, cuts]))
        self.start, self.end = starts, ends
        self.first = np.searchsorted(starts, off)
        self.count = np.diff(self.first)
        self.row = np.repeat(np.arange(self.n_rows), self.count)

    def hashes(self) -> np.ndarray:
        return hash_spans(self.data, self.start, self.end)


def distinct_per_row(row: np.ndarray, h: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct (row, hash) with counts: hashes, counts, n_rows + 1 row offsets."""
    order = np.lexsort((h, row))
    r, v = row[order], h[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (v[1:] != v[:-1])
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(r)))
    return v[at], counts, np.searchsorted(r[at], np.arange(n_rows + 1))
