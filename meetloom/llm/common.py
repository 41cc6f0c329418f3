"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of an Arrow batch that is sent to Python, and of the texts that a worker holds as Python strings at once.
BATCH_BYTES, SLICE_BYTES = 8 << 20, 2 << 20


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(c, UPPER, LOWER)


def lower_words(text: str | None) -> list[bytes]:
    """Lower-case A-Z, then the words [^\\x20\\x09-\\x0D]+ as UTF-8 bytes (bytes.split cuts at just those six)."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def shared_checkpoints(spark: SparkSession) -> None:
    """Use the folder that the cluster names; a folder of our own only where none is set and all runs on one machine (tests)."""
    jsc = spark.sparkContext._jsc.sc()
    if jsc.getCheckpointDir().isDefined():
        return
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith(("local[", "local ")) and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="meetloom-ckpt-"))


def saved(df: DataFrame) -> DataFrame:
    """df computed once into the shared checkpoint folder; lineage ends there, so a lost executor costs no recomputation."""
    shared_checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Like saved, as a compressed Parquet table in the shared folder. It stays as long as that folder does, since a later job may read it again."""
    spark = df.sparkSession
    shared_checkpoints(spark)
    path = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Batches for Python hold at most BATCH_BYTES, by the session's own setting; a smaller value stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = str(spark.conf.get(key)).lower().rstrip("b")
    unit = {"k": 10, "m": 20, "g": 30}.get(now[-1:], 0)
    size = int(now[:-1] if unit else now) << unit
    if not 0 < size <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, list[str | None]]]:
    """(index of the first, texts) of runs of a batch's texts; a run of over one text has at most `limit` bytes."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False).tolist()
    at = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > limit:
            yield at, texts.slice(at, i - at).to_pylist()
            at, held = i, 0
        held += n + 64
    if at < len(sizes):
        yield at, texts.slice(at).to_pylist()


def each_text(texts: pa.Array) -> Iterator[str | None]:
    for _, some in text_slices(texts):
        yield from some


def text_udf(kind: str, to_arrow: Callable[[list], pa.Array], make: Callable[[], Callable[[str | None], Any]]):
    """An Arrow UDF of a text column. make() is called once a task and returns the function of one text; to_arrow makes a batch's results an array."""

    @F.arrow_udf(kind)
    def apply(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        f = make()
        for texts in parts:
            yield to_arrow([f(t) for t in each_text(texts)])

    return apply


_held: list[tuple[Any, Any]] = []


def held_one(key: Any, build: Callable[[], Any]) -> Any:
    """What build() made for key, in this process. Only the last one is held, so a worker that goes from stage to stage has one stage's tables."""
    if not _held or _held[0][0] is not key and _held[0][0] != key:
        _held.clear()
        _held.append((key, build()))
    return _held[0][1]


def unclashing(names: Iterable[str], taken: Sequence[str]) -> list[str]:
    """The names, each lengthened until no column of `taken` has it (Spark compares names without case)."""
    low, out = {t.lower() for t in taken}, []
    for n in names:
        while n.lower() in low:
            n += "_"
        out.append(n)
    return out


def training_part(key: Column, parts: int, held_out: int) -> Column:
    """True for rows that may be learned from: crc32 of the key as text, mod parts, is not held_out. A null key counts as ''."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts != held_out
