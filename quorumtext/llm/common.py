"""Helpers that the training-data operators share."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import ship

_OWN_FOLDERS: dict[str, SparkSession] = {}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The application's folder below ``spark.checkpoint.dir``, which the cluster names.

    Only where the setting is absent and the master is local (tests) is a folder made here, and
    then the setting is made too; on a cluster a machine's own folder would not be shared.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='quorumtext-checkpoint-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    folder = f"{root.rstrip('/')}/quorumtext-{spark.sparkContext.applicationId}"
    _OWN_FOLDERS.setdefault(folder, spark)
    return folder


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as a table in the shared folder and reads it back.

    This cuts the lineage with files that outlive any executor, and gives later
    joins true sizes.  The folder goes when the application ends.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@atexit.register
def _drop_folders() -> None:
    for folder, spark in _OWN_FOLDERS.items():
        try:
            context = spark.sparkContext
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # the session has ended before; the files are only left over
            pass


BATCH = {"spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20, "spark.sql.execution.arrow.maxRecordsPerBatch": 2000}


def _number(value: str | None) -> int:
    digits = "".join(c for c in value or "" if c.isdigit())
    return int(digits or 0) if (value or "").endswith("b") or (value or "").isdigit() else 0


def map_arrow(df: DataFrame, work, schema, encodes: bool = False) -> DataFrame:
    """``mapInArrow`` with batches of a few MB.

    Spark's own bound is 64 MB a batch, of which each running task holds several, in the
    JVM's direct memory and again in Python; texts of any length are better served by
    few at a time.  The session keeps a lower bound if it has one.  Only work that ``encodes`` keeps the
    worker's tokenizer and its memos for the next task.
    """
    ship(df.sparkSession)
    conf = df.sparkSession.conf
    for key, most in BATCH.items():
        now = _number(conf.get(key, None))
        if not 0 < now <= most:
            conf.set(key, str(most))
    return df.mapInArrow(lambda batches: _tidy(work, batches, encodes), schema)


def _tidy(work, batches, encodes: bool):
    """A worker process serves one stage after the other: what only this task or another kind of task needs goes back to the system."""
    from . import shingles, tokens

    if not encodes:
        tokens.forget()
    try:
        yield from work(batches)
    finally:
        shingles.forget()
        give_back()


def give_back() -> None:
    """Freed memory of Arrow and of the C library, to the system."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def free_name(base: str, taken: list[str]) -> str:
    """``base``, with underscores before it until no column of ``taken`` has that name (in any case)."""
    names = {c.lower() for c in taken}
    while base.lower() in names:
        base = f"_{base}"
    return base


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


def single_thread() -> None:
    """A worker process is one Spark task: native libraries must not start pools."""
    for name in ("OMP_NUM_THREADS", "OPENBLAS_NUM_THREADS", "MKL_NUM_THREADS"):
        os.environ.setdefault(name, "1")
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


FILTER_WORDS = 131_072


def may_have_key(df: DataFrame, keys: DataFrame, on: str, words: int = FILTER_WORDS) -> DataFrame:
    """Rows of ``df`` whose ``on`` may be in ``keys``: all that are, and few others.

    ``keys`` become a bit map of a fixed size (``words`` rows of 64 bits), so that it can be
    broadcast whatever the number of keys, and rows that no later join needs leave
    before they are shuffled.
    """
    word = lambda: F.pmod(F.xxhash64(on, F.lit(11)), F.lit(words))
    bit = lambda: F.expr(f"shiftleft(1L, cast(pmod(xxhash64({on}, 13), 64) as int))")
    bits = keys.select(word().alias("_word"), bit().alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    columns = [df[c] for c in df.columns]
    return df.withColumn("_word", word()).join(F.broadcast(bits), "_word").where(F.col("_bits").bitwiseAND(bit()) != 0).select(*columns)
