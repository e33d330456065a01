"""Helpers shared by the operators of this package."""

from __future__ import annotations

import atexit
import ctypes
import functools
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch are decoded to Python strings in slices of about this many bytes, so that memory does
#: not follow the batch size. A single longer text is a slice of its own.
SLICE_BYTES = 4 << 20


#: Rows of an Arrow batch between Spark and Python, where the session allows more: whole texts may be long.
BATCH_ROWS = 1_000


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch size to ``BATCH_ROWS``, so that a batch of long texts fits beside the others."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from ``spark.checkpoint.dir``. Where it is unset, a temporary folder serves if
    driver and executors are one process; on a cluster that is an error, as executors would not see each other's files."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = spark.conf.get("parley.scratch.dir", None)
        if not path:
            path = f"file://{tempfile.mkdtemp(prefix='parley-')}"
            spark.conf.set("parley.scratch.dir", path)
    return path.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _delete_quietly(spark: SparkSession, path: str) -> None:
    try:
        _delete(spark, path)
    except Exception:  # the session is gone at exit: nothing is left to clean with
        pass


#: Spark then deletes the shuffle files of a query at its end, not when the driver happens to collect its garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and reread it: lineage is cut, a lost executor costs nothing, and what was
    shuffled for it is deleted.

    The folder is removed when the driver's Python ends.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    path = f"{shared_dir(spark)}/parley-{name}-{uuid.uuid4().hex}"
    own = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(SHUFFLES_GO) if own is None else spark.conf.set(SHUFFLES_GO, own)
    atexit.register(_delete_quietly, spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._parley_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the table behind a frame of ``stored`` that nothing reads any more."""
    _delete_quietly(df.sparkSession, df._parley_path)


#: Bits by which ``maybe_among`` tells keys apart.
MARKS = 1 << 26


def maybe_among(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows whose ``key`` (long) is in the only column of ``keys``, and a few others: a filter by a bitmap of at most 8 MB in
    front of a join, so that long rows without a partner are not shuffled."""
    mark = lambda c: F.pmod(c, F.lit(MARKS))
    of = keys.select(mark(F.col(keys.columns[0])).alias("mark"))
    maps = of.groupBy(F.bitmap_bucket_number("mark").alias("marks_at")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("mark")).alias("marks"))
    bit = F.bitmap_bit_position(mark(rows[key]))
    byte = F.conv(F.hex(F.substr("marks", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = byte.bitwiseAND(F.pow(F.lit(2), bit % 8).cast("int")) != 0
    return rows.join(F.broadcast(maps), (F.bitmap_bucket_number(mark(rows[key])) == F.col("marks_at")) & found, "left_semi")


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[list[str | None]]:
    """The strings of an Arrow array in order, in lists of at most ``most`` bytes, or one longer string."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    start, n, done = 0, len(texts), 0
    while start < n:
        stop = max(start + 1, int(np.searchsorted(ends, done + most, "right")))
        yield texts.slice(start, stop - start).to_pylist()
        start, done = stop, int(ends[stop - 1])


def _give_back() -> None:
    """Return freed memory to the system; without this a reused worker keeps the most it ever had."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def frugal(task: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """A generator over the batches of a task that gives memory back at its end."""

    @functools.wraps(task)
    def run(*args):
        yield from task(*args)
        _give_back()

    return run


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the same nodes as (u, v) do: each node but the least of a component with that one."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b, least = at[: len(u)], at[len(u) :], np.arange(len(nodes))
    while len(a):
        x, y = least[a], least[b]
        a, b = a[x != y], b[x != y]
        np.minimum.at(least, np.maximum(x, y), np.minimum(x, y))
        while (least[least] != least).any():
            least = least[least]
    other = np.flatnonzero(least != np.arange(len(nodes)))
    return nodes[least[other]], nodes[other]


#: Links that a task connects at a time.
LINKS = 1 << 20


def _contracted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From links (u, v) the ``stars`` of up to ``LINKS`` of them at a time, the greater node first."""

    def made() -> pa.RecordBatch:
        low, high = stars(*(np.concatenate(x) for x in zip(*held)))
        return pa.RecordBatch.from_arrays([pa.array(high), pa.array(low)], names=["u", "v"])

    held, size = [], 0
    for part in parts:
        held.append((part.column(0).to_numpy(), part.column(1).to_numpy()))
        size += len(part)
        if size >= LINKS:
            yield made()
            held, size = [], 0
    if size:
        yield made()


def connected(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of ``edges`` (u, v: any one orderable type), as rows (node, root): root is the least node.

    Alternating large-star and small-star steps over Parquet tables in the shared folder; a step's table is deleted once
    the next one is written. Where nodes are integers of 64 bits each task first connects its own links, which saves
    steps. Each step is one aggregate and one equi-join, which adaptive execution splits where a node has very many
    links; nothing reaches the driver but counts. Nodes without links have no row. Empty input gives an empty result.
    """

    def with_low(links: DataFrame) -> DataFrame:
        return links.join(links.groupBy("u").agg(F.min("v").alias("low")), "u")

    links = stored(edges.where("u <> v").selectExpr("greatest(u, v) u", "least(u, v) v").distinct(), f"{name}-links")
    mark = (F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
    before = links.agg(*mark).first()
    whole = dict(links.dtypes) == {"u": "bigint", "v": "bigint"}
    while before[0]:
        less = links.mapInArrow(_contracted, "u long, v long") if whole else links
        both = less.union(less.selectExpr("v u", "u v"))
        large = with_low(both).where("v > u").selectExpr("v u", "least(u, low) v").distinct()
        small = with_low(large)
        older, links = links, stored(small.where("v <> low").selectExpr("v u", "low v").union(small.selectExpr("u", "low v")).distinct(), f"{name}-links")
        discard(older)
        now = links.agg(*mark).first()
        if now == before:
            break
        before = now
    return links.selectExpr("u node", "v root").union(links.selectExpr("v node", "v root").distinct())


#: Solves a set of candidates: (payloads, labels, asked) to new labels. Members whose labels are equal are joined already;
#: of the pairs that hold a member of ``asked``, those that link join their labels, the lesser of which stays.
Solver = Callable[[list, list, list[bool]], list]


def _solved(solve: Solver):
    """From rows (task, node, label, asked, payload), sorted by task: (node, label, joined) where ``joined`` is the new label."""

    @frugal
    def solved(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held, kind = None, {}, None
        out: tuple[list, list, list] = ([], [], [])

        def flush() -> None:
            nodes = sorted(held)
            rows = [held[n] for n in nodes]
            labels = [r[0] for r in rows]
            for column, values in zip(out, (nodes, labels, solve([r[2] for r in rows], labels, [r[1] for r in rows]))):
                column.extend(values)

        def batch() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, kind) for c in out], names=["node", "label", "joined"])
            for column in out:
                column.clear()
            return made

        for part in parts:
            kind = part.schema.field("node").type
            for t, node, label, asked, payload in zip(*(c.to_pylist() for c in part.columns)):
                if t != task:
                    if held:
                        flush()
                        if len(out[0]) >= BATCH_ROWS:
                            yield batch()
                    task, held = t, {}
                if asked or node not in held:
                    held[node] = (label, asked, payload)
        if held:
            flush()
            yield batch()

    return solved


def joined_sets(sets: DataFrame, fetch: Callable[[DataFrame], DataFrame], solve: Solver, name: str, unsettled: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Rows (node, root) of the links inside candidate sets; ``sets`` is a table (read more than once) with node, part (the
    set) and size (the share of one task that a member may fill at worst); ``fetch`` adds the payload to rows (task, node,
    label, asked). All pairs of a set count, however large it is; a set's repeated nodes are one.

    A set that fits is solved in one task. A larger one is cut into blocks: first each block alone, then one member of
    each group found, which joins most of what links; what is still apart after that is compared as a grid of blocks, the
    members outside a set's largest group against all, so that only sets which really fall apart cost more than a pass.
    ``unsettled`` may narrow that down: of rows (node, part, label) it gives the nodes that may still link with one of
    another label.
    """
    kind = sets.schema["node"].dataType.simpleString()

    def run(tasks: DataFrame) -> DataFrame:
        rows = fetch(tasks.select("task", "node", "label", "asked")).select("task", "node", "label", "asked", "payload")
        # a number of partitions of its own, as the work of a task does not follow its bytes
        return rows.repartition(int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")), "task").sortWithinPartitions("task").mapInArrow(_solved(solve), f"node {kind}, label {kind}, joined {kind}")

    def blocked(df: DataFrame, count: str) -> DataFrame:
        return df.select(F.xxhash64("part", F.pmod(F.xxhash64("node"), F.col(count))).alias("task"), "node", F.col("node").alias("label"), F.lit(True).alias("asked"))

    parts = sets.groupBy("part").agg(F.greatest(F.lit(1), F.ceil(F.sum("size")).cast("int")).alias("blocks"))
    cut = stored(sets.join(parts, "part"), f"{name}-sets")
    first = stored(run(blocked(cut, "blocks")).select("node", F.col("joined").alias("label")), f"{name}-blocks")
    large = cut.where("blocks > 1")
    if not large.head(1):
        return first.selectExpr("node", "label root").distinct()
    grouped = large.join(first, "node")
    # one member of each group
    leads = grouped.where("node = label").select("part", "node", "size")
    few = leads.groupBy("part").agg(F.greatest(F.lit(1), F.ceil(F.sum("size")).cast("int")).alias("few"))
    second = run(blocked(leads.join(few, "part"), "few")).select(F.col("node").alias("label"), F.col("joined").alias("lead")).distinct()
    grouped = stored(grouped.join(second, "label").drop("label").withColumnRenamed("lead", "label"), f"{name}-grouped")
    # what is apart still: members outside the largest group of their set against all of the set
    if unsettled is not None:
        settled, grouped = grouped, stored(grouped.join(unsettled(grouped.select("node", "part", "label")).distinct(), "node"), f"{name}-unsettled")
    groups = grouped.groupBy("part", "label").agg(F.count("*").alias("n"))
    largest = groups.groupBy("part").agg(F.max_by("label", F.struct("n", "label")).alias("largest"), F.count("*").alias("groups")).where("groups > 1")
    apart = grouped.join(largest, "part").withColumn("asked", F.col("label") != F.col("largest"))
    sides = apart.groupBy("part").agg(F.greatest(F.lit(1), F.ceil(F.sum(F.when(F.col("asked"), F.col("size")))).cast("int")).alias("asking"))
    apart = apart.join(sides, "part")
    row, column = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"), F.pmod(F.xxhash64("node", F.lit(1)), F.col("asking")).cast("int")
    grid = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    across = apart.select("*", row.alias("a"), grid("asking").alias("b")).withColumn("asked", F.lit(False))
    down = apart.where("asked").select("*", column.alias("b"), grid("blocks").alias("a"))
    third = run(across.unionByName(down).withColumn("task", F.xxhash64("part", "a", "b")))
    last = connected(third.selectExpr("label u", "joined v"), f"{name}-last").withColumnsRenamed({"node": "label", "root": "last"}).distinct()
    final = (grouped if unsettled is None else settled).join(last, "label", "left").select("node", F.coalesce("last", "label").alias("root"))
    return first.join(large.select("node").distinct(), "node", "left_anti").selectExpr("node", "label root").union(final).distinct()
