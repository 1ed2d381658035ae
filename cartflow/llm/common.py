"""Shared pieces: the word rule, written tables in the shared folder, hash splits."""

from __future__ import annotations

import tempfile
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are runs of anything but space and the control characters 9 to 13.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Array of the words of ``text`` (null text: empty array)."""
    return F.coalesce(F.filter(F.split(text, SPACES), lambda w: w != ""), F.array().cast("array<string>"))


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.

    Where it is unset, a single-machine master gets a temporary folder; a
    cluster must name one, since executors cannot see the driver's folders.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None) \
        or sc.getCheckpointDir()
    if not base:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="cartflow-")
        sc.setCheckpointDir(base)
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str, group_mb: int | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, lineage cut, safe from lost executors.

    ``group_mb`` bounds the row groups, which readers of large values hold whole.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    writer = df.write.option("compression", "zstd")
    if group_mb:
        writer = writer.option("parquet.block.size", group_mb << 20).option("parquet.block.size.row.check.min", 1) \
            .option("parquet.page.size.row.check.min", 1)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes a table of ``written`` that nothing will read again."""
    spark = df.sparkSession
    own = shared_folder(spark).removeprefix("file:").rstrip("/")
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if own.lstrip("/") in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_KEPT: dict = {}


def keep(key: tuple, make):
    """What a Python worker keeps from task to task: one thing, that of the operator it ran last."""
    from cartflow.llm import common  # the worker's own module
    if key not in common._KEPT:
        common._KEPT.clear()
        common._KEPT[key] = make()
    return common._KEPT[key]


def forget() -> None:
    """Lets go of what another operator left in this worker."""
    from cartflow.llm import common
    common._KEPT.clear()


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Python tasks of the jobs started inside get ``rows`` rows at a time; for tables of large values."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def numbered(df: DataFrame, column: str, name: str) -> DataFrame:
    """``df`` written once with a dense row number from 0 in ``column``.

    The driver sees one count for each written part, not the rows.
    """
    spark = df.sparkSession
    table = written(df.withColumn(column, F.monotonically_increasing_id()), name)
    part = F.shiftright(F.col(column), 33)
    counts = table.groupBy(part.alias("_part")).count().orderBy("_part").collect()
    starts, rows = 0, []
    for r in counts:
        rows.append((r["_part"], starts))
        starts += r["count"]
    starts = spark.createDataFrame(rows, "_part long, _start long")
    within = F.col(column).bitwiseAND(F.lit((1 << 33) - 1))
    return table.withColumn("_part", part).join(F.broadcast(starts), "_part") \
        .withColumn(column, F.col("_start") + within).drop("_part", "_start")


def rows_where(docs: DataFrame, judge_of, text: str = "text", chars: int = 1_000_000) -> DataFrame:
    """The rows of ``docs`` that a judge of their texts keeps, as they are.

    ``judge_of()`` is called once in each task and gives a function from a
    list of texts to a list of verdicts.  The verdict stays beside its row, so
    null or repeated ids do not matter.
    """
    at = docs.columns.index(text)

    def run(batches):
        import pyarrow as pa
        judge = judge_of()
        for b in batches:
            texts = b.column(at).to_pylist()
            keep, i = [], 0
            while i < len(texts):
                j, size = i, 0
                while j < len(texts) and size <= chars:
                    size += len(texts[j] or "")
                    j += 1
                keep += judge(texts[i:j])
                i = j
            yield b.filter(pa.array([bool(k) for k in keep], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def id_remainder(col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.pmod(F.crc32(col.cast("string").cast("binary")), F.lit(n))


def id_remainder_py(doc_id, n: int) -> int:
    return zlib.crc32(str(int(doc_id)).encode()) % n


def partitions(spark: SparkSession) -> int:
    """How finely this session deals out shuffled rows; users size it with their data."""
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node of each connected group, by alternating star contraction.

    Each round is two grouped minima; rounds grow with the logarithm of the number of links.  Minima are
    written tables, so that Spark may split the joins with them where a node has very many links.
    """
    edges = written(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(),
                    "links")
    before = None
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "links-low")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u <> v").distinct(), "links-large")
        low = written(large.groupBy("u").agg(F.min("v").alias("m")), "links-low")
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "links")
        now = tuple(edges.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first())
        if before == now:
            break
        before = now
    roots = edges.groupBy("u").agg(F.min("v").alias("root"))
    return roots.select(F.col("u").alias("node"), "root").unionByName(
        roots.select(F.col("root").alias("node"), "root").distinct())
