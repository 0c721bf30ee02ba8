"""What the operators share: scratch tables in the shared folder, and Arrow batches in small slices."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Collection, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own: dict[str, str] = {}
_written: dict[str, list[str]] = {}

#: Bits of a piece of a bitmap, as bitmap_construct_agg makes them, and of all pieces.
PIECE, MOST_BITS = 1 << 15, 1 << 26

#: Sorts after every real id; stands for a null one inside the operators.
NO_ID = 2**63 - 1


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a local master
    gets a temporary folder; on a cluster that is an error, as executors would not see one another's files."""
    if path := spark.conf.get("spark.checkpoint.dir", None):
        return path.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and the executors share")
    if sc.applicationId not in _own:
        _own[sc.applicationId] = "file://" + tempfile.mkdtemp(prefix="chainlake-")
    return _own[sc.applicationId]


def scratch_path(spark: SparkSession, tag: str) -> str:
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def sweep(spark: SparkSession, since: int = 0, keep: Collection[str] = ()) -> int:
    """Delete this application's scratch tables from the since-th on but those to keep, once results that read them are written elsewhere; how many
    there were."""
    paths = _written.get(spark.sparkContext.applicationId, [])
    gone = [p for p in paths[since:] if p not in keep]
    for path in gone:
        fs, p = filesystem(spark, path)
        fs.delete(p, True)
        paths.remove(path)
    return len(gone)


def scratch_tables(spark: SparkSession) -> list[str]:
    """The scratch tables that this application has written and not swept."""
    return list(_written.get(spark.sparkContext.applicationId, []))


def unused(columns: Collection[str], *names: str) -> list[str]:
    """The names, each with as many "_" added as it takes to be none of the columns, whatever their case."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def saved(df: DataFrame, tag: str) -> DataFrame:
    """df written to a table in the shared folder and read again: cuts lineage, survives lost executors, and
    tells the planner the real size, so that it broadcasts a side only if that is small."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def split_by(df: DataFrame, keys: DataFrame, by: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The rows of df that may have one of the keys, all that do among them, and the rest. By a bitmap of hash bits, 32 for each key up to MOST_BITS,
    beyond which more and more of the others pass too; its 4 kB pieces, 8 MB at most, are broadcast. So whole texts need not be
    shuffled to find the few rows that a table of keys is about; df is scanned for each of the two."""
    n = keys.count()
    bits = min(MOST_BITS, max(PIECE, 1 << (32 * max(n, 1) - 1).bit_length()))
    place = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in by]), F.lit(bits))
    piece, bitmap = unused(df.columns, "piece", "bitmap")
    pieces = keys.select(place.alias("at")).groupBy(F.floor(F.col("at") / PIECE).alias(piece)).agg(F.bitmap_construct_agg(F.col("at") % PIECE).alias(bitmap))
    pieces = saved(pieces, "bitmap")
    byte = F.conv(F.hex(F.substring(F.col(bitmap), F.floor(place % PIECE / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    may = F.coalesce(F.call_function("shiftright", byte, (place % 8).cast("int")).bitwiseAND(1) == 1, F.lit(False))
    placed = df.withColumn(piece, F.floor(place / PIECE)).join(F.broadcast(pieces), piece, "left")
    own = [F.col(f"`{c}`") for c in df.columns]
    return placed.where(may).select(*own), placed.where(~may).select(*own)


def filesystem(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to so many rows and about so many bytes, or a single row, so that a worker's memory follows the longest text, not the batch."""
    for b in batches:
        todo = [b.slice(at, rows) for at in reversed(range(0, b.num_rows, rows))]
        while todo:
            x = todo.pop()
            if x.num_rows > 1 and x.nbytes > most:
                todo += [x.slice(x.num_rows // 2), x.slice(0, x.num_rows // 2)]
            else:
                yield x


def row_id(col: str = "doc_id") -> F.Column:
    return F.coalesce(F.col(col).cast("long"), F.lit(NO_ID))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
