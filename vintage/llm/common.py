"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintage.session import checkpoint_dir

#: White space of all word contracts: blank, \t, \n, \v, \f, \r.
WS = " \t\n\x0b\x0c\r"
#: The same as a regular-expression class and the word pattern made of it.
WS_CLASS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application: Python tasks
    then import it wherever they run."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    root = Path(__file__).resolve().parent.parent
    made = Path(tempfile.mkdtemp(prefix="vintage-ship-")) / "vintage_package.zip"
    with zipfile.ZipFile(made, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(made))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder of ``spark.checkpoint.dir`` and
    cut its lineage: later readers and retries after a lost executor read
    the files instead of computing it again."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Like ``checkpointed``, as compressed columns, and gone with ``dropped``."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/vintage-cut/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def dropped(*frames: DataFrame) -> None:
    """Remove the files of ``written`` frames that nothing reads any more:
    whatever was made of them has been written itself."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._written)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have (any case)."""
    have = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in have:
            n = "_" + n
        have.add(n.lower())
        out.append(n)
    return out


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once: inside a lambda a plain
    expression would be computed again for every element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def one_row(rows: DataFrame, ids: DataFrame, value: str) -> DataFrame:
    """(id, value) of the few ``ids``, which are broadcast: of every id the
    ``value`` of smallest hash. Repeats are merged before they move."""
    few = F.broadcast(ids.select("id").distinct())
    return (rows.join(few, "id", "left_semi").groupBy("id").agg(F.min(F.struct(F.xxhash64(value).alias("hash"), value)).alias("one"))
            .select("id", f"one.{value}"))


#: Longs of the bit table that :func:`few_others` broadcasts, at most.
FILTER = 1 << 18


def few_others(rows: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """The ``rows`` whose id may occur in ``ids``: all that do, and those few
    others whose hash has the same bit, for a join on the id that follows.
    Broadcast is a table of bits, of ``FILTER`` longs at most whatever the
    input holds, so rows that the join has no use for stay where they are."""
    def place(df: DataFrame) -> tuple[Column, Column]:
        bit = F.pmod(F.xxhash64(df[id_col]), F.lit(64 * FILTER))
        return F.floor(bit / 64), (bit % 64).cast("int")

    long, bit = place(ids)
    bits = ids.groupBy(long.alias("long")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bits"))
    long, bit = place(rows)
    return rows.join(F.broadcast(bits), (long == bits["long"]) & (F.getbit(bits["bits"], bit) == 1), "left_semi")


def words(text: Column) -> Column:
    """Array of the words of ``text``; empty for null and for no words."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WS_CLASS + "+"))
