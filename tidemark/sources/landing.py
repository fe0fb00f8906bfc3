"""Schema history of the landing zone.

The folders of a landing zone may have been written with different schemas.
Each folder's schema is read from its footers; the types of a column join in
the order int, long, double, string, and other types only with themselves.
Folders with one schema are read together, cast to the joined type and
unioned by name, so the plan grows with the schemas, not with the folders. A
folder whose column can't join goes to quarantine whole, as JSON records with
the reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WIDTH = [T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()]
_NARROW = {T.ByteType(): T.IntegerType(), T.ShortType(): T.IntegerType(), T.FloatType(): T.DoubleType()}


def folders(spark: SparkSession, root: str) -> list[str]:
    """Data folders directly under ``root``, in name order."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(st.getPath().toString() for st in fs.listStatus(path)
                  if st.isDirectory() and not st.getPath().getName().startswith(("_", ".")))


def widen(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The least type that holds both; None if there is none."""
    a, b = _NARROW.get(a, a), _NARROW.get(b, b)
    if a == b:
        return a
    if a in WIDTH and b in WIDTH:
        return WIDTH[max(WIDTH.index(a), WIDTH.index(b))]
    return None


def join_schemas(schemas: list[tuple[str, T.StructType]]) -> tuple[T.StructType, dict[str, str]]:
    """The joined schema of named schemas, in their order, and the reason why each rejected one can't join.

    A schema is taken or rejected as a whole: the first one sets a column's
    type, later ones widen it or conflict with it.
    """
    types: dict[str, T.DataType] = {}
    rejected: dict[str, str] = {}
    for name, schema in schemas:
        wider = {f.name: widen(types[f.name], f.dataType) if f.name in types else _NARROW.get(f.dataType, f.dataType)
                 for f in schema.fields}
        bad = [c for c, t in wider.items() if t is None]
        if bad:
            rejected[name] = "; ".join(
                f"{c}: {schema[c].dataType.simpleString()} against {types[c].simpleString()}" for c in sorted(bad))
        else:
            types.update(wider)
    return T.StructType([T.StructField(c, t, True) for c, t in types.items()]), rejected


REJECTED = T.StructType([T.StructField("folder", T.StringType()), T.StructField("reason", T.StringType()),
                         T.StructField("record", T.StringType())])


def read_evolved(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(rows in the joined schema, quarantined records) of all folders under ``root``.

    Columns a folder lacks are NULL; no row is lost. A folder without files
    has no schema and no rows.
    """
    found: list[tuple[str, T.StructType]] = []
    for f in folders(spark, root):
        schema = spark.read.parquet(f).schema if _has_files(spark, f) else None
        if schema is not None:
            found.append((f, schema))
    joined, reasons = join_schemas(found)
    alike: dict[str, tuple[T.StructType, list[str]]] = {}
    for f, schema in found:
        if f not in reasons:
            alike.setdefault(schema.json(), (schema, []))[1].append(f)
    rows = spark.createDataFrame([], joined)
    for schema, paths in alike.values():
        part = spark.read.schema(schema).parquet(*paths)
        rows = rows.unionByName(part.select(*[
            (F.col(f"`{c.name}`") if c.name in schema.names else F.lit(None)).cast(c.dataType).alias(c.name) for c in joined.fields]))
    bad = spark.createDataFrame([], REJECTED)
    for f, reason in reasons.items():
        bad = bad.unionByName(spark.read.parquet(f).select(
            F.lit(f.rstrip("/").rpartition("/")[2]).alias("folder"), F.lit(reason).alias("reason"),
            F.to_json(F.struct("*")).alias("record")))
    return rows, bad


def _has_files(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return any(not st.getPath().getName().startswith(("_", ".")) for st in fs.listStatus(path))
