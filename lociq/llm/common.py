"""Helpers shared by the corpus operators: inputs, shared-folder tables, Arrow batches."""
from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Runs of these count as white space everywhere in this subpackage.
SPACE = r"[\x20\x09-\x0D]"
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns that operators read; other columns can't clash. Null texts count as empty."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, or that of setCheckpointDir. Only a session of one machine gets a temporary one where both are unset."""
    place = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not place:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        place = tempfile.mkdtemp(prefix="lociq-")
        spark.sparkContext.setCheckpointDir(place)
        place = spark.sparkContext.getCheckpointDir()
    return place


def stored(df: DataFrame) -> DataFrame:
    """Write df as a table in the shared folder and read it: lineage ends here, and its size is known to the planner."""
    path = f"{shared_dir(df.sparkSession)}/lociq-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def byte_chunks(column: pa.Array, most: int = 1 << 22) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, UTF-8 texts) over consecutive rows, of about `most` bytes together; a longer text comes alone."""
    column = column.cast(pa.binary())
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(column):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield at, column.slice(at, to - at).to_pylist()
        at = to


def map_arrow(df: DataFrame, f: Callable, schema: str, once_a_task: bool = False) -> DataFrame:
    """mapInArrow for a function that turns a batch into dicts of columns; once_a_task: for one that makes this function when a task begins."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    names = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = f() if once_a_task else f
        for batch in batches:
            for out in g(batch):
                yield pa.RecordBatch.from_arrays([pa.array(out[x.name], type=x.type) for x in names], schema=names)

    return df.mapInArrow(run, schema)


def keep_rows(df: DataFrame, text_col: str, start: Callable[[], Callable[[list[bytes]], np.ndarray]]) -> DataFrame:
    """The rows of df, with all their columns, for whose UTF-8 texts (null: empty) the function that start makes in a task says true."""
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = start()
        for batch in batches:
            text = pc.fill_null(batch.column(at).cast(pa.binary()), b"")
            for i, texts in byte_chunks(text, 1 << 20):
                yield batch.slice(i, len(texts)).filter(pa.array(np.asarray(keep(texts), bool)))

    return df.mapInArrow(run, df.schema)


def fold(id_col: str, n: int):
    """crc32 of the id as text, modulo n."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, most: int, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[int, bytes, int]]:
    """(doc_id, UTF-8 text, 0 or 1) of at most `most` labelled documents outside fold 0, chosen by a hash of the id.

    Several labels of a document count as their largest; null labels and ids are left out.
    """
    given = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id", folds) != 0))
    given = given.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label).cast("int").alias("y"))
    given = given.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    found = id_text(docs, id_col, text_col).join(F.broadcast(given), "doc_id")
    # A repeated id has one text, the first by value, so the sample doesn't depend on the order of rows.
    found = found.groupBy("doc_id").agg(F.min("text").cast("binary").alias("text"), F.max("y").alias("y"))
    return sorted((r[0], bytes(r[1]), int(r[2] > 0)) for r in found.toLocalIterator())


def sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * np.asarray(x, np.float64)))


def platt(logits: np.ndarray, y: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """Slope and shift that calibrate logits by logistic regression to targets drawn in a little, as Platt's. Steps are halved until the loss falls, as logits that part
    the labels would throw whole ones far off."""
    a, b, n1 = 1.0, 0.0, float(y.sum())
    y = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (len(y) - n1 + 2))
    x = np.column_stack([logits, np.ones(len(logits))])
    loss = lambda w: float((np.logaddexp(0, x @ w) - y * (x @ w)).sum() + 5e-4 * ((w[0] - 1) ** 2 + w[1] ** 2))
    for _ in range(rounds):
        w = np.array([a, b])
        p = sigmoid(x @ w)
        grad = x.T @ (p - y) + 1e-3 * np.array([a - 1, b])
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), grad)
        now = loss(w)
        while loss(w - step) > now and abs(step).max() > 1e-9:
            step = step / 2
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-6:
            break
    return float(a), float(b)
