"""Zipped delimited files, loads that go on where they stopped, and catalog tables laid out for joins."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .staging import new_path

#: Rows that are handed on at once.
ROWS = 10_000


def read_zipped(archives: DataFrame, columns: list[str], required: str | None = None, member: str = ".tsv", sep: str = "\t", skip: int = 0, limit: int | None = None, content: str = "content") -> DataFrame:
    """Rows (member, line, *columns as strings) of the delimited members of zip archives, one archive a row as ``binaryFile`` reads them.

    A member is decompressed as a stream, line by line, so a task holds its archive and some rows. The first line is the header; values are taken by
    its names, whatever their order; a column that it lacks is null in all rows. Quotes around values go. ``line`` counts from 1 after the
    header; the first ``skip`` lines are passed over and at most ``limit`` are looked at, so a load may go on from where another stopped.
    Lines with another number of values than the header are malformed and skipped, as are rows whose ``required`` column is empty.
    A null archive, an empty one and one that is no zip file give no rows.
    """

    def rows_of(raw: bytes) -> Iterator[tuple]:
        import io
        import zipfile

        if not raw or not zipfile.is_zipfile(io.BytesIO(raw)):
            return
        with zipfile.ZipFile(io.BytesIO(raw)) as z:
            for name in sorted(n for n in z.namelist() if n.endswith(member)):
                with io.TextIOWrapper(z.open(name), "utf-8", "replace", newline="\n") as f:
                    names = [x.strip().strip('"') for x in f.readline().rstrip("\r\n").split(sep)]
                    at = [names.index(c) if c in names else None for c in columns]
                    need = names.index(required) if required in names else None
                    for k, line in enumerate(f, 1):
                        if limit is not None and k > skip + limit:
                            break
                        values = line.rstrip("\r\n").split(sep)
                        if k <= skip or len(values) != len(names):
                            continue
                        values = [v.strip().strip('"') for v in values]
                        if required is None or (need is not None and values[need]):
                            yield (name, k, *[None if i is None else values[i] for i in at])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        some: list[tuple] = []
        for pdf in batches:
            for raw in pdf[content]:
                for row in rows_of(raw):
                    some.append(row)
                    if len(some) == ROWS:
                        yield pd.DataFrame(some, columns=["member", "line", *columns])
                        some = []
        if some:
            yield pd.DataFrame(some, columns=["member", "line", *columns])

    return archives.select(content).mapInPandas(run, "member string, line long, " + ", ".join(f"`{c}` string" for c in columns))


def zipped(df: DataFrame, by: str, columns: list[str], name: str = "part") -> DataFrame:
    """(by, content): for each value of ``by`` an archive with one delimited member of its rows; a group must fit in a task."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        import io
        import zipfile

        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            lines = ["\t".join(f'"{c}"' for c in columns), *["\t".join(f'"{v}"' for v in r) for r in pdf[columns].itertuples(index=False)]]
            z.writestr(f"{name}-{pdf[by].iloc[0]}.tsv", "\n".join(lines) + "\n")
        return pd.DataFrame({by: [pdf[by].iloc[0]], "content": [out.getvalue()]})

    return df.groupBy(by).applyInPandas(pack, f"{by} {dict(df.dtypes)[by]}, content binary")


def load_resumably(stream: DataFrame, path: str, checkpoint: str, after: Callable[[int], None] | None = None) -> None:
    """Load what a file stream has not loaded yet into Parquet at ``path``, each row once, however often a run is stopped.

    The checkpoint knows which files make a batch; a batch overwrites its own folder, so one that was written but not yet recorded is
    written again in place. ``after`` is called after each batch is written, before it is recorded.
    """

    def put(rows: DataFrame, k: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={k}")
        if after:
            after(k)

    stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def create_table(df: DataFrame, name: str, bucket_by: str | None = None, buckets: int = 16, partition_by: list[str] | None = None, path: str | None = None) -> DataFrame:
    """A catalog table of df, partitioned by folders and bucketed and sorted by a key; tables of one key and number of buckets join
    without a shuffle. In the shared folder unless a path is given."""
    spark = df.sparkSession
    w = df.write.format("parquet").mode("overwrite").option("path", path or new_path(spark, name))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        w = w.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    w.saveAsTable(name)
    return spark.table(name)


def table_name(what: str) -> str:
    """A name that no other run of this session uses."""
    return f"tessera_{what}_{uuid.uuid4().hex[:12]}"


def joined_tables(spark: SparkSession, left: DataFrame, right: DataFrame, left_key: str, right_key: str, buckets: int = 16) -> DataFrame:
    """Both sides as tables bucketed by their keys, and their join, which reads buckets side by side; the join is not broadcast."""
    a, b = create_table(left, table_name("left"), left_key, buckets), create_table(right, table_name("right"), right_key, buckets)
    return a.hint("merge").join(b, F.col(left_key) == F.col(right_key))
