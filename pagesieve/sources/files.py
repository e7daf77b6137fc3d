"""Single files read and written inside tasks, on any file system Arrow opens."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Files of a task that are open, and whose content is held, at one time.
AT_ONCE = 16


def place_of(uri: str):
    """File system and path of a URI or an absolute path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if ":/" in uri else f"file://{uri}")


def as_uri(folder: str) -> str:
    """The folder with its scheme, and without a slash at its end."""
    return (folder if ":/" in folder else f"file://{folder}").rstrip("/")


def dealt(df: DataFrame, tasks: int | None, *columns: str) -> DataFrame:
    """Rows that name files are few bytes and much work, which Spark cannot see: deal them by
    ``columns`` to a number of tasks, where one is given."""
    return df.repartition(tasks, *columns) if tasks else df


def fetch_snapshots(
    rows: DataFrame,
    root: str,
    path: str = "file_path",
    name: str = "html",
    tasks: int | None = None,
) -> DataFrame:
    """Add the text of the file each row names, relative to ``root``, as column ``name``.

    Only named files are opened, inside the tasks: the store is not listed, and no HTML is joined
    or shuffled. A NULL path, a file that is missing and one that is not UTF-8 give NULL. Rows
    leave in batches of a few files, so a task holds no more than those. An existing column
    ``name`` is replaced.
    """
    rows = dealt(rows.drop(name), tasks, path)
    schema = T.StructType([*rows.schema.fields, T.StructField(name, T.StringType())])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from concurrent.futures import ThreadPoolExecutor

        store, base = place_of(root)

        def text_of(file: str | None) -> str | None:
            if file is None:
                return None
            try:
                with store.open_input_stream(f"{base.rstrip('/')}/{file}", compression=None) as stream:
                    return stream.read().decode("utf-8")
            except (FileNotFoundError, UnicodeDecodeError):
                return None

        with ThreadPoolExecutor(AT_ONCE) as pool:
            for batch in batches:
                for at in range(0, batch.num_rows, AT_ONCE):
                    part = batch.slice(at, AT_ONCE)
                    texts = list(pool.map(text_of, part.column(path).to_pylist()))
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, name]
                    )

    return rows.mapInArrow(fetch, schema)


def store_snapshots(rows: DataFrame, root: str, path: str = "file_path", content: str = "content") -> DataFrame:
    """Write the bytes of each row as the file it names below ``root``; gives ``path`` and
    ``n_bytes``. Writing again overwrites. Rows with NULL in either column write nothing."""
    rows = rows.where(F.col(path).isNotNull() & F.col(content).isNotNull())
    rows = rows.select(path, F.col(content).cast("binary").alias(content))
    schema = T.StructType([rows.schema[path], T.StructField("n_bytes", T.LongType())])

    def store_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = place_of(root)
        for batch in batches:
            sizes = []
            for file, data in zip(batch.column(path).to_pylist(), batch.column(content), strict=True):
                target = f"{base.rstrip('/')}/{file}"
                store.create_dir(target.rsplit("/", 1)[0], recursive=True)
                with store.open_output_stream(target, compression=None) as stream:
                    stream.write(data.as_buffer())
                sizes.append(data.as_buffer().size)
            yield pa.RecordBatch.from_arrays([batch.column(path), pa.array(sizes, pa.int64())], names=[path, "n_bytes"])

    return rows.mapInArrow(store_all, schema)
