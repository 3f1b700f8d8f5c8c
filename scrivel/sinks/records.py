"""Rendered records as files of their own, or as a table."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from scrivel.session import shared_uri
from scrivel.sources.files import folder_of


def write_record_files(
    rendered: DataFrame, folder: str, suffix: str = ".md", column: str = "markdown", folders: int | None = None
) -> None:
    """One ``{stem}.md`` per record, written by the tasks themselves.

    ``folder`` is a path or an address; see :func:`shared_uri`. A file appears under its name
    only when complete, so repeated and speculative tasks do no harm. Records without a stem have no name and
    are left out, a null text is an empty file. Fit for exports that
    people open; for large numbers of records use :func:`write_record_table`, or deal the files out to so many ``folders`` below the
    folder, which tasks can list and read side by side (:func:`scrivel.sources.files.read_dealt_files`).
    """
    uri = shared_uri(rendered.sparkSession, folder)

    def write(rows: Iterator[Row]) -> None:
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(uri)
        files.create_dir(root, recursive=True)
        made = {root}
        for row in rows:
            at = root if folders is None else f"{root}/{folder_of(row.stem, folders)}"
            if at not in made:
                files.create_dir(at, recursive=True)
                made.add(at)
            part = f"{at}/.{row.stem}.{uuid.uuid4().hex}"
            with files.open_output_stream(part) as out:
                out.write((row.text or "").encode())
            files.move(part, f"{at}/{row.stem}{suffix}")

    named = rendered.select("stem", F.col(column).alias("text")).filter("stem IS NOT NULL")
    named.foreachPartition(write)


def write_record_table(rendered: DataFrame, path: str) -> None:
    """All records as Parquet keyed by ``stem``."""
    rendered.write.mode("overwrite").parquet(path)
