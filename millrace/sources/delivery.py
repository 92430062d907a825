"""Writes batches into a landing area as the delivery contract defines them.

One folder per feed and business date, `part-<attempt>-<number>.jsonl` files, the manifest last. A day's rows are hashed
over as many files as its size asks for, so no file and no task grows with the day.
"""
from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import materialize
from millrace.sources import files
from millrace.sources.manifests import MANIFEST_NAME

FILE_SCHEMA = "business_date date, file_name string, records bigint, sha256 string, path string"


def _stream_opener():
    """(root, source, entity, day, name) -> (uri, open output stream), made to travel with a task."""
    locate = files.opener()

    def open_stream(root: str, source: str, entity: str, day, name: str):
        uri = f"{root}/{source}/{entity}/{day:%Y}/{day:%m}/{day:%d}/{name}"
        filesystem, path = locate(uri)
        filesystem.create_dir(path.rsplit("/", 1)[0], recursive=True)
        return uri, filesystem.open_output_stream(path)
    return open_stream


def write_files(rows: DataFrame, root: str, source: str, entity: str, attempt: int = 0,
                rows_per_file: int = 2_000_000, order: str | None = None) -> DataFrame:
    """`rows`: (business_date, line, ...). Returns one row per written file: name, count, sha256.

    A file's name holds the attempt and its number, so no attempt meets the files of another. The content of a file is fixed by the data, so a retried task
    writes the same bytes under the same name. `order` should be unique per row: equal lines then spread over
    the day's files instead of sharing one.
    """
    order = order or "line"
    sizes = rows.groupBy("business_date").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(rows_per_file)).cast("int").alias("_files"))
    part = F.pmod(F.xxhash64(*dict.fromkeys([order, "line"])), F.col("_files")).cast("int") + 1
    placed = (rows.join(sizes, "business_date").withColumn("_part", part)
              .select("business_date", "_part", *dict.fromkeys([order, "line"])))
    arranged = (placed.repartition("business_date", "_part")
                .sortWithinPartitions("business_date", "_part", order)
                .select("business_date", "_part", "line"))

    open_stream = _stream_opener()

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, stream, sha, count, target, done = None, None, None, 0, None, []

        def close():
            if stream is not None:
                stream.close()
                done.append((current[0], f"part-{attempt:02d}-{current[1]:06d}.jsonl", count, sha.hexdigest(), target))

        for batch in batches:
            for key, lines in batch.groupby(["business_date", "_part"], sort=False)["line"]:
                if key != current:
                    close()
                    current, sha, count = key, hashlib.sha256(), 0
                    target, stream = open_stream(root, source, entity, key[0], f"part-{attempt:02d}-{key[1]:06d}.jsonl")
                block = ("\n".join(lines) + "\n").encode("utf-8")
                stream.write(block)
                sha.update(block)
                count += len(lines)
        close()
        yield pd.DataFrame(done, columns=["business_date", "file_name", "records", "sha256", "path"])

    return materialize(arranged.mapInPandas(write, FILE_SCHEMA))


def write_manifests(batches: DataFrame, root: str) -> None:
    """One manifest per row of `batches`; columns are the manifest's fields, business_date a DATE.

    Files per batch are few by construction (rows / rows_per_file), so a batch's list fits its manifest.
    """
    document = F.to_json(F.struct(*[F.col(c) for c in batches.columns]))
    ready = batches.select("source", "entity", "business_date", document.alias("document"))

    open_stream = _stream_opener()

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                with open_stream(root, row.source, row.entity, row.business_date, MANIFEST_NAME)[1] as stream:
                    stream.write((json.dumps(json.loads(row.document), indent=2) + "\n").encode("utf-8"))
            yield pd.DataFrame({"written": [len(frame)]})

    ready.mapInPandas(write, "written int").agg(F.sum("written")).collect()
