"""Zip archives: reading members (also of archives within archives) as rows, writing with verification before anything is deleted."""

from __future__ import annotations

import io
import os
import shutil
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession


def _members(name: str, data: bytes, wanted: str) -> Iterator[tuple[str, str]]:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        for m in z.namelist():
            if m.endswith(".zip"):
                yield from _members(f"{name}/{m}", z.read(m), wanted)
            elif m.endswith(wanted):
                with z.open(m) as f:
                    for line in io.TextIOWrapper(f, encoding="utf-8", errors="replace"):
                        yield f"{name}/{m}", line.rstrip("\r\n")


def read_zip_lines(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """member, value: the lines of all members whose name ends with suffix. One archive is one task, as zip files can't be split."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for p, content in zip(b["path"], b["content"], strict=True):
                rows: list[tuple[str, str]] = []
                for row in _members(os.path.basename(p), content, suffix):
                    rows.append(row)
                    if len(rows) == 10_000:
                        yield pd.DataFrame(rows, columns=["member", "value"])
                        rows = []
                yield pd.DataFrame(rows, columns=["member", "value"])

    return files.mapInPandas(run, "member string, value string")


def archive_folder(folder: str, target: str, delete: bool = False, spare: float = 1.1) -> list[str]:
    """Writes the files of a folder into a zip archive and gives their names. Checks free space before, sizes and checksums after;
    only then a marker ``.ok`` appears beside the archive, and only with it sources may be deleted."""
    names = sorted(n for n in os.listdir(folder) if os.path.isfile(os.path.join(folder, n)))
    need = sum(os.path.getsize(os.path.join(folder, n)) for n in names) * spare
    if shutil.disk_usage(os.path.dirname(os.path.abspath(target))).free < need:
        raise OSError("not enough space for the archive")
    with zipfile.ZipFile(f"{target}.tmp", "w", zipfile.ZIP_DEFLATED, compresslevel=6) as z:
        for n in names:
            z.write(os.path.join(folder, n), n)
    with zipfile.ZipFile(f"{target}.tmp") as z:
        sizes = {i.filename: i.file_size for i in z.infolist()}
        if z.testzip() is not None or sizes != {n: os.path.getsize(os.path.join(folder, n)) for n in names}:
            raise OSError("the archive differs from its sources")
    os.replace(f"{target}.tmp", target)
    open(f"{target}.ok", "w").close()
    if delete:
        for n in names:
            os.remove(os.path.join(folder, n))
    return names
