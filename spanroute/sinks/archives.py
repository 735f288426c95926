"""Zip archives whose bytes follow from their members alone."""

from __future__ import annotations

import gzip
import hashlib
import io
import tarfile
import uuid
import zipfile

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame

EPOCH = (1980, 1, 1, 0, 0, 0)  # the earliest time that an entry can have


def _zip(rows: pd.DataFrame) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, content in sorted(zip(rows["member"], map(bytes, rows["content"]), strict=True)):
            info = zipfile.ZipInfo(name, EPOCH)
            info.compress_type, info.external_attr = zipfile.ZIP_DEFLATED, 0o644 << 16
            z.writestr(info, content)
    return out.getvalue()


def _tar(rows: pd.DataFrame) -> bytes:
    out = io.BytesIO()
    with gzip.GzipFile(fileobj=out, mode="wb", mtime=0) as packed, tarfile.open(fileobj=packed, mode="w") as t:
        for name, content in sorted(zip(rows["member"], map(bytes, rows["content"]), strict=True)):
            info = tarfile.TarInfo(name)
            info.size = len(content)
            t.addfile(info, io.BytesIO(content))
    return out.getvalue()


FORMS = {"zip": _zip, "tar.gz": _tar}


def zipped(members: DataFrame) -> DataFrame:
    """archive, content of each archive of members (archive, member, content); members are sorted, times fixed.

    An archive is one file, made in one task, and has to fit in its memory.
    """
    return members.groupBy("archive").applyInPandas(lambda rows: pd.DataFrame({"archive": [rows["archive"].iloc[0]], "content": [_zip(rows)]}), "archive string, content binary")


def write_archives(members: DataFrame, path: str, form: str = "zip") -> list[tuple[str, int, str]]:
    """Write each archive as ``<archive>.<form>`` under a path that all tasks reach; its name, bytes and SHA-256.

    A file gets its name when it is whole, so a task that is run again replaces the same file.
    """

    def put(rows: pd.DataFrame) -> pd.DataFrame:
        content, name = FORMS[form](rows), rows["archive"].iloc[0]
        system, at = fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)
        system.create_dir(at, recursive=True)
        part = f"{at}/_{uuid.uuid4().hex}"
        with system.open_output_stream(part) as sink:
            sink.write(content)
        system.move(part, f"{at}/{name}.{form}")
        return pd.DataFrame({"archive": [name], "bytes": [len(content)], "sha256": [hashlib.sha256(content).hexdigest()]})

    return [tuple(r) for r in members.groupBy("archive").applyInPandas(put, "archive string, bytes long, sha256 string").collect()]
