"""Binary files in the shared folder, written and read by executors."""
from __future__ import annotations

import uuid

import pyarrow.fs as pafs
from pyspark.sql import DataFrame


#: Names that Hadoop gives to stores which Arrow knows by another.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder or file; a path without scheme is local to a one-machine session."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    scheme, rest = uri.split("://", 1)
    return pafs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}://{rest}")


def new_file(fs: pafs.FileSystem, folder: str, stem: str, suffix: str) -> str:
    """A name that no other attempt of the same task uses; a written table says which files count."""
    fs.create_dir(folder, recursive=True)
    return f"{folder}/{stem}-{uuid.uuid4().hex}{suffix}"


def one_task_each(files: DataFrame, most: int = 20_000) -> DataFrame:
    """Deal a table of files round robin, a task for each up to ``most`` tasks."""
    return files.coalesce(1).repartition(max(1, min(most, files.count())))
