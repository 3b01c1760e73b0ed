"""Files that tasks write to and read from the shared folder."""

from __future__ import annotations

from uuid import uuid4

from pyarrow import fs
from pyspark.sql import SparkSession

from panelkit.sources.storage import arrow_address
from panelkit.sources.tables import checkpoint_dir


def new_folder(spark: SparkSession, kind: str) -> str:
    """Address of a new folder under the shared one; it appears with the first file."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid4().hex}"


def opened(address: str) -> tuple[fs.FileSystem, str]:
    """File system and path of an address: a local path, or a URI that Hadoop or Arrow knows."""
    return fs.FileSystem.from_uri(arrow_address(address))


def new_file(folder: str, suffix: str) -> tuple[fs.FileSystem, str, str]:
    """A name no other attempt of the task uses, so that a lost or repeated attempt harms nothing.

    Only files in the list that successful tasks return are ever read.
    """
    address = f"{folder}/{uuid4().hex}{suffix}"
    system, path = opened(address)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return system, path, address
