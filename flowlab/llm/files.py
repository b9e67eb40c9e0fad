"""Files that tasks write to and read from the shared store, through the store's own address.

A task writes under a name no other attempt uses and returns a line of the manifest. Only files named by the
manifest, which is committed as a table, are ever read, so a lost or repeated task leaves nothing behind that counts.
"""

from __future__ import annotations

import uuid
from typing import BinaryIO

from pyarrow import fs
from pyspark.sql import DataFrame

MAX_TASKS = 20_000


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


def create(folder: str, suffix: str) -> tuple[str, BinaryIO]:
    """A new file in ``folder``: its address and the stream to write to."""
    store, place = opened(folder)
    store.create_dir(place, recursive=True)
    name = f"{uuid.uuid4().hex}{suffix}"
    return f"{folder.rstrip('/')}/{name}", store.open_output_stream(f"{place.rstrip('/')}/{name}", compression=None)


def reader(path: str):
    """A seekable stream of the bytes as they are stored."""
    store, place = opened(path)
    return store.open_input_file(place)


def spread(manifest: DataFrame) -> DataFrame:
    """The lines of a manifest over as many tasks as there are files: few small rows that each stand for much work."""
    return manifest.repartition(max(1, min(manifest.count(), MAX_TASKS)))
