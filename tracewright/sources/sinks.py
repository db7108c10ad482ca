"""Files of a collection written, copied, moved and removed by tasks: a row is a file or a tree, never a driver loop.

Every action may be repeated, as tasks are when an executor is lost: writing and copying
replace the whole file, and a tree that is already where it should go is left there.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path on it."""
    if re.match(r"^[a-z][a-z0-9+.-]*:", path) and not path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)


def _done(rows: DataFrame, act: Callable[..., None]) -> int:
    """``act`` on the columns of each row; the number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                act(*row)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    return sum(r["n"] for r in rows.mapInArrow(run, "n long").collect())  # a number a batch


def _parent(system: fs.FileSystem, path: str) -> None:
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)


def write_texts(rows: DataFrame) -> int:
    """rows (path, text), each a whole file; readers see the old file or the new one."""

    def act(path: str, text: str) -> None:
        system, at = filesystem(path)
        _parent(system, at)
        with system.open_output_stream(f"{at}.new") as out:
            out.write(text.encode())
        system.move(f"{at}.new", at)

    return _done(rows.select("path", "text"), act)


def copy_files(rows: DataFrame, link: bool = False) -> int:
    """rows (source, target). With ``link``, a hard link where both are on one local file system."""

    def act(source: str, target: str) -> None:
        (system, here), (other, there) = filesystem(source), filesystem(target)
        _parent(other, there)
        if link and isinstance(system, fs.LocalFileSystem) and isinstance(other, fs.LocalFileSystem):
            try:
                if os.path.exists(there):
                    os.remove(there)
                os.link(here, there)
                return
            except OSError:  # another device: copy
                pass
        fs.copy_files(here, there, source_filesystem=system, destination_filesystem=other)

    return _done(rows.select("source", "target"), act)


def move_trees(rows: DataFrame) -> int:
    """rows (source, target): each tree takes its place by a rename, an older one goes first."""

    def act(source: str, target: str) -> None:
        (system, here), (_, there) = filesystem(source), filesystem(target)
        if system.get_file_info(here).type == fs.FileType.NotFound:
            return  # moved by an earlier attempt
        if system.get_file_info(there).type == fs.FileType.Directory:
            system.delete_dir(there)
        elif system.get_file_info(there).type == fs.FileType.File:
            system.delete_file(there)
        _parent(system, there)
        system.move(here, there)

    return _done(rows.select("source", "target"), act)


def drop_tree(path: str) -> None:
    system, at = filesystem(path)
    if system.get_file_info(at).type == fs.FileType.Directory:
        system.delete_dir(at)
