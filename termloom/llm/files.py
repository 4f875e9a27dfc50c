"""Files that tasks write and read themselves, on whatever file system the URI names.

Names are never used twice, not even by a second attempt of a task; a file counts only once a table row of a
finished task names it, so what a lost attempt leaves behind is never read.
"""

from __future__ import annotations

import uuid

from pyarrow.fs import FileSystem, FileType


def new_file(folder: str, suffix: str) -> tuple[str, object]:
    """URI and output stream of a new file in ``folder``, which is made if need be."""
    uri = f"{folder}/{uuid.uuid4().hex}{suffix}"
    system, path = FileSystem.from_uri(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return uri, system.open_output_stream(path, compression=None)


def open_file(uri: str):
    """A stream that can seek."""
    system, path = FileSystem.from_uri(uri)
    if system.get_file_info(path).type != FileType.File:
        raise FileNotFoundError(uri)
    return system.open_input_file(path)
