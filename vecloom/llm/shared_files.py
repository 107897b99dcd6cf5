"""Files that tasks write and read in a folder that all machines share.

Any URI that ``pyarrow.fs`` opens will do (file, hdfs, s3, gs). A task writes under a name of
its own attempt and reports it in a manifest row, so a file of a lost or repeated attempt is
never named and never read.
"""

from __future__ import annotations

import uuid
from typing import Any

from pyarrow import fs


def as_uri(path: str) -> str:
    if path.startswith("file:") and not path.startswith("file://"):
        return "file://" + path[5:]
    return path if "://" in path else f"file://{path}"


def opened(uri: str) -> tuple[Any, str]:
    return fs.FileSystem.from_uri(uri)


def new_file(folder: str, suffix: str) -> tuple[str, Any]:
    """URI and output stream of a new file."""
    system, path = opened(as_uri(folder))
    system.create_dir(path, recursive=True)
    name = f"{uuid.uuid4().hex}{suffix}"
    return f"{as_uri(folder)}/{name}", system.open_output_stream(f"{path}/{name}", compression=None)


def open_file(uri: str) -> Any:
    system, path = opened(uri)
    return system.open_input_file(path)


def open_stream(uri: str) -> Any:
    system, path = opened(uri)
    return system.open_input_stream(path, compression=None)
