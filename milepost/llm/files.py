"""Binary files in the folder that all executors share."""

import posixpath

from pyarrow import fs
from pyspark import TaskContext


def open_folder(uri: str):
    """The file system of a URI or absolute path, and the path inside it."""
    return fs.FileSystem.from_uri(uri)


def write_whole(uri: str, name: str, write) -> str:
    """Write a file under `uri` through write(stream), so that it is there whole or not at all.

    A repeated or speculative attempt writes its own file first; the last one to
    finish stays, with the same content. Returns the file's path under its file system.
    """
    system, folder = open_folder(uri)
    system.create_dir(folder, recursive=True)
    context = TaskContext.get()
    attempt = f"{folder}/_{name}.{context.taskAttemptId() if context else 0}"
    with system.open_output_stream(attempt) as stream:
        write(stream)
    target = posixpath.join(folder, name)
    system.move(attempt, target)
    return target
