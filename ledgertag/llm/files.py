"""Binary files in the shared folder, written and read from tasks."""

from __future__ import annotations

import uuid

from pyarrow import fs


def located(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and the path on it; a bare path is a path on a mounted disk."""
    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = "file://" + folder.removeprefix("file:")
    return fs.FileSystem.from_uri(folder)


class Published:
    """A file that appears under its name only when it is complete.

    A task that is tried again, or twice at once, writes the same bytes under another name first.
    """

    def __init__(self, folder: str, name: str) -> None:
        self.system, path = located(folder)
        self.system.create_dir(path, recursive=True)
        self.path = f"{path}/{name}"
        self.draft = f"{path}/_{uuid.uuid4().hex}"
        self.stream = self.system.open_output_stream(self.draft)

    def write(self, data: bytes) -> None:
        self.stream.write(data)

    def close(self) -> None:
        self.stream.close()
        self.system.move(self.draft, self.path)
