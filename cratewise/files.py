"""Small files and folders on any file system that Spark's paths name."""

from __future__ import annotations

import os
import uuid

from pyarrow import fs


def located(path: str) -> tuple[fs.FileSystem, str]:
    """File system and its own path of a path as Spark writes it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    elif path.startswith(("s3a://", "s3n://")):
        path = "s3" + path[3:]
    elif "://" not in path:
        path = os.path.abspath(path)
    return fs.FileSystem.from_uri(path)


def names(folder: str) -> list[str]:
    """Names right below a folder, sorted; none if it does not exist."""
    system, path = located(folder)
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(info.base_name for info in found)


def read_text(path: str) -> str:
    system, own = located(path)
    with system.open_input_stream(own) as file:
        return file.read().decode()


def write_new(path: str, text: str) -> None:
    """Write a file that did not exist, in one step: under another name first, then renamed."""
    system, own = located(path)
    folder, _, name = own.rpartition("/")
    system.create_dir(folder, recursive=True)
    draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as file:
        file.write(text.encode())
    if system.get_file_info(own).type != fs.FileType.NotFound:
        system.delete_file(draft)
        raise FileExistsError(path)
    system.move(draft, own)


def delete_tree(path: str) -> None:
    """Remove a folder, if it is there."""
    system, own = located(path)
    if system.get_file_info(own).type == fs.FileType.Directory:
        system.delete_dir(own)
