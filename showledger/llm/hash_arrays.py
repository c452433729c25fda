"""Sorted hash arrays in files of the shared folder, memory-mapped by the tasks that look them up.

A file holds named one-dimensional arrays one after the other, each at a multiple of 64 bytes, behind a short header. Tasks
write a file under a name of their own and rename it, so a repeated or doubled task leaves one whole file. Where the
shared folder is a path that the workers mount (`file:` or none), files are mapped and only the pages that a lookup
touches are read; on other file systems the file is read into memory by Arrow.
"""

from __future__ import annotations

import json
import os
import re
import uuid

import numpy as np
import pyarrow.fs as fs

ALIGN = 64


def _local(path: str) -> str | None:
    """The path as the operating system knows it, None for other file systems."""
    found = re.fullmatch(r"(?:file:(?://)?)?(/.*)", path)
    return found[1] if found else None


def _padded(n: int) -> int:
    return -(-n // ALIGN) * ALIGN


def write(path: str, arrays: dict[str, np.ndarray]) -> None:
    """Write `arrays` to one file, whole or not at all."""
    head = json.dumps([(name, a.dtype.str, len(a)) for name, a in arrays.items()]).encode()
    parts = [len(head).to_bytes(8, "little") + head]
    parts[0] += b"\0" * (_padded(len(parts[0])) - len(parts[0]))
    local, mark = _local(path), f".{uuid.uuid4().hex}"
    if local:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        system, target = fs.LocalFileSystem(), local
    else:
        system, target = fs.FileSystem.from_uri(path)
    with system.open_output_stream(target + mark) as out:
        out.write(parts[0])
        for a in arrays.values():
            raw = np.ascontiguousarray(a)
            out.write(raw.data)
            out.write(b"\0" * (_padded(raw.nbytes) - raw.nbytes))
    system.move(target + mark, target)


def load(path: str, missing: bool = False) -> dict[str, np.ndarray] | None:
    """The arrays of a file, mapped where the file system allows it; None for a file that isn't there, if that is allowed."""
    local = _local(path)
    if local:
        if missing and not os.path.exists(local):
            return None
        raw = np.memmap(local, np.uint8, "r")
    else:
        system, target = fs.FileSystem.from_uri(path)
        if missing and system.get_file_info(target).type == fs.FileType.NotFound:
            return None
        with system.open_input_stream(target) as held:
            raw = np.frombuffer(held.read(), np.uint8)
    size = int(raw[:8].view("<u8")[0])
    at, out = _padded(8 + size), {}
    for name, kind, n in json.loads(bytes(raw[8 : 8 + size])):
        wide = np.dtype(kind).itemsize * n
        out[name] = raw[at : at + wide].view(kind)
        at += _padded(wide)
    return out


def find(values: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, found) of each value in a sorted array; places of values that aren't there mean nothing."""
    order = np.argsort(values)  # ascending lookups read each page once
    at = np.empty(len(values), np.int64)
    at[order] = np.searchsorted(among, values[order])
    at[at == len(among)] = 0
    return at, (among[at] == values if len(among) else np.zeros(len(values), bool))
