"""Opening files inside tasks: any file system Arrow knows, any codec."""

from __future__ import annotations

import bz2
import csv
import gzip
import hashlib
import io
import lzma
import os
import re
import zipfile
from collections.abc import Iterator

from pyarrow import fs

# Leading bytes of the supported codecs.
MAGIC = [(b"\x1f\x8b", "gzip"), (b"BZ", "bz2"), (b"\xfd7zXZ\x00", "xz")]

# Suffixes used when the leading bytes say nothing.
SUFFIXES = [(".gz", "gzip"), (".bz2", "bz2"), (".xz", "xz"), (".lzma", "xz")]

_OPENERS = {"gzip": gzip.open, "bz2": bz2.open, "xz": lzma.open}


# Names Spark has for schemes Arrow knows by another one.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def _locate(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    scheme, colon, rest = path.partition(":")
    return fs.FileSystem.from_uri(SCHEMES.get(scheme, scheme) + colon + rest)


def suffix_codec(path: str) -> str | None:
    lowered = path.lower()
    return next((codec for suffix, codec in SUFFIXES if lowered.endswith(suffix)), None)


def sniff_codec(head: bytes, path: str) -> str | None:
    """Codec by leading bytes, then by suffix."""
    for magic, codec in MAGIC:
        if head.startswith(magic):
            return codec
    return suffix_codec(path)


def open_input(path: str):
    """Seekable binary file object."""
    system, name = _locate(path)
    return system.open_input_file(name)


def exists(path: str) -> bool:
    system, name = _locate(path)
    return system.get_file_info(name).type != fs.FileType.NotFound


def files(path: str) -> list[str]:
    """Files below a folder, at any depth; none if there is no such folder."""
    system, name = _locate(path)
    found = system.get_file_info(fs.FileSelector(name, allow_not_found=True, recursive=True))
    start = path[: len(path) - len(name)] if path.endswith(name) else ""
    return sorted(start + f.path for f in found if f.type == fs.FileType.File)


def delete(path: str) -> None:
    """Delete a file or folder, if there is one."""
    system, name = _locate(path)
    kind = system.get_file_info(name).type
    if kind == fs.FileType.Directory:
        system.delete_dir(name)
    elif kind != fs.FileType.NotFound:
        system.delete_file(name)


def move(source: str, target: str) -> None:
    """Move a folder or file to a place where there is none; file by file where the store cannot rename folders."""
    system, name = _locate(source)
    goal = _locate(target)[1]
    system.create_dir(goal.rsplit("/", 1)[0], recursive=True)
    try:
        system.move(name, goal)
    except (NotImplementedError, OSError):
        if not isinstance(system, fs.S3FileSystem):
            raise
        for file in files(source):
            own = _locate(file)[1]
            system.copy_file(own, goal + own[len(name) :])
        delete(source)


def md5(path: str) -> str:
    """Hex digest of a file, read piece by piece."""
    with open_input(path) as raw:
        return hashlib.file_digest(raw, "md5").hexdigest()


def open_output(path: str):
    system, name = _locate(path)
    system.create_dir(name.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(name, compression=None)


def writes_in_place(path: str) -> bool:
    """Whether tasks can write to different places of one file."""
    return isinstance(_locate(path)[0], fs.LocalFileSystem)


def open_place(path: str, at: int):
    """Binary output that begins at byte ``at`` and leaves the rest of the file as it is."""
    system, name = _locate(path)
    system.create_dir(name.rsplit("/", 1)[0], recursive=True)
    file = os.fdopen(os.open(name, os.O_WRONLY | os.O_CREAT, 0o666), "wb")
    file.seek(at)
    return file


def open_decoded(path: str) -> tuple[io.BufferedIOBase, str | None]:
    """Decompressed byte stream of ``path`` or ``archive|member``, and its codec."""
    archive, bar, member = path.partition("|")
    raw = open_input(archive)
    if bar:
        inner = zipfile.ZipFile(raw).open(member)
        codec = sniff_codec(inner.peek(6)[:6], member)
        return (_OPENERS[codec](inner) if codec else inner), codec or "zip"
    head = raw.read(6)
    raw.seek(0)
    codec = sniff_codec(head, path)
    return (_OPENERS[codec](raw) if codec else io.BufferedReader(raw)), codec


def lines(path: str, encoding: str = "utf-8") -> Iterator[str]:
    """Text lines without their ends, decoded while streaming."""
    if encoding.lower() in ("utf-8", "utf8"):
        encoding = "utf-8-sig"  # a byte order mark is no data
    stream, _ = open_decoded(path)
    with io.TextIOWrapper(stream, encoding=encoding, newline=None) as text:
        for line in text:
            yield line.removesuffix("\n")


# A longer record raises: most likely a quote is missing.
RECORD_CHARS = 256 << 20


def records(physical: Iterator[str], quote: str, escape: str | None = None) -> Iterator[str]:
    """Join physical lines while a quoted cell is open.

    An escape character hides the one behind it; doubled quotes close and open again.
    A quote that is never closed raises, as does a record of more than ``RECORD_CHARS``.
    """
    marks = re.compile(f"{re.escape(escape)}.|{re.escape(quote)}" if escape and escape != quote else re.escape(quote), re.S)
    pending: list[str] = []
    opened, size, begun = False, 0, 1
    for number, line in enumerate(physical, 1):
        begun = begun if pending else number
        pending.append(line)
        size += len(line)
        if sum(mark == quote for mark in marks.findall(line)) % 2:
            opened = not opened
        if not opened:
            yield "\n".join(pending)
            pending, size = [], 0
        elif size > RECORD_CHARS:
            raise ValueError(f"The record that begins in line {begun} is longer than {RECORD_CHARS} characters")
    if pending:
        raise ValueError(f"A quote in the record that begins in line {begun} is never closed")


def csv_cells(line: str, delimiter: str = ",", quote: str | None = '"', escape: str | None = None) -> list[str]:
    style = {"quotechar": quote} if quote else {"quoting": csv.QUOTE_NONE}
    if escape:
        style["escapechar"] = escape
    return next(csv.reader(io.StringIO(line, newline=""), delimiter=delimiter, **style), [])
