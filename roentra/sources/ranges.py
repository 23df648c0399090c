"""Reading a file's first bytes in the task, and more only where the parser asks for it."""

from __future__ import annotations

import io
from typing import Protocol

import pyarrow.fs

# Bytes of one request: a header and its tags fit, and a store answers it in one piece.
BLOCK = 64 * 1024


class RandomAccess(Protocol):
    """What ``RangeReader`` needs of a file: pyarrow's input files have it."""

    def size(self) -> int: ...

    def read_at(self, nbytes: int, offset: int) -> bytes: ...


def open_path(path: str) -> RandomAccess:
    """The file at a URI of a store that pyarrow reaches; other stores bring their own opener."""
    scheme, colon, rest = path.partition(":")
    if colon and rest.startswith("/") and not rest.startswith("//"):
        path = f"{scheme}://{rest}"
    if not colon:
        return pyarrow.fs.LocalFileSystem().open_input_file(path)
    store, place = pyarrow.fs.FileSystem.from_uri(path)
    return store.open_input_file(place)


class RangeReader(io.RawIOBase):
    """A file as a parser takes it, fetched block by block; ``fetched`` counts the bytes.

    Blocks that were fetched stay, so going back costs nothing.
    """

    def __init__(self, source: RandomAccess, block: int = BLOCK):
        self.source, self.block, self.length = source, block, source.size()
        self.blocks: dict[int, bytes] = {}
        self.at = self.fetched = 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.at

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        start = {io.SEEK_SET: 0, io.SEEK_CUR: self.at, io.SEEK_END: self.length}[whence]
        self.at = max(0, start + offset)
        return self.at

    def _block(self, number: int) -> bytes:
        if number not in self.blocks:
            data = self.source.read_at(self.block, number * self.block)
            self.fetched += len(data)
            self.blocks[number] = bytes(data)
        return self.blocks[number]

    def read(self, size: int = -1) -> bytes:
        end = self.length if size is None or size < 0 else min(self.length, self.at + size)
        parts = []
        while self.at < end:
            number, inside = divmod(self.at, self.block)
            part = self._block(number)[inside : inside + end - self.at]
            if not part:
                break  # shorter than listed
            parts.append(part)
            self.at += len(part)
        return b"".join(parts)

    def readinto(self, buffer) -> int:
        data = self.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)
