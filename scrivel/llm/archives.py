"""Members of ZIP files, read in place.

A file's end names its central directory, in the wide form (ZIP64) where numbers outgrow the plain one. Stored members lie in the file
byte for byte, so any part of one is a range of the file, and nothing is extracted.
"""

from __future__ import annotations

import io
import struct
from dataclasses import dataclass

import pyarrow as pa

# Signatures and record forms of the format.
_END, _END_FORM = b"PK\5\6", "<4s4H2LH"
_END64, _END64_FORM = b"PK\6\6", "<4sQ2H2L4Q"
_LOCATOR, _LOCATOR_FORM = b"PK\6\7", "<4sLQL"
_ENTRY, _ENTRY_FORM = b"PK\1\2", "<4s6H3L5H2L"
_LOCAL, _LOCAL_FORM = b"PK\3\4", "<4s5H3L2H"
_MOST_COMMENT, _FULL16, _FULL32 = 0xFFFF, 0xFFFF, 0xFFFFFFFF
_WIDE_FIELDS, _UTF8, _ENCRYPTED, _STORED = 1, 0x800, 1, 0
_size = struct.calcsize


class BrokenArchive(ValueError):
    """The file is not a ZIP file, or its directory does not add up."""


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    flags: int
    header: int  # where its local header begins in the file
    packed: int
    size: int


def _form(form: str, data: bytes, at: int, signature: bytes) -> tuple:
    if at < 0 or at + _size(form) > len(data) or data[at : at + 4] != signature:
        raise BrokenArchive(f"no {signature!r} at its place")
    return struct.unpack_from(form, data, at)


def _end_of(tail: bytes) -> int:
    """Where the end record begins in the last bytes of a file; its comment reaches to the end exactly."""
    at = len(tail)
    while (at := tail.rfind(_END, 0, at)) >= 0:
        if at + _size(_END_FORM) <= len(tail) and at + _size(_END_FORM) + struct.unpack_from(_END_FORM, tail, at)[-1] == len(tail):
            return at
    raise BrokenArchive("no end of central directory")


def _wide(extra: bytes, values: list[int]) -> list[int]:
    """Sizes and place of a member; those that are full in the plain form follow in the wide field, in their order."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<2H", extra, at)
        if kind == _WIDE_FIELDS:
            given = iter(struct.unpack_from(f"<{min(size, len(extra) - at - 4) // 8}Q", extra, at + 4))
            values = [next(given, v) if v == _FULL32 else v for v in values]
        at += 4 + size
    return values


class ZipReader:
    """The directory of a ZIP file and ranges of its members. ``file`` is a random access file of Arrow."""

    def __init__(self, file: pa.NativeFile):
        self.file, size = file, file.size()
        tail_at = max(0, size - _size(_END_FORM) - _MOST_COMMENT - _size(_LOCATOR_FORM) - _size(_END64_FORM))
        tail = file.read_at(size - tail_at, tail_at)
        at = _end_of(tail)
        *_, disk, first_disk, _, n, length, start, _ = struct.unpack_from(_END_FORM, tail, at)
        directory_end = tail_at + at
        if _FULL16 in (n, disk, first_disk) or _FULL32 in (length, start):
            *_, wide_at, _ = _form(_LOCATOR_FORM, tail, at - _size(_LOCATOR_FORM), _LOCATOR)
            before = tail_at + at - _size(_LOCATOR_FORM) - _size(_END64_FORM)
            for place in (wide_at, before):  # the second one if the archive stands behind other bytes
                record = file.read_at(_size(_END64_FORM), place) if 0 <= place <= size else b""
                if record[:4] == _END64:
                    break
            *_, disk, first_disk, _, n, length, start = _form(_END64_FORM, record, 0, _END64)
            directory_end = place
        if disk or first_disk:
            raise BrokenArchive("the archive is split over several files")
        self.shift = directory_end - length - start
        if self.shift < 0:
            raise BrokenArchive("the central directory does not fit the file")
        self.members = self._directory(file.read_at(length, self.shift + start), n)

    def _directory(self, data: bytes, n: int) -> dict[str, Member]:
        members, at = {}, 0
        for _ in range(n):
            entry = _form(_ENTRY_FORM, data, at, _ENTRY)
            flags, method, packed, size = entry[3], entry[4], entry[8], entry[9]
            name_size, extra_size, comment_size, header = entry[10], entry[11], entry[12], entry[16]
            at += _size(_ENTRY_FORM)
            name, extra = data[at : at + name_size], data[at + name_size : at + name_size + extra_size]
            size, packed, header = _wide(extra, [size, packed, header])
            text = name.decode("utf-8" if flags & _UTF8 else "cp437")
            members[text] = Member(text, method, flags, header + self.shift, packed, size)
            at += name_size + extra_size + comment_size
        return members

    def place(self, name: str) -> tuple[int, int]:
        """Where in the file a stored member's bytes begin, and how many there are."""
        member = self.members[name]
        if member.method != _STORED or member.flags & _ENCRYPTED:
            raise BrokenArchive(f"{name} is packed, so it has no ranges")
        local = _form(_LOCAL_FORM, self.file.read_at(_size(_LOCAL_FORM), member.header), 0, _LOCAL)
        return member.header + _size(_LOCAL_FORM) + local[-2] + local[-1], member.size


class Span(io.RawIOBase):
    """A range of a file as a stream of its own."""

    def __init__(self, file: pa.NativeFile, offset: int, length: int):
        self.file, self.at, self.end = file, offset, offset + length

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        data = self.file.read_at(min(len(into), self.end - self.at), self.at)
        into[: len(data)] = data
        self.at += len(data)
        return len(data)
