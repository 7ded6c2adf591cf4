"""Reading ZIP packages by ranges: central directory, ZIP64 records, places of stored members.

Nothing is extracted. A package is known by its size and a function that reads
a range of it, so a file on any file system will do.
"""

from __future__ import annotations

import struct
from collections.abc import Callable
from dataclasses import dataclass

# Fixed values of the ZIP format.
END, END64, LOCATOR, CENTRAL, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
END_SIZE, END64_SIZE, LOCATOR_SIZE, CENTRAL_SIZE, LOCAL_SIZE, LONGEST_COMMENT = 22, 56, 20, 46, 30, 0xFFFF
STORED, ENCRYPTED, ZIP64_EXTRA, UTF8_NAME = 0, 1, 1, 1 << 11
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF

Read = Callable[[int, int], bytes]


class DamagedPackage(ValueError):
    """The bytes are not a package that can be read."""


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    flags: int
    size: int
    header: int

    def place(self, read: Read) -> int:
        """Where the member's bytes begin; only a stored, plain member can be read by ranges."""
        if self.method != STORED or self.flags & ENCRYPTED:
            raise DamagedPackage(f"{self.name} is not stored as it is")
        head = read(self.header, LOCAL_SIZE)
        if len(head) < LOCAL_SIZE or head[:4] != LOCAL:
            raise DamagedPackage(f"no header of {self.name}")
        name, extra = struct.unpack_from("<HH", head, 26)
        return self.header + LOCAL_SIZE + name + extra


def _directory_place(read: Read, size: int) -> tuple[int, int, int]:
    """Members, length and start of the central directory."""
    base = max(0, size - END_SIZE - LONGEST_COMMENT)
    tail = read(base, size - base)
    at = tail.rfind(END)
    # The mark may also stand in the comment: the true one's comment ends with the file.
    while at >= 0 and (len(tail) < at + END_SIZE or at + END_SIZE + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise DamagedPackage("no end of central directory")
    members, length, start = struct.unpack_from("<HII", tail, at + 10)
    if members != FULL16 and length != FULL32 and start != FULL32:
        return members, length, start
    end = base + at
    locator = read(end - LOCATOR_SIZE, LOCATOR_SIZE) if end >= LOCATOR_SIZE else b""
    if locator[:4] != LOCATOR:
        return members, length, start  # full by chance, or a package without the larger fields
    record = read(struct.unpack_from("<Q", locator, 8)[0], END64_SIZE)
    if record[:4] != END64 or len(record) < END64_SIZE:
        raise DamagedPackage("no ZIP64 end of central directory")
    return struct.unpack_from("<QQQ", record, 32)


def _large(extra: bytes, wanted: list[bool]) -> list[int]:
    """The 64-bit fields of the ZIP64 extra field, in order, for the full 32-bit ones."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == ZIP64_EXTRA:
            if length < 8 * sum(wanted):
                break
            found = iter(struct.unpack_from(f"<{sum(wanted)}Q", extra, at + 4))
            return [next(found) if w else 0 for w in wanted]
        at += 4 + length
    raise DamagedPackage("no ZIP64 sizes")


def members(read: Read, size: int) -> list[Member]:
    """All members of a package, in the directory's order."""
    count, length, start = _directory_place(read, size)
    directory, at, found = read(start, length), 0, []
    for _ in range(count):
        if directory[at : at + 4] != CENTRAL or len(directory) < at + CENTRAL_SIZE:
            raise DamagedPackage("broken central directory")
        flags, method = struct.unpack_from("<HH", directory, at + 8)
        fields = list(struct.unpack_from("<II", directory, at + 20))  # packed size, true size
        name, extra, comment = struct.unpack_from("<HHH", directory, at + 28)
        header = struct.unpack_from("<I", directory, at + 42)[0]
        names = at + CENTRAL_SIZE
        label = directory[names : names + name].decode("utf-8" if flags & UTF8_NAME else "cp437")
        # The extra field has the true size first.
        small = [fields[1], fields[0], header]
        if FULL32 in small:
            large = _large(directory[names + name : names + name + extra], [x == FULL32 for x in small])
            small = [b if a == FULL32 else a for a, b in zip(small, large)]
        found.append(Member(label, method, flags, small[1], small[2]))
        at = names + name + extra + comment
    return found
