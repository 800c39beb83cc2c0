"""Where the members of a gzip text begin, found by many tasks at once.

A range of bytes is searched for the mark of a member. A mark counts if the member behind it unpacks to its
end, checksum included, and another one or the end of the text follows, and so on to the end of the
range; other marks are passed over. That may still be a text packed within a packed text, so ranges are not
trusted alone: ``Chain`` takes them in order and accepts one only where the one before it ends, which
the first, beginning at 0, makes certain. A range that does not fit is followed from there anew.
"""

from __future__ import annotations

import zlib

MARK = b"\x1f\x8b\x08"
READ = 1 << 20


def member_end(source, start: int) -> int | None:
    """Where the member that begins at ``start`` ends; none if it is no whole member."""
    source.seek(start)
    inflater, fed = zlib.decompressobj(zlib.MAX_WBITS | 16), 0
    data = source.read(READ)
    while data:
        fed += len(data)
        try:
            while data and not inflater.eof:
                inflater.decompress(data, READ)
                data = inflater.unconsumed_tail
        except zlib.error:
            return None
        if inflater.eof:
            return start + fed - len(inflater.unused_data)
        data = source.read(READ)
    return None


def next_member(source, end: int, size: int) -> int | None:
    """Where a member begins behind one that ends at ``end``, zero bytes passed over; ``size`` at the end of
    the text, none if something else follows."""
    source.seek(end)
    at = end
    while at < size:
        data = source.read(READ)
        if not data:
            return size
        rest = data.lstrip(b"\0")
        at += len(data) - len(rest)
        if rest:
            head = rest if len(rest) >= len(MARK) else rest + source.read(len(MARK))
            return at if head.startswith(MARK) else None
    return size


def follow(source, start: int, stop: int, size: int) -> tuple[int, int] | None:
    """From the member at ``start``: where the first one at or behind ``stop`` begins, and the last one
    before it; none if the members break off."""
    at = last = start
    while at < stop:
        last = at
        end = member_end(source, at)
        after = end and next_member(source, end, size)
        if after is None:
            return None
        at = after
    return at, last


def search(source, start: int, stop: int, size: int) -> tuple[int, int, int] | None:
    """The first member that begins in ``[start, stop)``, and what ``follow`` gives from there; none
    where there is none."""
    at = start
    while at < stop:
        source.seek(at)
        data = source.read(min(READ, stop - at) + len(MARK))
        found = data.find(MARK)
        if found < 0 or at + found >= stop:
            at += max(len(data) - len(MARK) + 1, 1)
            continue
        at += found
        # the upper bits of a member's flags are never set
        if not (data[found + 3 : found + 4] or b"\0")[0] & 0xE0:
            followed = follow(source, at, stop, size)
            if followed is not None:
                return at, *followed
        at += 1
    return None


class Chain:
    """The ranges of one text in order: gives the place in each where a member begins, as far as one does,
    with the member before it."""

    def __init__(self) -> None:
        self._next = self._last = 0

    def take(
        self, source, start: int, stop: int, size: int, found: tuple[int, int, int] | None
    ) -> tuple[int, int] | None:
        if self._next >= stop:
            return None
        entry, before = self._next, self._last
        if found is not None and found[0] == entry:
            self._next, self._last = found[1:]
        else:
            # what breaks off is read to its end, and reported, by the reader of this range
            self._next, self._last = follow(source, entry, stop, size) or (size, entry)
        return entry, before
