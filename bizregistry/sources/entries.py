"""Entry points of deflated archive members, so that slices need not inflate what precedes them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .archives import _file_opener, _glob_regex, _spread, list_members

EVERY_BYTES = 64 << 20
_KINDS = (
    "archive string, position int, size bigint, crc bigint,"
    " entry bigint, bit bigint, window binary, breaks bigint, seen boolean"
)


def index_members(
    archives: DataFrame,
    *,
    member: str = "*",
    every: int = EVERY_BYTES,
    partitions: int | None = None,
    on_bad: str = "raise",
) -> DataFrame:
    """Entry points of the members whose file name matches the glob ``member``.

    Columns: ``archive, position, size, crc, entry, bit, window, breaks, seen``. ``entry`` is an
    offset in the text of the member, ``bit`` the place in the deflate stream where the block that
    begins there does, ``window`` the 32 KiB of text before it. ``breaks`` lines have ended before,
    and ``seen`` tells whether there was a record among them. Each point is the first block that
    begins ``every`` bytes or more after the one before.

    Write the result to a table once, next to the archives, and hand it to ``expand_archives`` or
    ``read_archived_delimited`` as ``entries``. ``size`` and ``crc`` tie a point to the content it was
    made for, so a table made before a member changed is left aside for that member.

    A member is inflated once, in one task and in bounded memory; its size and CRC are verified, and
    one that fails raises an error that names it. Members have no points where they are not
    deflated, are shorter than ``every`` or hold blocks that are stored as they are, which do not begin
    at any bit.
    """
    members = list_members(archives, partitions=partitions, on_bad=on_bad)
    members = members.filter(F.col("member").rlike(_glob_regex(member))).filter(F.col("size") > every)
    # Members, not archives, are dealt out.
    return _spread(members, partitions).mapInArrow(_indexer(every), _KINDS)


def _indexer(every: int):
    open_file = _file_opener()
    find_blocks = _block_finder()
    blank = bytes(range(33))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zipfile
        import zlib

        import pyarrow as pa

        kinds = {
            "archive": pa.string(), "position": pa.int32(), "size": pa.int64(), "crc": pa.int64(),
            "entry": pa.int64(), "bit": pa.int64(), "window": pa.binary(),
            "breaks": pa.int64(), "seen": pa.bool_(),
        }

        def points(raw, info) -> list[dict]:
            raw.seek(info.header_offset + 26)
            sizes = raw.read(4)
            at = info.header_offset + 30 + sum(sizes[0::2]) + 256 * sum(sizes[1::2])
            found, offset, crc, last, breaks, seen, plain = [], 0, 0, 0, 0, False, True
            tail = b""
            for bit, window, text in find_blocks(raw, at, at + info.compress_size):
                plain = plain and text is not None
                if not plain:
                    break
                if offset - last >= every and text:
                    # A break of two bytes that the point divides counts where it ends.
                    half = tail == b"\r" and text[:1] == b"\n"
                    found.append(
                        {"entry": offset, "bit": bit, "window": window,
                         "breaks": breaks - half, "seen": seen}
                    )
                    last = offset
                joined = tail + text
                whole = joined.count(b"\n") + joined.count(b"\r") - joined.count(b"\r\n")
                breaks += whole - (tail in (b"\r", b"\n"))
                seen = seen or bool(text.strip(blank))
                offset, crc, tail = offset + len(text), zlib.crc32(text, crc), text[-1:] or tail
            if plain and (offset != info.file_size or crc != info.CRC):
                raise ValueError("size or CRC differ")
            return found if plain else []

        for batch in batches:
            for row in batch.to_pylist():
                path, name = row["archive"], row["member"]
                with open_file(path) as raw, zipfile.ZipFile(raw) as archive:
                    info = archive.infolist()[row["position"]]
                    if info.compress_type != zipfile.ZIP_DEFLATED:
                        continue
                    try:
                        found = points(raw, info)
                    except ValueError as broken:
                        raise ValueError(f"broken member {path}/{name}: {broken}") from broken
                own = {c: row[c] for c in ("archive", "position", "size", "crc")}
                listed = [own | point for point in found]
                columns = [pa.array([p[c] for p in listed], k) for c, k in kinds.items()]
                yield pa.RecordBatch.from_arrays(columns, list(kinds))

    return index


def _block_finder():
    """Blocks of a deflate stream, one by one.

    The inflater tells where a stream ends, not where a block does. So each block is inflated as if
    it were the last, from its first bit on; it ends within the last byte that this takes. Of the eight
    bits at which the next block may begin, those are tried where a block can be inflated. If there
    are several, the last bit that the block depends on is the end.
    """

    def find_blocks(raw, start: int, end: int) -> Iterator[tuple[int, bytes, bytes | None]]:
        """(first bit, text before, text) of each block; no text for one that is stored as it is."""
        import zlib

        import numpy as np

        def bits(bit: int, n: int) -> np.ndarray:
            """Up to ``n`` bytes from a bit on."""
            at = start + bit // 8
            raw.seek(at)
            data = np.frombuffer(raw.read(max(0, min(n + 1, end - at))), np.uint8)
            shift = bit % 8
            if not shift:
                return data[:n].copy()
            high = np.append(data[1:], np.uint8(0)) << (8 - shift)
            return ((data >> shift) | high)[:n]

        def inflated(data: np.ndarray, window: bytes) -> tuple[bytes, int] | None:
            """Text of the block at the beginning of the data, and the bytes it takes."""
            block = zlib.decompressobj(-15, zdict=window)
            # The first bit of a block says that it is the last.
            text = block.decompress(bytes([data[0] | 1]) + data[1:].tobytes())
            return (text, len(data) - len(block.unused_data)) if block.eof else None

        def whole_block(bit: int, window: bytes, size: int) -> tuple[np.ndarray, bytes, int]:
            left = end - start - bit // 8
            while True:
                data = bits(bit, size)
                if found := inflated(data, window):
                    return data, *found
                if size > left:
                    raise ValueError("the deflate stream ends too early")
                size *= 4

        def may_begin(bit: int, window: bytes, size: int) -> bool:
            data = bits(bit, size)
            if not len(data) or data[0] >> 1 & 3 == 3:
                return False
            if not data[0] >> 1 & 3:
                # A stored block goes on at the next byte, with its length and that inverted.
                length = bits((bit + 3 + 7) // 8 * 8, 4)
                return len(length) == 4 and bool((length[:2] ^ length[2:] == 255).all())
            try:
                inflated(data, window)
            except zlib.error:
                return False
            return True

        def last_bit(data: np.ndarray, used: int, window: bytes, text: bytes) -> int:
            for bit in range(7, -1, -1):
                other = data[:used].copy()
                other[-1] ^= 1 << bit
                try:
                    same = inflated(other, window) == (text, used)
                except zlib.error:
                    same = False
                if not same:
                    return bit
            return 0

        bit, window, size = 0, b"", 1 << 16
        while True:
            head = bits(bit, 1)
            if not len(head):
                raise ValueError("the deflate stream ends too early")
            if not head[0] >> 1 & 3:
                yield bit, window, None
                return
            try:
                data, text, used = whole_block(bit, window, size)
            except zlib.error as broken:
                raise ValueError(str(broken)) from broken
            yield bit, window, text
            before, window = window, (window + text)[-32768:]
            if data[0] & 1:
                return
            size = used + used // 2 + 4096
            ends = [bit + 8 * (used - 1) + k for k in range(1, 9)]
            places = [at for at in ends if may_begin(at, window, size)]
            if not places:
                raise ValueError("a block is followed by none")
            if len(places) == 1:
                bit = places[0]
            else:
                bit += 8 * (used - 1) + last_bit(data, used, before, text) + 1

    return find_blocks
