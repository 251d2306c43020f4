"""Fill-in-the-middle examples from texts that are kept as seekable compressed frames.

``store_texts`` cuts a text into pieces of ``FRAME`` bytes and compresses each by itself (zstandard). Beside
the frames stand how many units, code points and bytes come before each, the totals last. A unit is a line with its
newline, or what follows the last newline.

``transform_stored`` draws two cuts between units. The counts name the frame of each cut, and only these frames are
decompressed. The transformed text is a row of frames again: markers, the stored frames that no cut
touches, as they are, and the parts of the cut ones. ``stream`` gives a text back frame by frame, and
``restored`` the original text from a transformed one and its form, again by seeking. So no step
holds more than a frame or two of a text as plain bytes, besides the row itself.

The form is ``psm`` (prefix, suffix, middle), ``spm`` (suffix, prefix, middle) or ``plain``: the text as it is, where it
is empty, contains a marker, or is not drawn to be changed. Draws depend on doc_id alone. A null text is
like an empty one, a null doc_id is written as nothing in the draw, and repeated rows give repeated results. A text without a newline is
one unit, so prefix or middle or suffix is all of it. Cuts may fall together; parts are empty then. An empty table gives
no rows. Bytes are not decoded, so nothing depends on what the code points are. Columns besides ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitmetrics.llm.rows import map_rows
from splitmetrics.sources.workspace import stage

#: Bytes of text in a frame.
FRAME = 1 << 16
LEVEL = 3
SEED = "7"
#: Shares in percent: of texts that are changed, and of these in the form spm.
RATE = 100
SPM_RATE = 50
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"

STORED = (
    "doc_id long, marked boolean, frames array<binary>, units array<long>, chars array<long>, bytes array<long>"
)
TRANSFORMED = (
    "doc_id long, n long, form string, prefix_chars long, middle_chars long, frames array<binary>, bytes array<long>"
)


def _n_chars(data: bytes) -> int:
    """Code points that begin in these bytes of UTF-8."""
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


def _running(counts: list[int]) -> list[int]:
    return list(accumulate(counts, initial=0))


@dataclass
class Frames:
    """A text as frames; ``units``, ``chars`` and ``sizes`` count what is before each frame, and all of it."""

    frames: list[bytes]
    sizes: list[int]
    units: list[int] = field(default_factory=lambda: [0])
    chars: list[int] = field(default_factory=lambda: [0])

    @classmethod
    def of(cls, data: bytes, frame: int, compress) -> Frames:
        pieces = [data[at : at + frame] for at in range(0, len(data), frame)]
        units = [piece.count(b"\n") for piece in pieces]
        if data and not data.endswith(b"\n"):
            units[-1] += 1
        return cls(
            [compress(piece) for piece in pieces],
            _running([len(piece) for piece in pieces]),
            _running(units),
            _running([_n_chars(piece) for piece in pieces]),
        )


class Selection:
    """Cuts and parts of one stored text; ``opened`` counts the frames that were decompressed."""

    def __init__(self, text: Frames, compress, decompress):
        self.text, self.compress, self.decompress = text, compress, decompress
        self._open: dict[int, bytes] = {}

    @property
    def opened(self) -> int:
        return len(self._open)

    def frame(self, k: int) -> bytes:
        if k not in self._open:
            self._open[k] = self.decompress(self.text.frames[k])
        return self._open[k]

    def cut(self, units: int) -> tuple[int, int, int]:
        """Frame and place in it right after so many units, and the code points before."""
        text = self.text
        if units == 0:
            return 0, 0, 0
        if units == text.units[-1]:
            return len(text.frames), 0, text.chars[-1]
        k = bisect_left(text.units, units) - 1
        ends = np.flatnonzero(np.frombuffer(self.frame(k), np.uint8) == 10)
        place = int(ends[units - text.units[k] - 1]) + 1
        return k, place, text.chars[k] + _n_chars(self.frame(k)[:place])

    def part(self, start: tuple, end: tuple) -> list[tuple[bytes, int]]:
        """Frames and their bytes between two cuts; frames without a cut are taken as they lie."""
        (first, begin, _), (last, stop, _) = start, end
        pieces = []
        if first == last:
            return [self._packed(self.frame(first)[begin:stop])] if stop > begin else []
        if begin:
            rest = self.frame(first)[begin:]
            pieces += [self._packed(rest)] if rest else []
            first += 1
        sizes = self.text.sizes
        pieces += [(self.text.frames[k], sizes[k + 1] - sizes[k]) for k in range(first, last)]
        if stop:
            pieces.append(self._packed(self.frame(last)[:stop]))
        return pieces

    def _packed(self, data: bytes) -> tuple[bytes, int]:
        return self.compress(data), len(data)


def draws(doc_id: int | None, seed: str = SEED) -> list[int]:
    """Four numbers below 2 ** 32 from the id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


def store_texts(documents: DataFrame, frame: int = FRAME) -> DataFrame:
    """Every text as frames with cumulative counts; ``marked`` tells whether it contains a marker."""

    def store(rows: Iterator[tuple]) -> Iterator[tuple]:
        compress = zstandard.ZstdCompressor(level=LEVEL).compress
        for doc_id, data in rows:
            data = data or b""
            text = Frames.of(data, frame, compress)
            marked = any(mark in data for mark in (PREFIX, SUFFIX, MIDDLE))
            yield doc_id, marked, text.frames, text.units, text.chars, text.sizes

    return map_rows(documents.select("doc_id", F.col("text").cast("binary")), store, STORED)


def transform_stored(
    stored: DataFrame, seed: str = SEED, rate: int = RATE, spm_rate: int = SPM_RATE
) -> DataFrame:
    """The transformed text of every stored one, as frames, with its form and the lengths of its parts."""

    def transform(rows: Iterator[tuple]) -> Iterator[tuple]:
        compress = zstandard.ZstdCompressor(level=LEVEL).compress
        decompress = zstandard.ZstdDecompressor().decompress
        marks = {mark: (compress(mark), len(mark)) for mark in (PREFIX, SUFFIX, MIDDLE)}
        for doc_id, marked, frames, units, chars, sizes in rows:
            n = units[-1]
            h1, h2, h3, h4 = draws(doc_id, seed)
            if not n or marked or h3 % 100 >= rate:
                yield doc_id, n, "plain", None, None, frames, sizes
                continue
            chosen = Selection(Frames(frames, sizes, units, chars), compress, decompress)
            first, second = (chosen.cut(at) for at in sorted((h1 % (n + 1), h2 % (n + 1))))
            prefix = [marks[PREFIX], *chosen.part((0, 0, 0), first)]
            middle = [marks[MIDDLE], *chosen.part(first, second)]
            suffix = [marks[SUFFIX], *chosen.part(second, (len(frames), 0, 0))]
            form = "spm" if h4 % 100 < spm_rate else "psm"
            out = [*suffix, *prefix, *middle] if form == "spm" else [*prefix, *suffix, *middle]
            lengths = _running([size for _, size in out])
            yield doc_id, n, form, first[2], second[2] - first[2], [data for data, _ in out], lengths

    return map_rows(stored, transform, TRANSFORMED)


def fill_in_middle(
    documents: DataFrame,
    frame: int = FRAME,
    seed: str = SEED,
    rate: int = RATE,
    spm_rate: int = SPM_RATE,
) -> DataFrame:
    """The transformed text of every document, as frames (``TRANSFORMED``).

    The frames of the texts are written to the shared folder once and read back.
    """
    return transform_stored(stage(store_texts(documents, frame), "text_frames"), seed, rate, spm_rate)


def stream(frames: list[bytes], sizes: list[int], start: int, end: int, decompress) -> Iterator[bytes]:
    """The bytes from start to end of a text, a frame at a time; others are not decompressed."""
    k = bisect_right(sizes, start) - 1
    while start < end:
        stop = min(end, sizes[k + 1])
        yield decompress(frames[k])[start - sizes[k] : stop - sizes[k]]
        start, k = stop, k + 1


def _markers(frames: list[bytes], sizes: list[int], wanted: tuple[bytes, ...], decompress) -> list[int]:
    """Where the markers first stand, one after the other."""
    found, held, at = [], b"", 0
    for piece in stream(frames, sizes, 0, sizes[-1], decompress):
        held += piece
        while len(found) < len(wanted) and (place := held.find(wanted[len(found)])) >= 0:
            found.append(at + place)
            at, held = at + place + len(PREFIX), held[place + len(PREFIX) :]
        keep = min(len(held), len(PREFIX) - 1)
        at, held = at + len(held) - keep, held[len(held) - keep :]
    return found


def restored(frames: list[bytes], sizes: list[int], form: str, decompress) -> Iterator[bytes]:
    """The original text, from a transformed one and its form alone.

    A text with a marker in it is plain, so the first of each kind is the one that was put in.
    """
    if form == "plain":
        yield from stream(frames, sizes, 0, sizes[-1], decompress)
        return
    order = (SUFFIX, PREFIX, MIDDLE) if form == "spm" else (PREFIX, SUFFIX, MIDDLE)
    places = _markers(frames, sizes, order, decompress)
    parts = dict(zip(order, zip(places, [*places[1:], sizes[-1]], strict=True), strict=True))
    for mark in (PREFIX, MIDDLE, SUFFIX):
        start, end = parts[mark]
        yield from stream(frames, sizes, start + len(mark), end, decompress)


def _digest(pieces: Iterator[bytes]) -> str:
    digest = hashlib.sha256()
    for piece in pieces:
        digest.update(piece)
    return digest.hexdigest()


def digests(transformed: DataFrame) -> DataFrame:
    """Every transformed text's figures, its SHA-256 digest and that of the text restored from it."""

    def compute(rows: Iterator[tuple]) -> Iterator[tuple]:
        decompress = zstandard.ZstdDecompressor().decompress
        for doc_id, n, form, prefix, middle, frames, sizes in rows:
            output = _digest(stream(frames, sizes, 0, sizes[-1], decompress))
            original = _digest(restored(frames, sizes, form, decompress))
            yield doc_id, n, form, prefix, middle, output, original

    schema = (
        "doc_id long, n long, form string, prefix_chars long, middle_chars long,"
        " output_sha256 string, restored_sha256 string"
    )
    return map_rows(transformed, compute, schema)


def texts(transformed: DataFrame) -> DataFrame:
    """doc_id, form and ``text`` of every transformed text, in one piece."""

    def join(rows: Iterator[tuple]) -> Iterator[tuple]:
        decompress = zstandard.ZstdDecompressor().decompress
        for doc_id, form, frames, sizes in rows:
            yield doc_id, form, b"".join(stream(frames, sizes, 0, sizes[-1], decompress))

    found = map_rows(transformed.select("doc_id", "form", "frames", "bytes"), join, "doc_id long, form string, text binary")
    return found.select("doc_id", "form", F.col("text").cast("string"))
