"""Fill-in-the-middle: each text is cut into prefix, middle and suffix at line ends and put in another order.

A rolling hash cuts every text into chunks whose ends depend on the bytes near them only, so that texts
which share passages share chunks. What has to be known of a chunk, its boundary summary, is worked out
once and kept in a cache: lines, code points, where its lines end, and its first and last bytes. A cached
chunk is told by its hash and then compared byte by byte. Summaries combine from left to right: running
sums of the lines locate the chunk of a cut, the chunk's own line ends the place within it, and the bytes
on both sides of a chunk boundary tell whether a marker stands across it.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridscout.llm import words as W
from gridscout.llm.common import unique_texts

SEED = 7
MARKERS = ("<P>", "<S>", "<M>")
WINDOW = 16  # bytes that the rolling hash sees
CHUNK_BITS = 10  # a chunk ends at one place in 2 ** CHUNK_BITS
MOST_CHUNK = 1 << 14
CACHE_BYTES = 32 << 20  # chunks and summaries a task remembers
BATCH_BYTES = 8 << 20  # texts and outputs in one batch
_PLACES = np.random.default_rng(11).integers(0, 1 << 32, 256, dtype=np.uint32)


@dataclass(frozen=True)
class Summary:
    """Of one chunk. ends: byte places after its line ends; end_chars: the code points up to each."""

    n_bytes: int
    n_chars: int
    ends: np.ndarray
    end_chars: np.ndarray
    head: bytes
    tail: bytes
    marked: bool


def summarise(chunk: bytes, markers: tuple[bytes, ...]) -> Summary:
    data = np.frombuffer(chunk, np.uint8)
    begins = (data & 0xC0) != 0x80  # a code point's first byte
    ends = np.flatnonzero(data == 0x0A) + 1
    chars = np.cumsum(begins)
    edge = max(map(len, markers)) - 1
    return Summary(
        len(chunk),
        int(chars[-1]) if len(chunk) else 0,
        ends.astype(np.int32),
        chars[ends - 1].astype(np.int32),
        chunk[:edge],
        chunk[-edge:] if edge else b"",
        any(m in chunk for m in markers),
    )


class SummaryCache:
    """Summaries of the chunks seen last, by hash; a hit counts only if the bytes are the same."""

    def __init__(self, markers: tuple[bytes, ...], most_bytes: int = CACHE_BYTES):
        self.markers, self.most_bytes = markers, most_bytes
        self.kept: OrderedDict[int, tuple[bytes, Summary]] = OrderedDict()
        self.bytes = self.hits = self.misses = 0

    def get(self, chunk: bytes) -> Summary:
        key = xxhash.xxh3_64_intdigest(chunk)
        found = self.kept.get(key)
        if found is not None and found[0] == chunk:
            self.hits += 1
            self.kept.move_to_end(key)
            return found[1]
        self.misses += 1
        summary = summarise(chunk, self.markers)
        if found is None:  # another chunk of this hash stays
            self.kept[key] = (chunk, summary)
            self.bytes += self._size(chunk, summary)
            while self.bytes > self.most_bytes:
                self.bytes -= self._size(*self.kept.popitem(last=False)[1])
        return summary

    @staticmethod
    def _size(chunk: bytes, summary: Summary) -> int:
        return len(chunk) + 8 * len(summary.ends) + 600


def chunk_ends(data: np.ndarray, window: int = WINDOW, bits: int = CHUNK_BITS, most: int = MOST_CHUNK) -> np.ndarray:
    """Ends of the chunks of a text: where the hash of the last `window` bytes ends in `bits` zero bits,
    the end of the text, and further ends where a chunk would be longer than `most`. `window`: a power of 2."""
    hashes, width = _PLACES[data], 1
    while width < window:  # hashes[i]: of the `width` bytes from i on
        hashes = hashes[: max(len(hashes) - width, 0)] * np.uint32(pow(0x9E3779B1, width, 1 << 32)) + hashes[width:]
        width *= 2
    hashes = hashes * np.uint32(0x85EBCA6B)
    ends = np.flatnonzero(hashes >> np.uint32(32 - bits) == 0) + window
    if not len(ends) or ends[-1] != len(data):
        ends = np.append(ends, len(data))
    begins = np.concatenate([[0], ends[:-1]])
    if len(data) and (ends - begins).max() > most:
        ends = np.concatenate([np.append(np.arange(b + most, e, most), e) for b, e in zip(begins, ends, strict=True)])
    return ends


def draws(id_text: str, seed: int = SEED) -> tuple[int, ...]:
    """Four 32-bit numbers that depend on seed and id only."""
    digest = hashlib.sha256(f"{seed}:{id_text}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


class Text:
    """A text by the summaries of its chunks."""

    def __init__(self, data: np.ndarray, raw: bytes, cache: SummaryCache):
        self.ends = chunk_ends(data) if len(raw) else np.zeros(0, np.int64)
        begins = [0, *self.ends[:-1].tolist()]
        self.parts = [cache.get(raw[b:e]) for b, e in zip(begins, self.ends.tolist())]
        self.lines_before = np.concatenate([[0], np.cumsum([len(p.ends) for p in self.parts], dtype=np.int64)])
        self.chars_before = np.concatenate([[0], np.cumsum([p.n_chars for p in self.parts], dtype=np.int64)])
        self.n_bytes, self.n_chars = len(raw), int(self.chars_before[-1])
        open_end = bool(raw) and raw[-1:] != b"\n"
        self.n_lines = int(self.lines_before[-1]) + open_end
        self.marked = any(p.marked for p in self.parts)
        tail, edge = b"", max(map(len, cache.markers)) - 1
        for p in self.parts:  # a marker across one or more boundaries
            if self.marked:
                break
            seam = tail + p.head
            self.marked = any(m in seam for m in cache.markers)
            tail = ((tail if p.n_bytes < edge else b"") + p.tail)[-edge:] if edge else b""

    def after(self, lines: int) -> tuple[int, int]:
        """(bytes, code points) of the first `lines` lines."""
        if lines == 0:
            return 0, 0
        if lines > self.lines_before[-1]:  # the last line has no line end
            return self.n_bytes, self.n_chars
        k = int(np.searchsorted(self.lines_before, lines)) - 1
        part, at = self.parts[k], lines - int(self.lines_before[k]) - 1
        begin = int(self.ends[k - 1]) if k else 0
        return begin + int(part.ends[at]), int(self.chars_before[k]) + int(part.end_chars[at])


def check_markers(markers: tuple[str, str, str]) -> None:
    """Markers must be found again where they were put, whatever text stands around them."""
    inner = any(o[0] in m[1:] for m in markers if m for o in markers if o)
    prefix = any(i != j and b.startswith(a) for i, a in enumerate(markers) for j, b in enumerate(markers))
    if not all(markers) or inner or prefix:
        raise ValueError("no marker may be empty, begin another one, or hold the first character of any after its own first")


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rate: int = 100,
    spm_rate: int = 50,
    seed: int = SEED,
    markers: tuple[str, str, str] = MARKERS,
) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) per document.

    n: lines of the text, the last one with or without a line end. The two cuts are drawn from the n + 1
    places between lines by SHA-256 of seed and id, so a rerun gives the same rows. form: `rate` of 100
    texts are put in another order, and `spm_rate` of 100 of these as spm, <S>suffix<P>prefix<M>middle,
    the others as psm, <P>prefix<S>suffix<M>middle. plain: the text itself, also where it is empty or
    holds a marker; prefix_chars and middle_chars are null then. `restored` gives the text back.

    A null text is an empty one. Equal texts of different ids are cut in different places. A very long
    text is worked on alone; its task holds it, its output and the summaries of its chunks. Several rows
    of one id count as one, see `unique_texts`; rows without an id are left out. An empty table gives an
    empty table. Other columns of `docs` play no part, whatever they are called. No shuffle of texts.
    """
    check_markers(markers)
    rows = unique_texts(docs, id_col, text_col).select(
        F.col(id_col).alias("_id"), F.col(id_col).cast("string").alias("_name"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")
    )
    kind = rows.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    return rows.mapInArrow(_reordered(rate, spm_rate, seed, markers), schema).withColumnRenamed("_id", id_col)


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that `fill_in_middle` was given, from its output and form."""
    quoted = "|".join("\\Q" + m + "\\E" for m in markers)
    parts = F.split(output, quoted, -1)
    prefix, suffix = F.when(form == "psm", parts[1]).otherwise(parts[2]), F.when(form == "psm", parts[2]).otherwise(parts[1])
    return F.when(form == "plain", output).otherwise(F.concat(prefix, parts[3], suffix))


def _reordered(rate: int, spm_rate: int, seed: int, markers: tuple[str, str, str]):
    def run(batches):
        p, s, m = (x.encode() for x in markers)
        cache = SummaryCache((p, s, m))
        for batch in batches:
            ids, names = batch.column("_id"), batch.column("_name").to_pylist()
            for lo, hi, data, offsets in W.sliced(batch.column("_text"), BATCH_BYTES):
                out = []
                for i in range(hi - lo):
                    own = data[offsets[i] : offsets[i + 1]]
                    raw = own.tobytes()
                    text = Text(own, raw, cache)
                    h1, h2, h3, h4 = draws(names[lo + i], seed)
                    if not raw or text.marked or h3 % 100 >= rate:
                        out.append((text.n_lines, "plain", None, None, raw))
                        continue
                    first, last = sorted((h1 % (text.n_lines + 1), h2 % (text.n_lines + 1)))
                    (a, a_chars), (b, b_chars) = text.after(first), text.after(last)
                    spm = h4 % 100 < spm_rate
                    parts = (s, raw[b:], p, raw[:a], m, raw[a:b]) if spm else (p, raw[:a], s, raw[b:], m, raw[a:b])
                    out.append((text.n_lines, "spm" if spm else "psm", a_chars, b_chars - a_chars, b"".join(parts)))
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()), strict=True)]
                columns[-1] = columns[-1].cast(pa.string())
                yield pa.record_batch([ids.slice(lo, hi - lo), *columns], ["_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return run
