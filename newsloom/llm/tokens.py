"""Token counts and token ids of whole texts, as the public tokenizers give them.

A text longer than a chunk is encoded in overlapping chunks with offsets. Neighbouring chunks are spliced where both
have a token start at a *stable* boundary: a place where the pre-tokenizer must begin a new piece whatever stands
before it, which the kinds of the two characters around it prove (letter, number, other sign, white space; only
characters whose kind has not changed since Unicode 3.2), and which no special string touches: what is in front of such
a place doesn't depend on whether a chunk's end cuts a special string behind it. On either side of it both encodings
are equal, so the splice is exact. Boundaries are looked for before anything is encoded; where an overlap has none it is widened, and a chunk
without any runs on to the next boundary of the text, so every character is encoded a bounded number of times.

A chunk's own pieces are cut at every stable boundary in front of ASCII white space. Cutting and telling the different
segments apart is done on Arrow buffers; the library encodes each different segment once for each worker, many joined
in one call, and the results are kept in a bounded cache.
"""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tune

#: Characters: a chunk; a first overlap; longest cached segment.
CHUNK = 65_536
OVERLAP = 256
LONGEST_KEPT = 64
#: Segments in one generation of a worker's cache; there are two generations.
CACHE = 500_000
#: Segments joined into one text for the library.
JOINED = 1_000

_loaded: dict[str, object] = {}


def load_tokenizer(path: str):
    """The tokenizer of a .json file; one for each worker process."""
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _loaded[path] = Tokenizer.from_file(path)
    return _loaded[path]


def special_strings(tok) -> list[str]:
    return [t.content for t in tok.get_added_tokens_decoder().values()]


class SegmentCache:
    """What ``encode`` (a list of segments -> a list of values) gives, for segments seen lately."""

    def __init__(self, encode: Callable[[list[str]], list], limit: int = CACHE):
        self.encode, self.limit, self.new, self.old = encode, limit, {}, {}

    def values(self, segments: list) -> list:
        new, old = self.new, self.old
        out = list(map(new.get, segments))
        missing = dict.fromkeys(segments[i] for i, x in enumerate(out) if x is None)
        if missing:
            rest = [s for s in missing if s not in old]
            found = {s: old[s] for s in missing if s in old} if len(rest) < len(missing) else {}
            found.update(zip(rest, self.encode(rest), strict=True))
            out = [found[s] if x is None else x for s, x in zip(segments, out, strict=True)]
            new.update(found)
            for s in rest:
                if len(s) > LONGEST_KEPT:
                    del new[s]
        if len(new) > self.limit:
            self.old, self.new = new, {}
        return out


# White space beyond ASCII by its last three bytes in UTF-8, the first ones as they follow any byte: U+1680, U+2000 to
# U+200A, U+2028, U+2029, U+202F, U+205F, U+3000; and by its last two: U+0085, U+00A0.
_ODD_THREE = np.array([0xE19A80, *range(0xE28080, 0xE2808B), 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080])
_ODD_TWO = np.array([0xC285, 0xC2A0])


def segments_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(all segments of the texts, which tile them; the first segment of each text, and their number at the end).

    A text is cut in front of each run of ASCII white space that follows a visible character. Nulls have no segment.
    """
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    _, offsets, buffer = texts.buffers()
    edge = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(buffer, np.uint8)[: edge[-1]] if buffer is not None else np.zeros(0, np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    at = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    last = data[at - 1]
    good = (last < 0x1C) | (last > 0x1F)
    wide = np.flatnonzero(last >= 0x80)
    if len(wide):
        p = at[wide]
        two = data[p - 2].astype(np.int64) << 8 | data[p - 1]  # a byte from 0x80 on is never the first of a text
        three = np.where(p >= 3, data[np.maximum(p - 3, 0)], 0).astype(np.int64) << 16 | two
        good[wide] = ~(np.isin(two, _ODD_TWO) | np.isin(three, _ODD_THREE))
    cut = np.zeros(len(data), bool)
    cut[at[good]] = True
    cut[: edge[0]] = False
    cut[edge[:-1][np.diff(edge) > 0]] = True
    starts = np.flatnonzero(cut)
    bounds = np.append(starts, edge[-1]).astype(np.int64)
    own = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(bounds), buffer if buffer is not None else pa.py_buffer(b"")])
    return own, np.searchsorted(starts, edge)


SPACE, BLANK, LETTER, NUMBER, OTHER, UNKNOWN = range(6)
_KIND = np.full(0x110000, UNKNOWN, np.uint8)
_KNOWN = np.zeros(0x1100, bool)


def _kind(c: int) -> int:
    if c == 32 or 9 <= c <= 13:
        return SPACE if c == 32 else BLANK
    now, old = unicodedata.category(chr(c)), unicodedata.ucd_3_2_0.category(chr(c))
    if now[0] != old[0]:
        return UNKNOWN
    return {"L": LETTER, "N": NUMBER, "M": OTHER, "P": OTHER, "S": OTHER}.get(now[0], UNKNOWN)


def kinds(c: np.ndarray) -> np.ndarray:
    """The kind of each code point."""
    for block in np.unique(c >> 8).tolist() if len(c) < 1 << 16 else np.flatnonzero(np.bincount(c >> 8)).tolist():
        if not _KNOWN[block]:
            _KIND[block << 8 : block + 1 << 8] = [_kind(x) for x in range(block << 8, block + 1 << 8)]
            _KNOWN[block] = True
    return _KIND[c]


def joined_encoder(tok, glue: str, counts: Callable[[list[str]], np.ndarray], ends: Callable[[np.ndarray], np.ndarray]):
    """A function segments -> their ids, by few calls of the library.

    counts: how many marked tokens each segment is sure to have, 0 where that isn't proven. Proven segments are joined
    by ``glue``; ``ends`` marks tokens of the joined text (as ends: the places behind them), and ids are parted behind
    every segment's last mark. The marks found must be as many as were counted. Other segments are encoded alone.
    """

    def run(segments: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(segments)
        marks = counts(segments)
        alone, sure = np.flatnonzero(marks == 0).tolist(), np.flatnonzero(marks)
        groups = [sure[i : i + JOINED] for i in range(0, len(sure), JOINED)]
        texts = [glue.join([segments[i] for i in g.tolist()]) for g in groups]
        for g, e in zip(groups, tok.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            own = np.array(e.ids, np.uint32)
            at, total = ends(own), np.cumsum(marks[g])
            if len(at) != total[-1]:
                alone += g.tolist()
                continue
            cut = at[total - 1].tolist()
            for i, x, y in zip(g.tolist(), [0, *cut], cut, strict=False):
                out[i] = own[x:y]
        for i, e in zip(alone, tok.encode_batch_fast([segments[i] for i in alone], add_special_tokens=False), strict=True):
            out[i] = np.array(e.ids, np.uint32)
        return out

    return run


def byte_level_encoder(tok):
    """Segments of white space, then something visible: a token that begins in white space behind one that ends
    visibly begins a segment, as no piece spans the two."""
    white = tuple("\u0109\u010a\u010b\u010c\u010d\u0120")  # how the byte-level alphabet writes bytes 9 to 13 and 32
    begins, closes = np.zeros(tok.get_vocab_size(), bool), np.zeros(tok.get_vocab_size(), bool)
    for t, i in tok.get_vocab().items():
        begins[i], closes[i] = t.startswith(white), not t.endswith(white)

    def counts(segments: list[str]) -> np.ndarray:
        return np.array([s[0] in " \t\n\r\x0b\x0c" and not s[-1].isspace() and len(s.split()) == 1 for s in segments], np.int64)

    def ends(ids: np.ndarray) -> np.ndarray:
        return np.append(np.flatnonzero(closes[ids[:-1]] & begins[ids[1:]]) + 1, len(ids))

    return joined_encoder(tok, "", counts, ends)


def stable(text: str, begin: int, end: int) -> np.ndarray:
    """Boundaries p in [begin, end), 0 < p < len(text), where the pre-tokenizer must begin a piece."""
    begin, end = max(begin, 1), min(end, len(text))
    if begin >= end:
        return np.zeros(0, np.int64)
    c = np.frombuffer(text[begin - 1 : end].encode("utf-32-le", "surrogatepass"), "<u4")
    k = kinds(c)
    a, b = k[:-1], k[1:]
    visible = lambda x: (x == LETTER) | (x == NUMBER) | (x == OTHER)
    turn = visible(a) & visible(b) & (a != b) & ~((c[:-1] == 39) & (b == LETTER))  # 's and its like are one piece
    return begin + np.flatnonzero(visible(a) & (b <= BLANK) | (a == BLANK) & visible(b) | turn)


class Boundaries:
    """Stable boundaries of a text that no special string touches.

    The library parts a text at its special strings first, and a chunk's end may cut one that begins further on. In front of
    one the white space is parted as at the end of a text, so a boundary right before or behind one isn't safe.
    """

    def __init__(self, text: str, specials: Sequence[str] = ()):
        self.text, self.specials = text, specials

    def _free(self, p: int) -> bool:
        return all(self.text.find(s, max(0, p - len(s)), p + len(s)) < 0 for s in self.specials)

    def last(self, begin: int, end: int) -> int | None:
        """The last one in [begin, end)."""
        return next((p for p in reversed(stable(self.text, begin, end).tolist()) if self._free(p)), None)

    def next(self, begin: int, step: int) -> int | None:
        """The first one from ``begin`` on."""
        for at in range(begin, len(self.text), step):
            for p in stable(self.text, at, at + step).tolist():
                if self._free(p):
                    return p
        return None


def encode_spliced(encode, text: str, chunk: int = CHUNK, overlap: int = OVERLAP, specials: Sequence[str] = ()) -> list[int]:
    """Ids of ``text`` from overlapping chunks; ``encode`` gives an object with ``ids`` and ``offsets``."""
    n, ids, found = len(text), [], Boundaries(text, specials)
    chunk = max(chunk, 2 * overlap)

    def last(low: int, high: int) -> int | None:
        """The last boundary in [low, high), looked for in an overlap that is widened."""
        wide = overlap
        while True:
            p = found.last(max(low, high - wide), high)
            if p is not None or high - wide <= low:
                return p
            wide *= 2

    def until(begin: int, size: int) -> int:
        """Where a chunk ends that has a boundary behind ``begin``; without any it ends with the text."""
        end = begin + size
        if end >= n or last(begin + 1, end) is not None:
            return min(n, end)
        p = found.next(end, chunk)
        return n if p is None else min(n, p + overlap)

    done = at = 0  # ids of text[:done] are out; the chunk in hand is text[at:end]
    end = until(0, chunk)
    now = encode(text[at:end])
    while end < n:
        high, wide, splice = end, overlap, None
        while splice is None and high > done + 1:
            p = last(done + 1, high)
            if p is None:
                break
            begin, stop = max(done, p - overlap), until(p, chunk)
            after = encode(text[begin:stop])
            if any(at + i == p for i, _ in now.offsets) and any(begin + i == p for i, _ in after.offsets):
                splice = p
            high, wide = min(p, end - wide), 2 * wide  # the encodings don't agree there: widen
        if splice is None:
            at, end = done, until(done, 2 * (end - done))
            now = encode(text[at:end])
            continue
        ids += [t for t, (i, _) in zip(now.ids, now.offsets, strict=True) if done <= at + i < splice]
        done, at, end, now = splice, begin, stop, after
    return ids + [t for t, (i, _) in zip(now.ids, now.offsets, strict=True) if at + i >= done]


def segment_counts(texts: pa.Array, cache: SegmentCache) -> np.ndarray:
    """Tokens of each text, from the counts of its segments."""
    own, first = segments_of(texts)
    d = own.dictionary_encode()
    each = np.array(cache.values(d.dictionary.to_numpy(zero_copy_only=False).tolist()), np.int64)
    total = np.concatenate(([0], np.cumsum(each[d.indices.to_numpy()]) if len(own) else []))
    return np.diff(total[first]).astype(np.int64)


def count_cache(tok, limit: int = CACHE) -> SegmentCache:
    encode = byte_level_encoder(tok)
    return SegmentCache(lambda xs: [len(x) for x in encode(xs)], limit)


def _counter(path: str, chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = load_tokenizer(path)
        key = f"count {path}"
        if key not in _loaded:
            _loaded[key] = count_cache(tok)
        specials = special_strings(tok)
        one = lambda s: tok.encode(s, add_special_tokens=False)
        for b in batches:
            texts = pc.fill_null(b.column(1), "")
            long = pc.greater(pc.utf8_length(texts), chunk)
            counts = np.zeros(len(texts), np.int64)
            short = np.flatnonzero(~long.to_numpy(zero_copy_only=False))
            counts[short] = segment_counts(texts.take(pa.array(short)) if len(short) < len(texts) else texts, _loaded[key])
            for i in np.flatnonzero(long.to_numpy(zero_copy_only=False)).tolist():
                counts[i] = len(encode_spliced(one, texts[i].as_py(), chunk, overlap, specials))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pc.binary_length(texts).cast(pa.int64()), pa.array(counts)], names=["doc_id", "n_bytes", "n_tokens"]
            )

    return run


def count_tokens(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """doc_id, n_bytes (UTF-8) and n_tokens of every whole text.

    tokenizer: path of a byte-level tokenizer's .json file (the usual byte-level pattern), readable on every executor.
    No begin, end or added special tokens; special strings inside texts are handled as is the library's default; no
    truncation or padding. Texts longer than ``chunk`` characters are spliced from chunks. Null and empty texts have 0
    bytes and 0 tokens; ids may be null or repeat, one row goes out for each row; other columns are not looked at.
    """
    tune(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _counter(tokenizer, chunk, overlap), f"doc_id {kind}, n_bytes bigint, n_tokens bigint"
    )
