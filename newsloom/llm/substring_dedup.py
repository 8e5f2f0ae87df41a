"""Exact substring deduplication by super-k-mer partitioning.

A window is ``width`` consecutive words. Each window's minimiser is the least hash among its word
m-mers; consecutive windows that share it travel as one packed string (a super-k-mer) to the bucket of
the minimiser, so every occurrence of a word sequence meets in one bucket. There the windows are sorted
by a hash of their words, equal neighbours are compared byte by byte, and windows that start at two or
more places are marked. Marks go back to every place of the packed string by its 128-bit digest.

Skew. Identical packed strings of a task's flush travel once, with a count, so a group of copies sends
one row a flush. m-mers that are minimisers of a large share of super-k-mers are found first (per-task
counts above ``1/HEAVY_LIMIT`` of the task, summed; at most HEAVY_LIMIT survive) and rank last, so
windows that only touch a very common line are spread by their own rarer words; windows that lie within a
common passage have one packed form and collapse. Marks are joined by digest, where AQE splits skew.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_rows, materialise, partitions_for, tune

WIDTH = 35
M = 3
#: Most m-mers that rank last (1.6 MB as sorted 64-bit numbers), and least super-k-mers that one needs.
HEAVY_LIMIT = 200_000
HEAVY_LEAST = 20_000
#: Bytes of text worked on at once, and of packed strings gathered before frames are sent.
SLICE = 1 << 20
FLUSH = 24 << 20
#: Packed bytes for a byte of text; bytes a bucket is planned for (a task sorts one at a time); least buckets in a partition.
PACKED = 2.2
BUCKET_BYTES = 8 << 20
BUCKETS_EACH = 4

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_RANDOM = np.random.default_rng(20240229).integers(1, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_Q = np.uint64(0x9E3779B97F4A7C15)
_R = np.uint64(0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * _R
    h = h ^ (h >> np.uint64(29))
    h = h * _Q
    return h ^ (h >> np.uint64(32))


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the words (runs of bytes that are not ASCII white space)."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, the same in every process."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    inside = ~_SPACE[data]
    at = np.flatnonzero(inside)
    place = at - np.repeat(starts, lengths)
    values = (data[at].astype(np.uint64) + np.uint64(1)) * _RANDOM[place & 4095]
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    return mix(np.add.reduceat(values, first) + lengths.astype(np.uint64))


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """out[i] = min(v[i : i + w]) for each full window, by doubling."""
    n = len(v) - w + 1
    if n <= 0:
        return v[:0]
    span, best = 1, v
    while span * 2 <= w:
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    return np.minimum(best[:n], best[w - span : w - span + n])


def sliding_hash(h: np.ndarray, w: int) -> np.ndarray:
    """A hash of each run of ``w`` word hashes, in order, by doubling."""
    n = len(h) - w + 1
    if n <= 0:
        return h[:0]
    out, done, power, span, block = None, 0, _Q, 1, h
    bits = w
    while bits:
        if bits & 1:
            part = block[done : done + n]
            out = part.copy() if out is None else out * power + part
            done += span
        bits >>= 1
        if bits:
            block = block[: len(block) - span] * power + block[span:]
            span *= 2
            power = np.uint64(int(power) ** 2 & (2**64 - 1))
    return out


def slices(text: bytes, width: int) -> Iterator[tuple[int, bytes]]:
    """(index of its first word, bytes) of pieces that overlap by width - 1 words, cut at white space.

    Every window of the document lies in exactly one piece; memory follows SLICE, not the document.
    """
    base = pos = 0
    step = SLICE
    while True:
        end = pos + step
        while end < len(text) and not _SPACE[text[end]]:
            end += 1
        piece = text[pos:end]
        if end >= len(text):
            yield base, piece
            return
        starts, _ = words_of(np.frombuffer(piece, np.uint8))
        if len(starts) < 2 * width:
            step *= 2
            continue
        step = SLICE
        yield base, piece
        base += len(starts) - width + 1
        pos += int(starts[len(starts) - width + 1])


def superkmers(pieces: list[bytes], heavy: np.ndarray, width: int = WIDTH, m: int = M):
    """Super-k-mers of the texts: normalised bytes, and for each its piece, first word, byte range, minimiser."""
    m = min(m, width)
    joined = np.frombuffer(b" ".join(pieces), np.uint8)
    starts, ends = words_of(joined)
    none = np.zeros(0, np.int64)
    if len(starts) < width:
        return b"", none, none, none, none, none.astype(np.uint64)
    begin = np.cumsum([0] + [len(p) + 1 for p in pieces])
    owner = np.searchsorted(begin, starts, "right") - 1
    h = word_hashes(joined, starts, ends)
    grams = h[: len(h) - m + 1]
    for j in range(1, m):
        grams = grams * _Q + h[j : len(h) - m + 1 + j]
    grams = mix(grams) >> np.uint64(1)
    if len(heavy):
        at = np.minimum(np.searchsorted(heavy, grams), len(heavy) - 1)
        grams = grams | ((heavy[at] == grams).astype(np.uint64) << np.uint64(63))
    least = sliding_min(grams, width - m + 1)
    fits = owner[: len(least)] == owner[width - 1 :]
    at = np.flatnonzero(fits)
    if not len(at):
        return b"", none, none, none, none, none.astype(np.uint64)
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (least[at[1:]] != least[at[:-1]]) | (owner[at[1:]] != owner[at[:-1]])
    first = np.flatnonzero(new)
    run = np.diff(np.append(first, len(at)))
    lead = at[first]
    lengths = ends - starts
    keep = ~_SPACE[joined]
    tidy = np.where(keep, joined, np.uint8(32))
    after = np.zeros(len(tidy), bool)
    after[1:] = keep[:-1]
    tidy = tidy[keep | after]
    nstarts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    nends = nstarts + lengths
    first_word = np.searchsorted(owner, np.arange(len(pieces)))
    return (
        tidy.tobytes(), owner[lead], lead - first_word[owner[lead]], nstarts[lead], nends[lead + run + width - 2],
        least[lead] & np.uint64(2**63 - 1),
    )


def _grouped(batches: Iterator[pa.RecordBatch], width: int):
    """Lists of (row number in its batch, first word, piece) of about SLICE bytes, batch by batch."""
    for b in batches:
        rows: list[tuple[int, int]] = []
        pieces: list[bytes] = []
        size = 0
        for i, text in enumerate(byte_rows(b.column(b.num_columns - 1))):
            for base, piece in slices(text, width) if text else ():
                rows.append((i, base))
                pieces.append(piece)
                size += len(piece)
                if size >= SLICE:
                    yield b, rows, pieces
                    rows, pieces, size = [], [], 0
        if pieces:
            yield b, rows, pieces


def _frequent(width: int):
    def run(batches):
        held, total = [], 0
        counts: dict[int, int] = {}

        def fold():
            nonlocal held
            if held:
                keys, n = np.unique(np.concatenate(held), return_counts=True)
                held = []
                often = n >= 2
                for k, c in zip(keys[often].tolist(), n[often].tolist(), strict=True):
                    counts[k] = counts.get(k, 0) + c
                least = max(2, -(-total // HEAVY_LIMIT))
                if len(counts) > 2 * HEAVY_LIMIT:
                    for k in [k for k, c in counts.items() if c < least]:
                        del counts[k]

        none, waiting, size = np.zeros(0, np.uint64), 0, 0
        for _, _, pieces in _grouped(batches, width):
            size += sum(map(len, pieces))
            _, _, _, _, _, least = superkmers(pieces, none, width)
            held.append(least)
            total += len(least)
            waiting += len(least)
            if waiting >= 1_000_000:
                fold()
                waiting = 0
        fold()
        least = max(2, -(-total // HEAVY_LIMIT))
        found = {k: c for k, c in counts.items() if c >= least}
        yield pa.RecordBatch.from_arrays(
            [pa.array([*found, None], pa.int64()), pa.array([*found.values(), total], pa.int64()), pa.array([0] * len(found) + [size], pa.int64())],
            names=["gram", "n", "size"],
        )

    return run


def frequent_minimisers(texts: DataFrame, width: int) -> tuple[np.ndarray, int]:
    """Sorted hashes of the m-mers that are minimisers of very many super-k-mers, at most HEAVY_LIMIT; bytes of text."""
    counts = texts.mapInArrow(_frequent(width), "gram bigint, n bigint, size bigint")
    counts = counts.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("size").alias("size"))
    counts = materialise(counts.where(F.col("gram").isNull() | (F.col("n") >= HEAVY_LEAST)), "minimisers")
    total, size = counts.where(F.col("gram").isNull()).agg(F.sum("n"), F.sum("size")).first()
    least = max(HEAVY_LEAST, -(-(total or 0) // HEAVY_LIMIT))
    found = counts.where(F.col("gram").isNotNull() & (F.col("n") >= least)).select("gram").collect()
    return np.sort(np.array([r[0] for r in found], dtype=np.uint64)), size or 0


def bucket_of(least: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(least) % np.uint64(buckets)).astype(np.int64)


def _frames(heavy, buckets: int, width: int):
    """Frames (bucket, zstd of counts, lengths and packed strings), identical strings once with a count."""

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1)
        held: dict[int, dict[bytes, int]] = {}
        size = 0

        def flush():
            keys, frames = [], []
            for k, strings in held.items():
                head = np.array([len(strings)], np.int64).tobytes()
                counts = np.fromiter(strings.values(), np.int64, len(strings)).tobytes()
                keys.append(k)
                frames.append(pack.compress(head + counts + b"\n".join(strings) + b"\n"))
            for i in range(0, len(keys), 256):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[i : i + 256], pa.int64()), pa.array(frames[i : i + 256], pa.binary())],
                    names=["bucket", "frame"],
                )

        for _, _, pieces in _grouped(batches, width):
            text, _, _, begin, end, least = superkmers(pieces, heavy.value, width)
            for k, i, j in zip(bucket_of(least, buckets).tolist(), begin.tolist(), end.tolist(), strict=True):
                own = held.setdefault(k, {})
                s = text[i:j]
                own[s] = own.get(s, 0) + 1
                size += j - i
            if size >= FLUSH:
                yield from flush()
                held, size = {}, 0
        yield from flush()

    return run


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether data[a : a + length] equals data[b : b + length], for each place; data has 8 spare bytes at its end."""
    wide = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    equal = np.ones(len(a), bool)
    live = np.arange(len(a))
    k = 0
    while len(live):
        left = length[live] - k
        x = wide[a[live] + k] ^ wide[b[live] + k]
        short = np.minimum(left, 8)
        x &= np.where(short < 8, (np.uint64(1) << (short.astype(np.uint64) * np.uint64(8) & np.uint64(63))) - np.uint64(1), np.uint64(2**64 - 1))
        bad = x != 0
        equal[live[bad]] = False
        live = live[~bad & (left > 8)]
        k += 8
    return equal


def repeated_windows(text: bytes, counts: np.ndarray, width: int = WIDTH):
    """Windows of the packed strings (each ended by a line feed) that start at two or more places.

    Returns (string number, first window, last window + 1) of each maximal run, in order.
    """
    data = np.frombuffer(text + b"\n" * 9, np.uint8)
    starts, ends = words_of(data)
    none = np.zeros(0, np.int64)
    if len(starts) < width:
        return none, none, none
    line = np.cumsum(data == 10)[starts]
    windows = sliding_hash(word_hashes(data, starts, ends), width)
    at = np.flatnonzero(line[: len(windows)] == line[width - 1 :])
    order = at[np.argsort(windows[at], kind="stable")]
    value = windows[order]
    new = np.ones(len(order), bool)
    new[1:] = value[1:] != value[:-1]
    group = np.cumsum(new) - 1
    weight = np.bincount(group, counts[line[order]]).astype(np.int64)
    often = weight[group] >= 2
    order, group = order[often], group[often]
    if not len(order):
        return none, none, none
    lead = np.ones(len(order), bool)
    lead[1:] = group[1:] != group[:-1]
    head = order[np.maximum.accumulate(np.where(lead, np.arange(len(order)), 0))]
    length = ends[order + width - 1] - starts[order]
    fits = length == ends[head + width - 1] - starts[head]
    probe = np.flatnonzero(fits & ~lead)
    fits[probe] = same_bytes(data, starts[order[probe]], starts[head[probe]], length[probe])
    if not fits.all():  # two different windows have one hash: count that group by its words
        wrong = np.isin(group, group[~fits])
        exact: dict[bytes, list[int]] = {}
        for w in order[wrong].tolist():
            exact.setdefault(text[starts[w] : ends[w + width - 1]], []).append(w)
        true = [w for own in exact.values() if counts[line[own]].sum() >= 2 for w in own]
        order = np.concatenate((order[~wrong], np.array(true, order.dtype)))
    order = np.sort(order)
    first = np.ones(len(order), bool)
    first[1:] = (np.diff(order) != 1) | (line[order[1:]] != line[order[:-1]])
    begin = np.flatnonzero(first)
    stop = np.append(begin[1:], len(order)) - 1
    own = line[order[begin]]
    first_word = np.searchsorted(line, own)
    return own, order[begin] - first_word, order[stop] + 1 - first_word


def _marks(width: int):
    """Of each bucket (its frames stand together): digest of a packed string, word ranges to remove."""

    def solve(frames: list[bytes]):
        counts, texts = [], []
        unpack = zstandard.ZstdDecompressor()
        for f in frames:
            raw = unpack.decompress(f)
            n = int(np.frombuffer(raw, np.int64, 1)[0])
            counts.append(np.frombuffer(raw, np.int64, n, 8))
            texts.append(raw[8 + 8 * n :])
        text = b"".join(texts)
        own, begin, end = repeated_windows(text, np.concatenate(counts), width)
        if not len(own):
            return
        cuts = np.concatenate(([0], np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1))
        lead = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        ranges = np.stack((begin, end + width - 1), 1).astype(np.int32)
        out: dict[bytes, bytes] = {}
        for i, j in zip(lead.tolist(), [*lead[1:].tolist(), len(own)], strict=True):
            s = own[i]
            out[xxhash.xxh3_128_digest(text[cuts[s] : cuts[s + 1] - 1])] = ranges[i:j].tobytes()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(out), pa.binary()), pa.array(list(out.values()), pa.binary())], names=["digest", "ranges"]
        )

    def run(batches):
        now, frames = None, []
        for b in batches:
            for k, f in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if k != now and frames:
                    yield from solve(frames)
                    frames = []
                now = k
                frames.append(f)
        if frames:
            yield from solve(frames)

    return run


def _places(heavy, width: int):
    """Every place of a packed string: its digest, document, and first word there."""

    def run(batches):
        for b, rows, pieces in _grouped(batches, width):
            text, owner, word, begin, end, _ = superkmers(pieces, heavy.value, width)
            if not len(owner):
                continue
            digest = xxhash.xxh3_128_digest
            found = [digest(text[i:j]) for i, j in zip(begin.tolist(), end.tolist(), strict=True)]
            row = np.array([r for r, _ in rows])[owner]
            base = np.array([x for _, x in rows])[owner]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.binary()), b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row)), pa.array(base + word, pa.int64())],
                names=["digest", "doc_id", "text_hash", "word"],
            )

    return run


def _kept(batches):
    for b in batches:
        n_words, n_removed, kept, spans = [], [], [], []
        for text, marks in zip(byte_rows(b.column(1)), b.column(2).to_pylist(), strict=True):
            words = (text or b"").split()
            n_words.append(len(words))
            if not marks:
                n_removed.append(0)
                spans.append([])
                kept.append(b" ".join(words))
                continue
            step = np.zeros(len(words) + 1, np.int64)
            for mark in marks:
                r = np.frombuffer(mark["ranges"], np.int32).reshape(-1, 2) + mark["word"]
                np.add.at(step, r[:, 0], 1)
                np.add.at(step, r[:, 1], -1)
            gone = np.cumsum(step[:-1]) > 0
            edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
            spans.append([{"begin": i, "end": j} for i, j in edge.reshape(-1, 2).tolist()])
            n_removed.append(int(gone.sum()))
            kept.append(b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g]))
        yield pa.RecordBatch.from_arrays(
            [
                b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                pa.array(kept, pa.binary()).cast(pa.string()),
                pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
            ],
            names=["doc_id", "n_words", "n_removed", "kept_text", "removed"],
        )


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """Remove every word covered by a window of ``width`` words that also starts anywhere else.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text, unchanged; windows are judged on the input, all
    documents and the same document included. Returns one row for each input row: doc_id, n_words,
    n_removed, kept_text (kept words joined by one space) and removed (word ranges, end exclusive).

    Null or empty texts and texts of fewer than ``width`` words lose nothing; null ids are kept as null.
    Repeated rows are copies of each other, so their windows go. Other columns are not looked at.
    """
    spark = docs.sparkSession
    tune(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    common, size = frequent_minimisers(base.select("text"), width)
    heavy = spark.sparkContext.broadcast(common)
    parts = partitions_for(spark, int(PACKED * size))
    buckets = parts * max(BUCKETS_EACH, -(-int(PACKED * size) // (parts * BUCKET_BYTES)))
    marks = (
        base.select("text")
        .mapInArrow(_frames(heavy, buckets, width), "bucket bigint, frame binary")
        .repartition(parts, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_marks(width), "digest binary, ranges binary")
    )
    marks = materialise(marks, "marks")
    keyed = base.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    places = keyed.mapInArrow(_places(heavy, width), f"digest binary, doc_id {kind}, text_hash bigint, word bigint")
    found = (
        places.join(marks, "digest")
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set(F.struct("word", "ranges")).alias("marks"))
        .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "marks")
    )
    joined = keyed.join(
        found, keyed["doc_id"].eqNullSafe(found["_id"]) & keyed["text_hash"].eqNullSafe(found["_hash"]), "left"
    )
    return joined.select("doc_id", "text", "marks").mapInArrow(
        _kept,
        f"doc_id {kind}, n_words bigint, n_removed bigint, kept_text string, removed array<struct<begin:bigint,end:bigint>>",
    )
