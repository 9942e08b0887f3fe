"""Exact substring dedup: every byte that lies in a repeated string of ``length`` bytes goes, but the first copy stays.

A string of ``length`` bytes (a window) is known by its anchor, the smallest hash of the shorter strings in it:
equal windows have equal anchors at equal places. Consecutive windows with one anchor are a segment. Segments
are dealt out by anchor; anchors that occur once are done. Equal segments need no comparison: all but the first
are repeats. Different segments around one anchor are cut from the texts and compared in a suffix array: the
Burrows-Wheeler transform of a bounded number of them is searched breadth-first, extending intervals backwards,
which finds the common prefixes of neighbouring suffixes by increasing length; the search stops at ``length``,
and neighbours that it has not parted by then share a window. A window of three anchors or more reaches over its
anchor by as much on one side at least, so a segment is only compared if the hash of that side occurs in another
segment around the anchor.

An anchor with a great share of all segments is split: its windows are dealt out one by one, by their own hash.
Such anchors are found beforehand, in a pass that keeps a bounded number of counters.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, numbered, text_or_empty, whole_ids, written

#: Bytes of an anchor; power of two.
ANCHOR = 32
#: Bytes of text that are hashed together.
TEXT_BYTES = 1 << 18
#: Segments that one task gathers by anchor, on average.
TASK_SEGMENTS = 400_000
#: No anchor keeps more than twice this share of the segments together; so 1 / share anchors at most are split.
LEAST_SHARE = 1e-5
#: Repeated segments that a task remembers.
REMEMBERED = 200_000
#: Different segments around one anchor beyond which the windows are dealt out one by one.
GROUP_SEGMENTS = 4_000
#: Bytes that are sorted in one suffix array, unless one group has more, and bytes of segments of a task.
SORT_BYTES, TASK_BYTES = 1 << 20, 8 << 20

MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


# --- anchors ---


def rolling_hashes(data: np.ndarray, size: int = ANCHOR) -> np.ndarray:
    """A 64-bit hash of the ``size`` bytes from every place on, by doubling."""
    h = (data.astype(np.uint64) + np.uint64(1)) * MIX[0]
    h ^= h >> np.uint64(29)
    step = 1
    while step < size:
        h = h[:-step] * MIX[1] + (h[step:] ^ (h[step:] >> np.uint64(31)))
        h *= MIX[0]
        h ^= h >> np.uint64(32)
        step *= 2
    return h


def anchors(h: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of the anchor of every window, from all hashes; of equal hashes the leftmost."""
    width = length - ANCHOR + 1  # anchors to choose from in a window
    low = np.uint64((1 << width.bit_length()) - 1)
    n = len(h) - width + 1
    padded = np.full(-(-len(h) // width) * width, ~np.uint64(0))
    padded[: len(h)] = h
    blocks = padded.reshape(-1, width)
    blocks = (blocks & ~low) | np.arange(width, dtype=np.uint64)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    left, right = behind[:n], ahead[width - 1 : width - 1 + n]
    first = (left & ~low) <= (right & ~low)
    start = np.arange(n)
    block = np.where(first, start, start + width - 1) // width
    place = block * width + (np.where(first, left, right) & low).astype(np.int64)
    return h[place], place


def segments(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, hashes of its two sides (32 bits each), number of the text, first window and number of windows
    of every segment; and the joined texts with their starts."""
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    joined = b"".join(texts)
    if len(joined) < length:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none, joined, starts
    h = rolling_hashes(np.frombuffer(joined, np.uint8))
    found, place = anchors(h, length)
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(found)]
    window = np.arange(len(found))
    inside = window + length <= (starts + sizes)[owner]
    cut = np.ones(len(found), bool)
    cut[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(cut & inside)
    stop = np.append(np.flatnonzero(cut), len(found))
    limit = (starts + sizes - length + 1)[owner[first]]
    after = np.minimum(stop[np.searchsorted(stop, first, side="right")], limit)
    left, right = (h[np.clip(place[first] + d, 0, len(h) - 1)] for d in (-ANCHOR, ANCHOR))
    sides = ((left >> np.uint64(32) << np.uint64(32)) | (right >> np.uint64(32))).view(np.int64)
    own = owner[first]
    return found[first].view(np.int64), sides, own, first - starts[own], after - first, joined, starts


def grouped_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    for batch in chunks(batches, "_text", TEXT_BYTES):
        yield batch.column("_key").to_numpy(), batch.column("_text").cast(pa.binary()).to_pylist()


def heavy_anchors(texts: DataFrame, length: int, share: float) -> np.ndarray:
    """Anchors that may have more than twice ``share`` of all segments; not more than 1 / share of them.

    A task reports the anchors that have the share among some millions of its own segments. Whatever is left
    unreported of an anchor adds up to less than the share.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def report(parts: list[np.ndarray]) -> pa.RecordBatch:
            every = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            values, counts = np.unique(every, return_counts=True)
            many = counts >= max(2, share * len(every))
            columns = [pa.array([*values[many], 0]), pa.array([*counts[many], len(every)], pa.int64())]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array([False] * int(many.sum()) + [True])], names=["anchor", "n", "total"]
            )

        held: list[np.ndarray] = []
        for _, own in grouped_texts(batches):
            held.append(segments(own, length)[0])
            if sum(map(len, held)) > 2_000_000:
                yield report(held)
                held = []
        yield report(held)

    counts = texts.mapInArrow(run, "anchor long, n long, total boolean").groupBy("anchor", "total")
    counts = written(counts.agg(F.sum("n").alias("n")), "anchors")
    total = counts.where("total").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    heavy = counts.where(~F.col("total") & (F.col("n") >= max(2, share * total))).select("anchor")
    return np.array(sorted(row["anchor"] for row in heavy.collect()), np.int64)


def window_hashes(joined: bytes, first: np.ndarray, length: int) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(joined[a : a + length]) for a in first.tolist()], np.uint64).view(np.int64)


def segment_rows(texts: DataFrame, length: int, heavy: np.ndarray) -> DataFrame:
    """``anchor, sides, content, _key, start, n``. Copies of a segment within a group of texts are repeats at once; they
    are marked by a negative ``n`` and dealt out evenly. A task remembers a bounded number of segments that were
    repeated in a group and marks later copies too, so a segment of very many copies is sent a few times a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        seen = [np.zeros(0, np.int64)] * 4  # content, anchor, key and start, sorted by content
        for keys, own in grouped_texts(batches):
            anchor, sides, owner, start, n, joined, starts = segments(own, length)
            split = np.isin(anchor, heavy)
            if split.any():
                each = np.where(split, n, 1)
                step = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                n = np.where(np.repeat(split, each), 1, np.repeat(n, each))
                anchor, sides, owner = np.repeat(anchor, each), np.repeat(sides, each), np.repeat(owner, each)
                start = np.repeat(start, each) + step
                one = np.repeat(split, each)
                anchor[one] = window_hashes(joined, (starts[owner] + start)[one], length)
            begin = (starts[owner] + start).tolist()
            end = (starts[owner] + start + n + length - 1).tolist()
            content = np.array([digest(joined[a:b]) for a, b in zip(begin, end)], np.uint64).view(np.int64)
            key = keys[owner]
            order = np.lexsort((start, key, content, anchor))
            anchor, sides, content, key, start, n = (x[order] for x in (anchor, sides, content, key, start, n))
            again = np.zeros(len(n), bool)
            again[1:] = (anchor[1:] == anchor[:-1]) & (content[1:] == content[:-1])
            if len(seen[0]):
                at = np.minimum(np.searchsorted(seen[0], content), len(seen[0]) - 1)
                later = (key > seen[2][at]) | ((key == seen[2][at]) & (start > seen[3][at]))
                again |= (seen[0][at] == content) & (seen[1][at] == anchor) & later
            first = np.flatnonzero(~again[:-1] & again[1:] & (content[1:] == content[:-1]))
            if len(first) and len(seen[0]) < REMEMBERED:
                joined_ = [np.concatenate(x) for x in zip(seen, (content[first], anchor[first], key[first], start[first]))]
                _, kept = np.unique(joined_[0], return_index=True)
                seen = [x[kept] for x in joined_]
            anchor = np.where(again, key * 1_000_003 + start, anchor)
            columns = (anchor, sides, content, key, start, np.where(again, -n, n))
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=SEGMENT)

    return texts.mapInArrow(run, "anchor long, sides long, content long, _key long, start long, n long")


SEGMENT = ["anchor", "sides", "content", "_key", "start", "n"]


def marked(rows: DataFrame, parts: int) -> DataFrame:
    """``anchor, _key, start, n, state``: repeats (0), and segments that have to be compared with others around
    the same anchor: as a whole (1) or, in a large group, window by window (2). Everything else is dropped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[column.to_numpy() for column in batch.columns] for batch in batches]
        if not held:
            return
        anchor, sides, content, key, start, n = map(np.concatenate, zip(*held))
        del held
        done = n < 0
        sure = (np.zeros(int(done.sum()), np.int64), key[done], start[done], -n[done])
        anchor, sides, content, key, start, n = (x[~done] for x in (anchor, sides, content, key, start, n))
        order = np.lexsort((start, key, content, anchor))
        anchor, sides, content, key, start, n = (x[order] for x in (anchor, sides, content, key, start, n))
        new_anchor, new_content = np.ones(len(n), bool), np.ones(len(n), bool)
        new_anchor[1:] = anchor[1:] != anchor[:-1]
        new_content[1:] = new_anchor[1:] | (content[1:] != content[:-1])
        group = np.cumsum(new_anchor) - 1
        several = np.flatnonzero(new_content)
        several = several[np.bincount(group, new_content)[group[several]] > 1] if len(n) else several
        left, right = sides[several] >> 32, sides[several] & 0xFFFFFFFF
        several = several[repeated(group[several], left) | repeated(group[several], right)]
        size = np.bincount(group[several], minlength=len(n))[group[several]]
        state = np.where(new_content, -1, 0)
        state[several] = np.where(size > GROUP_SEGMENTS, 2, 1)
        keep = state >= 0
        out = [np.concatenate(x) for x in zip(sure, (anchor[keep], key[keep], start[keep], n[keep]))]
        out.append(np.concatenate([np.zeros(len(sure[0]), np.int64), state[keep]]))
        yield pa.RecordBatch.from_arrays(list(map(pa.array, out)), names=["anchor", "_key", "start", "n", "state"])

    dealt = rows.repartition(parts, "anchor")
    return dealt.mapInArrow(run, "anchor long, _key long, start long, n long, state long")


def repeated(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether another row of the group has the value."""
    order = np.lexsort((value, group))
    same = (group[order][1:] == group[order][:-1]) & (value[order][1:] == value[order][:-1])
    found = np.zeros(len(group), bool)
    found[order[1:][same]] = found[order[:-1][same]] = True
    return found


# --- segments that differ ---


def bodies(texts: DataFrame, marks: DataFrame, length: int) -> DataFrame:
    """``anchor, _key, start, body`` of the segments that have to be compared, cut from their texts; of large groups
    one row per window, with the hash of the window as anchor and without body."""
    wanted = marks.where("state > 0").groupBy("_key")
    wanted = wanted.agg(F.collect_list(F.struct("anchor", "start", "n", "state")).alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "_text"):
            rows: list[tuple[int, int, int, bytes]] = []
            texts_ = batch.column("_text").cast(pa.binary()).to_pylist()
            for key, text, own in zip(batch.column("_key").to_pylist(), texts_, batch.column("wanted").to_pylist()):
                for w in own:
                    at, n = w["start"], w["n"]
                    if w["state"] == 1:
                        rows.append((w["anchor"], key, at, text[at : at + n + length - 1]))
                        continue
                    each = window_hashes(text, np.arange(at, at + n), length).tolist()
                    rows.extend((h, key, a, None) for h, a in zip(each, range(at, at + n)))
            columns = list(zip(*rows)) or [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["anchor", "_key", "start", "body"]
            )

    joined = texts.join(wanted, "_key").select("_key", "_text", "wanted")
    return joined.mapInArrow(run, "anchor long, _key long, start long, body binary")


def suffix_array(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols at least, by doubling."""
    rank = symbols.astype(np.int64)
    known = 1
    while known < depth:
        following = np.zeros_like(rank)
        following[:-known] = rank[known:] + 1
        _, rank = np.unique(rank * (int(rank.max()) + 2) + following, return_inverse=True)
        known *= 2
    return np.argsort(rank, kind="stable")


def parted(symbols: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Which suffixes, in sorted order, share fewer than ``length`` symbols with the one before.

    Breadth-first search over intervals of suffixes with a common prefix, extended backwards by the transform;
    an interval that ends at a place where none ended before gives that place the length of its string less
    one, so places are parted by increasing length, and only such intervals are extended further.
    """
    n = len(order)
    transform = symbols[order - 1]
    by_symbol = np.argsort(transform, kind="stable")
    extended = np.empty(n, np.int64)  # where a suffix lies when it is extended by the symbol before it
    extended[by_symbol] = np.arange(n)
    same = transform[by_symbol[1:]] == transform[by_symbol[:-1]]
    previous, following = np.full(n, -1), np.full(n, n)
    previous[by_symbol[1:][same]] = by_symbol[:-1][same]
    following[by_symbol[:-1][same]] = by_symbol[1:][same]
    ends = np.zeros(n + 1, bool)
    ends[n] = ends[0] = True
    low, high = np.array([0]), np.array([n])
    for _ in range(length):
        sizes = high - low
        at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(low, sizes)
        interval = np.repeat(np.arange(len(low)), sizes)
        begin, last = previous[at] < low[interval], following[at] >= high[interval]
        begins = np.lexsort((transform[at[begin]], interval[begin]))
        lasts = np.lexsort((transform[at[last]], interval[last]))
        low, high = extended[at[begin][begins]], extended[at[last][lasts]] + 1
        high, kept = np.unique(high, return_index=True)
        low = low[kept]
        new = ~ends[high]
        low, high = low[new], high[new]
        ends[high] = True
        if not len(low):
            break
    ends[0] = True
    return ends[:n]


def repeats_among(texts: list[bytes], keys: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Key, first window and number of windows of all runs of windows that some text has at an earlier place."""
    sizes = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(sizes + 1) - sizes - 1
    symbols = np.zeros(int((sizes + 1).sum()), np.int16)
    filled = np.ones(len(symbols), bool)
    filled[begin + sizes] = False
    symbols[filled] = np.frombuffer(b"".join(texts), np.uint8).astype(np.int16) + 1
    order = suffix_array(symbols, length)
    group = np.cumsum(parted(symbols, order, length))
    owner = np.repeat(np.arange(len(texts)), sizes + 1)
    at = np.arange(len(symbols)) - begin[owner]
    whole = (at + length <= sizes[owner])[order]
    owner, at, group = owner[order][whole], at[order][whole], group[whole]
    key, window = keys[owner], starts[owner] + at
    place = np.lexsort((window, key, group))
    group, key, window = group[place], key[place], window[place]
    again = np.zeros(len(group), bool)
    again[1:] = group[1:] == group[:-1]
    key, window = key[again], window[again]
    place = np.lexsort((window, key))
    key, window = key[place], window[place]
    first = np.ones(len(key), bool)
    first[1:] = (key[1:] != key[:-1]) | (window[1:] != window[:-1] + 1)
    run = np.flatnonzero(first)
    return key[run], window[run], np.diff(np.append(run, len(key)))


def compared(segments_: DataFrame, length: int) -> DataFrame:
    """``_key, start, n``: runs of repeated windows among segments, anchor by anchor, in suffix arrays of bounded size."""
    total = segments_.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0))).first()[0]
    names = ["anchor", "_key", "start", "body"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(table: pa.Table) -> pa.RecordBatch:
            found = repeats_among(
                table["body"].to_pylist(), table["_key"].to_numpy(), table["start"].to_numpy(), length
            )
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=["_key", "start", "n"])

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size < SORT_BYTES:
                continue
            table = pa.Table.from_batches(held)
            anchor = table["anchor"].to_numpy()
            cut = int(np.searchsorted(anchor, anchor[-1]))  # the last anchor may go on in the next batch
            if cut:
                yield result(table.slice(0, cut))
            held = table.slice(cut).combine_chunks().to_batches()
            size = sum(b.nbytes for b in held) if cut else size
        if held:
            yield result(pa.Table.from_batches(held))

    parts = max(segments_.sparkSession.sparkContext.defaultParallelism, math.ceil(total / TASK_BYTES))
    dealt = segments_.repartition(parts, "anchor").sortWithinPartitions("anchor").select(*names)
    return dealt.mapInArrow(run, "_key long, start long, n long")


def repeated_windows(windows: DataFrame) -> DataFrame:
    """``_key, start, n``: all windows (``anchor``: their hash) but the first of each. The first ones are combined
    before the shuffle and joined back, so a window of very many copies is split like any other skewed key."""
    first = windows.groupBy("anchor").agg(F.min(F.struct("_key", "start")).alias("first"))
    later = windows.join(first, "anchor").where(F.struct("_key", "start") != F.col("first"))
    return later.select("_key", "start", F.lit(1).cast("long").alias("n"))


# --- result ---


def without(text: bytes, runs: list[tuple[int, int]]) -> tuple[bytes, int]:
    """The text without the given stretches (first, end), and the number of maximal stretches."""
    kept, at, spans, end = [], 0, 0, -1
    for first, last in sorted(runs):
        if first > end:
            kept.append(text[at:first])
            spans += 1
        end = max(end, last)
        at = end
    kept.append(text[at:])
    return b"".join(kept), spans


def remove_repeats(df: DataFrame, length: int = 100, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, n_bytes, n_removed, n_spans, kept_sha256, kept`` (binary) for every row of ``df``.

    Removes each byte of the UTF-8 text that a string of ``length`` bytes covers which also starts earlier: in a
    row of smaller key, or earlier in the same row. Strings do not cross rows; they are judged on the input. A
    null text counts as empty; texts shorter than ``length`` stay. If keys are null, repeated or not whole numbers, rows are
    ordered by key (nulls first) and a hash of the text, and every row is a document of its own. An empty table
    gives no rows. ``length`` must be three anchors at least.
    """
    if length < 3 * ANCHOR:
        raise ValueError(f"length must be {3 * ANCHOR} at least")
    rows = df.select(F.col(key), text_or_empty(text).alias("_text"))
    if whole_ids(df, key):
        rows = rows.withColumn("_key", F.col(key).cast("long"))
    else:
        rows = written(numbered(rows, [F.col(key), F.xxhash64("_text"), F.col("_text")], "_key"), "keyed")
    texts = rows.select("_key", "_text")
    total = rows.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()[0]
    spark = df.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, math.ceil(total / ((length - ANCHOR + 2) / 2) / TASK_SEGMENTS))
    heavy = heavy_anchors(texts, length, max(LEAST_SHARE, 1 / (2 * parts)))
    marks = written(marked(segment_rows(texts, length, heavy), parts), "marks")
    cut = written(bodies(texts, marks, length), "segments")
    found = compared(cut.where("body IS NOT NULL"), length).union(marks.where("state = 0").select("_key", "start", "n"))
    found = found.union(repeated_windows(cut.where("body IS NULL")))
    runs = found.groupBy("_key").agg(F.collect_list(F.struct("start", "n")).alias("_runs"))
    schema = df.select(key).schema
    for name, kind in zip(RESULT, (T.LongType(), T.LongType(), T.LongType(), T.StringType(), T.BinaryType())):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "_text"):
            out: list[tuple] = []
            for text_, own in zip(batch.column("_text").cast(pa.binary()).to_pylist(), batch.column("_runs").to_pylist()):
                stretches = [(r["start"], r["start"] + r["n"] + length - 1) for r in own or ()]
                kept, spans = without(text_, stretches)
                digest = hashlib.sha256(kept).hexdigest()
                out.append((len(text_), len(text_) - len(kept), spans, digest, kept))
            columns = [pa.array(c, k) for c, k in zip(zip(*out), RESULT_KINDS)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    return rows.join(runs, "_key", "left").select(key, "_text", "_runs").mapInArrow(run, schema)


RESULT = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
RESULT_KINDS = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
