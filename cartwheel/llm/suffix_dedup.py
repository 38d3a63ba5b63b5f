"""Operator 3: removal of repeated passages by suffix structures.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier,
in a smaller document or earlier in its own. Strings never cross documents.

Every window of ``LENGTH`` bytes has a fingerprint, the least hash of its
``GRAM``-byte strings, so equal windows share fingerprints. Neighbouring
windows with their least hash in the same place make one occurrence of that
fingerprint, with a 64-bit hash of its bytes, its context. Occurrences meet by
fingerprint; only repeated ones go on. An occurrence whose context occurred
earlier goes whole. Of each context the first occurrence remains, and where a
fingerprint has more contexts than one, their common windows are found on a
Burrows-Wheeler transform of the contexts: starting from the intervals that the
sort of the suffixes went by (strings of 56 bytes), all intervals are extended
backward, breadth first; the intervals of length l bound common prefixes of
length l - 1, so these come out by increasing value until ``LENGTH``, where the
search stops. What has no boundary by then shares
``LENGTH`` bytes, and all but its earliest window go.

A block of contexts holds whole fingerprints and about ``BLOCK_BYTES``. A
fingerprint of more than ``MAX_CONTEXTS`` contexts (a common line with different
surroundings) is refined: its windows are split by the place of the least hash
in them, and each part is keyed by the bytes that all windows of that part
share, more at each step, until the parts are small or single windows.

Defined results: null and empty texts have 0 bytes; null ids come after all
others, and rows with one id in the order of their texts' hashes; of repeated
rows (same id and text) one is judged and the others count as later copies; an
empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import Scratch, id_and_text, map_slices

LENGTH, GRAM = 100, 32
#: Bytes of contexts in a block, contexts of a fingerprint that one block takes.
BLOCK_BYTES, MAX_CONTEXTS = 1 << 20, 8000
#: Bytes of a text that are fingerprinted at once.
CHUNK = 1 << 18

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (1 << 64) - 1, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Hasher:
    """Polynomial hashes modulo 2**64 of any substring of a chunk."""

    def __init__(self, size: int = CHUNK + LENGTH):
        self.up, self.down = _powers(_BASE, size + 1), _powers(pow(_BASE, -1, 1 << 64), size + 1)

    def sums(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:len(data)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((sums[end] - sums[start]) * self.down[start] + (end - start).astype(np.uint64) * _GOLD)


_HASHER: list[Hasher] = []


def hasher() -> Hasher:
    if not _HASHER:
        _HASHER.append(Hasher())
    return _HASHER[0]


def occurrences(raw: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Fingerprint, context, first window and number of windows of each
    occurrence in a text; a long text's are cut at chunk borders."""
    out, tools, span = [], hasher(), length - gram + 1
    for at in range(0, len(raw) - length + 1, CHUNK):
        data = np.frombuffer(raw[at:at + CHUNK + length - 1], np.uint8)
        sums, n = tools.sums(data), len(data) - length + 1
        starts = np.arange(len(data) - gram + 1)
        g = tools.of(sums, starts, starts + gram)
        least, width = g, 1
        while 2 * width <= span:                            # sliding minimum by doubling
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[:n], least[span - width:span - width + n])
        # A new occurrence where the least hash changes or its leftmost place is left behind.
        new = np.ones(n, bool)
        new[1:] = (least[1:] != least[:-1]) | (g[:n - 1] == least[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], n)
        out.append((least[first], tools.of(sums, first, last + length - 1), first + at, last - first))
    if not out:
        return tuple(np.empty(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64))
    return tuple(np.concatenate(c) for c in zip(*out))


# -- Burrows-Wheeler transform and interval expansion ----------------------
def suffix_order(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the order of their first ``depth`` symbols or more, and
    the inverse, by prefix doubling."""
    return _sorted_suffixes(text, depth)[:2]


def _sorted_suffixes(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, int, np.ndarray]:
    """``suffix_order``, the most symbols below ``depth`` that a sort went by,
    and for each place whether these differ from those of the place before."""
    n = len(text)
    # As many symbols as a key of 63 bits holds; after that, ranks of two halves.
    top = int(text.max(initial=0)) + 1
    width = max(1, min(depth, 63 // top.bit_length()))
    key = np.zeros(n, np.int64)
    for k in range(width):
        key <<= top.bit_length()
        key[:max(n - k, 0)] += text[k:] + 1
    known, edges = 0, np.arange(n) == 0
    while True:
        order = np.argsort(key)                             # equal keys in any order
        key = key[order]
        step = np.zeros(n, np.int64)
        step[1:] = key[1:] != key[:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(step)
        if width < depth:                                   # later sorts only order what is equal here
            known, edges = width, step > 0
            edges[:1] = True
        if width >= depth or rank[order[-1]] == n - 1:
            break
        key = rank * (n + 1)
        key[:max(n - width, 0)] += rank[width:] + 1
        width *= 2
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    return order, place, known, edges


def common_prefix_groups(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose ``length`` symbols occur more than once without a 0, and
    a number for each such string; by backward extension of the intervals that
    the sort left."""
    n = len(text)
    order, place, known, edges = _sorted_suffixes(text, length + 1)
    zeros = np.flatnonzero(text == 0)
    after = n - 1 - zeros[-1] if len(zeros) else n          # a text that ends without a 0 goes on
    gaps = np.append(np.diff(zeros, prepend=-1), after)
    room = (np.repeat(np.append(zeros, n + length), gaps) - np.arange(n))[order]         # symbols before the next 0
    bwt = text[order - 1]                                   # the symbol before each suffix
    back = place[order - 1]                                 # where the suffix with that symbol in front is
    bwt[order == 0] = 0
    bounded = np.append(edges, True)                        # the common prefix before this suffix is known
    lows = np.flatnonzero(edges)
    highs = np.append(lows[1:], n)
    whole = room[lows] >= known                             # strings without a 0
    lows, highs = lows[whole], highs[whole]
    owner = np.full(n + 1, -1, np.int64)
    for _ in range(length - known):
        size = highs - lows
        rows = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lows, size)
        symbol = bwt[rows]
        real = symbol != 0
        to = back[rows[real]]
        owner[to] = (np.repeat(np.arange(len(size)), size)[real] << 9) + symbol[real]
        # Runs of neighbours with one owner: from the places in use where these are few, else from all.
        if len(to) < n // 8:
            used = np.sort(to)
            own = owner[used]
            first = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (used[1:] != used[:-1] + 1)][:len(used)])
            starts, ends = used[first], used[np.append(first[1:], len(used))[:len(first)] - 1] + 1
        else:
            change = np.flatnonzero(owner[1:] != owner[:-1]) + 1
            if owner[0] >= 0:
                change = np.concatenate(([0], change))
            starts = change[owner[change] >= 0]
            ends = change[np.searchsorted(change, starts) + 1]
        owner[to] = -1
        fresh = ~bounded[ends] | ~bounded[starts]           # a boundary not known by shorter strings
        bounded[ends[fresh]] = bounded[starts[fresh]] = True
        lows, highs = starts[fresh], ends[fresh]
        if not len(lows):
            break
    group = np.cumsum(bounded[:n])
    shared = (~bounded[:n] | ~bounded[1:]) & (room >= length)           # together with a neighbour
    return order[shared], group[shared]


def earlier_windows(contexts: list[bytes], rank: np.ndarray, start: np.ndarray, doc: np.ndarray,
                    length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Context and offset of each window that also starts earlier in another
    place: documents come by ``rank``, windows of one by position."""
    size = np.array([len(c) + 1 for c in contexts])
    text = np.frombuffer(b"".join(c + b"\0" for c in contexts), np.uint8).astype(np.int64) + 1
    edge = np.cumsum(size)
    text[edge - 1] = 0
    at, group = common_prefix_groups(text, length)
    owner = np.searchsorted(edge, at, "right")
    offset = at - (edge - size)[owner]
    order = np.lexsort((start[owner] + offset, rank[owner], group))
    group, owner, offset = group[order], owner[order], offset[order]
    first = np.ones(len(group), bool)
    first[1:] = group[1:] != group[:-1]
    # A window in two blocks or contexts may be the very same one: equal to the first is not earlier.
    head = np.flatnonzero(first)[np.cumsum(first) - 1]
    same = (doc[owner] == doc[owner[head]]) & (start[owner] + offset == start[owner[head]] + offset[head])
    return owner[~same], offset[~same]


# -- Spark -----------------------------------------------------------------
OCCURRENCE = "fp long, ctx long, key long, doc_id long, start long, n int"
RANGE = "key long, doc_id long, start long, n long"


def _occur(batch: pa.RecordBatch) -> pa.RecordBatch:
    keys, ids, columns = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
    for key, doc_id, text in zip(keys, ids, batch.column(2).to_pylist()):
        fp, ctx, start, n = occurrences(text.encode())
        columns.append((fp, ctx, start, n, key, doc_id))
    size = [len(c[0]) for c in columns]
    fp, ctx, start, n = (np.concatenate([c[k] for c in columns]) for k in range(4))
    return pa.RecordBatch.from_arrays([
        pa.array(fp.view(np.int64)), pa.array(ctx.view(np.int64)), pa.array(np.repeat(np.array(keys, np.int64), size)),
        pa.array([i for c, m in zip(columns, size) for i in [c[5]] * m], pa.int64()),
        pa.array(start), pa.array(n.astype(np.int32))], ["fp", "ctx", "key", "doc_id", "start", "n"])


PIECE = "fp long, ctx long, key long, doc_id long, start long, n int, bytes binary"


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64()] * 5 + [pa.int32(), pa.binary()]
    columns = list(zip(*rows)) or [[]] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                      [f.split()[0] for f in PIECE.split(", ")])


def _cut(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The bytes of a text's wanted contexts."""
    rows = []
    for text, key, doc_id, wanted in zip(*(c.to_pylist() for c in batch.columns)):
        raw = text.encode()
        rows += [(w["fp"], w["ctx"], key, doc_id, w["start"], w["n"], raw[w["start"]:w["start"] + w["n"] + LENGTH - 1]) for w in wanted]
    return _pieces(rows)


def refined(raw: bytes, depth: int) -> list[tuple[int, int, int, int]]:
    """Fingerprint, context, first window and number of windows of the parts
    of a context: its windows by the place of their least hash, in 2**depth
    ranges of places."""
    places, tools = LENGTH - GRAM + 1, hasher()
    sums = tools.sums(np.frombuffer(raw, np.uint8))
    starts = np.arange(places)
    at = int(tools.of(sums, starts, starts + GRAM).argmin())         # the same gram for all its windows
    cell = (at - np.arange(len(raw) - LENGTH + 1) << depth) // places
    edges = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1], True])
    out = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        c = int(cell[a])
        low, high = -(-c * places >> depth), (-(-(c + 1) * places >> depth)) - 1   # places of the range
        ends = np.array([at - low, a]), np.array([at + GRAM + places - 1 - high, b + LENGTH - 1])
        seed = np.array([c << 8 | depth, at - a], np.uint64) * _GOLD
        fp, ctx = _mix(tools.of(sums, *ends) + seed).view(np.int64).tolist()
        out.append((fp, ctx, a, b - a))
    return out


def _refine(depth: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for fp, _, key, doc_id, start, _, raw in zip(*(c.to_pylist() for c in batch.columns)):
            rows += [(fp ^ f, c, key, doc_id, start + a, n, raw[a:a + n + LENGTH - 1]) for f, c, a, n in refined(raw, depth)]
        return _pieces(rows)
    return run


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of windows to remove, from contexts sorted by block."""
    held: list[tuple] = []
    size = 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and row[0] != held[-1][0] and size >= BLOCK_BYTES:
                yield _ranges(held)
                held, size = [], 0
            held.append(row)
            size += len(row[4]) + 1
    if held:
        yield _ranges(held)


def _ranges(rows: list[tuple]) -> pa.RecordBatch:
    _, key, doc_id, start, contexts = zip(*rows)
    key, start = np.array(key, np.int64), np.array(start, np.int64)
    ids = np.array([0 if i is None else i for i in doc_id], np.int64)
    none = np.array([i is None for i in doc_id])
    order = np.lexsort((key, ids, none))
    rank = np.empty(len(rows), np.int64)
    new = np.ones(len(rows), bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (ids[order][1:] != ids[order][:-1]) | (none[order][1:] != none[order][:-1])
    rank[order] = np.cumsum(new)
    owner, offset = earlier_windows(list(contexts), rank, start, rank)
    order = np.lexsort((offset, owner))
    owner, offset = owner[order], offset[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (offset[1:] != offset[:-1] + 1)
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(owner)))
    return pa.RecordBatch.from_arrays([pa.array(key[owner[first]]), pa.array([doc_id[o] for o in owner[first]], pa.int64()),
                                       pa.array((start[owner] + offset)[first]), pa.array(n)], ["key", "doc_id", "start", "n"])


def merged(ranges: list[tuple[int, int]], length: int = LENGTH) -> list[tuple[int, int]]:
    """The bytes that ranges of windows (start, number) cover, as maximal spans."""
    out: list[tuple[int, int]] = []
    for start, n in sorted(ranges):
        end = start + n + length - 1
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _remove(batch: pa.RecordBatch) -> pa.RecordBatch:
    spans, kept, sizes = [], [], []
    for text, copy, ranges in zip(*(c.to_pylist() for c in batch.columns[1:])):
        raw = text.encode()
        if copy:
            cover = [(0, len(raw))] if len(raw) >= LENGTH else []
        else:
            cover = merged([(r["start"], r["n"]) for r in ranges or []])
        edges = [0, *(e for span in cover for e in span), len(raw)]
        kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
        spans.append([{"start": a, "end": b} for a, b in cover])
        sizes.append(len(raw))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, span),
                                       pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])


def _firsts(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Of each context the first occurrence, and how many contexts its
    fingerprint has: fp, ctx, key, doc_id, start, n, many."""
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key", "start")
    one = scratch.write(rows.groupBy("fp", "ctx").agg(F.min(place).alias("p"), F.max("n").alias("n"))
                        .select("fp", "ctx", "p.key", "p.doc_id", "p.start", "n"), "passage-firsts")
    many = one.groupBy("fp").agg(F.count("*").alias("many"))
    return scratch.write(one.join(many, "fp"), "passage-contexts")


def _later(rows: DataFrame, contexts: DataFrame) -> DataFrame:
    """Ranges of the occurrences that aren't their context's first."""
    first = contexts.select("fp", "ctx", F.col("doc_id").alias("d"), F.col("key").alias("k"), F.col("start").alias("s"))
    is_first = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")) & (F.col("start") == F.col("s"))
    return rows.join(first, ["fp", "ctx"]).where(~is_first).select("key", "doc_id", "start", F.col("n").cast("long").alias("n"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of ``docs``: doc_id, n_bytes (UTF-8), spans (the
    removed bytes) and kept (binary: the other bytes)."""
    scratch = Scratch(docs.sparkSession)
    texts = id_and_text(docs, id_col, text_col).withColumn("key", F.xxhash64("doc_id", "text"))
    own = ["key", "doc_id"]
    # Occurrences meet by fingerprint: counts are combined in the map tasks, and the rows of a fingerprint that
    # comes everywhere pass a semi-join, which splits such a key. Hashing twice is cheaper than keeping all rows.
    every = map_slices(texts.select("key", "doc_id", "text"), _occur, OCCURRENCE)
    times = every.select("fp").groupBy("fp").agg(F.count("*").alias("times"))
    repeated = scratch.write(times.where("times > 1").select("fp"), "passage-repeated")
    found = scratch.write(every.join(repeated, "fp", "left_semi"), "passage-occurrences")
    contexts = _firsts(found, scratch)
    parts = [scratch.write(_later(found, contexts), "passage-later")]
    scratch.drop(found, repeated)
    # The bytes of first occurrences whose fingerprint has several contexts.
    wanted = F.collect_list(F.struct("fp", "ctx", "start", "n")).alias("wanted")
    lists = contexts.where("many > 1").groupBy(own).agg(wanted).withColumnsRenamed({"key": "w_key", "doc_id": "w_id"})
    here = texts.join(lists.hint("shuffle_hash"), (F.col("key") == F.col("w_key")) & F.col("doc_id").eqNullSafe(F.col("w_id")))
    pieces = scratch.write(map_slices(here.select("text", *own, "wanted"), _cut, PIECE), "passage-pieces")
    for depth in range(1, LENGTH.bit_length() + 1):
        many = contexts.select("fp", "many").distinct()
        sized = pieces.join(many, "fp")
        block = sized.where((F.col("many") > 1) & (F.col("many") <= MAX_CONTEXTS)).select("fp", *own, "start", "bytes")
        parts.append(scratch.write(block.repartition("fp").sortWithinPartitions("fp").mapInArrow(_find, RANGE), "passage-found"))
        wide = sized.where(F.col("many") > MAX_CONTEXTS).select(pieces.columns)
        if not wide.take(1):
            break
        refined_ = scratch.write(map_slices(wide, _refine(depth), PIECE), "passage-refined")
        contexts = _firsts(refined_.drop("bytes"), scratch)
        parts.append(scratch.write(_later(refined_.drop("bytes"), contexts), "passage-later"))
        first = contexts.where("many > 1").select("fp", "ctx", *own, "start")
        pieces = scratch.write(refined_.join(first.withColumnsRenamed({"doc_id": "f_id"}), ["fp", "ctx", "key", "start"])
                               .where(F.col("doc_id").eqNullSafe(F.col("f_id"))).select(pieces.columns), "passage-pieces")
    some = parts[0]
    for part in parts[1:]:
        some = some.unionByName(part)
    ranges = some.groupBy(own).agg(F.collect_list(F.struct("start", "n")).alias("ranges"))
    # Repeated rows: all but one are later copies.
    times = texts.select(own).groupBy(own).agg(F.count("*").alias("times")).where("times > 1")
    marks = scratch.write(ranges.join(times, [ranges[c].eqNullSafe(times[c]) for c in own], "full").select(
        *(F.coalesce(ranges[c], times[c]).alias(f"m_{c}") for c in own), "ranges", "times"), "passage-marks")
    held = texts.join(marks.hint("shuffle_hash"), (texts.key == marks.m_key) & texts.doc_id.eqNullSafe(marks.m_doc_id), "left")
    one = held.where("times is null").withColumn("copy", F.lit(False))
    nth = F.row_number().over(Window.partitionBy(own).orderBy(F.lit(1)))
    repeats = held.where("times is not null").withColumn("copy", nth > 1)
    if not times.take(1):
        rows = one
    else:
        rows = one.unionByName(repeats)
    return map_slices(rows.select("doc_id", "text", "copy", "ranges"), _remove,
                      "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")
