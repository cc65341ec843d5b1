"""Substring dedup by deep-shallow suffix sorting, distributed by minimisers.

A byte is removed if it lies in a ``window``-byte string that also starts anywhere else in any document (or the same).

1. Every window is named after its minimiser: the ``gram``-byte string in it with the smallest hash, the leftmost of equals.
   Windows that follow each other and share the minimiser's place form one run. Equal windows have equal minimisers at
   equal places, so only runs of one minimiser need to be compared. A run leaves its task as a few numbers.
2. Minimisers that occur once are dropped by a count. Runs whose bytes occur several times are wholly repeated.
3. For minimisers with different runs, one run of each content is fetched. All of these are suffixes to sort: from the
   minimiser to the right, and from it to the left. Deep-shallow sorting orders them: multikey quicksort on eight bytes
   at a time (three-way splits of all groups of a task at once) down to a shallow depth, then a blind trie for each group that still agrees. It leaves common-prefix
   lengths, and a window that reaches ``d`` bytes left is repeated if another run agrees with it ``d`` bytes to the left
   and ``window - d`` to the right.
4. A minimiser with very many different runs is sorted in blocks of about ``block`` runs (some 400 bytes each, so a task holds a few
   megabytes); only where it has several blocks, what these can't settle alone is counted by the windows' digests with map-side combining.
5. Repeated runs come together by document; their union is cut.

Documents are identified by 128 bits of their text, so that copies share one entry, whatever their number.

Edge cases: null text is empty; texts shorter than the window lose nothing; long texts are hashed in overlapping pieces of a million windows (a run
that goes on in the next piece is two runs, of different windows, which can't be taken for each other's copies); repeated rows and copies are other places,
so both are removed; matches never cross documents; an empty table gives no rows; a null doc_id is passed through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm.common import keep, table, text_batches, text_key

#: Bytes that are hashed at once, and the bytes in which a piece of a long text has its windows.
CHUNK, LONG = 400_000, 1_000_000
BATCH = 5_000
SHALLOW = 32


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes (a power of two) from each place, by doubling."""
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    step = 1
    while step < gram:
        h = h[:-step] * np.uint64(0xD6E8FEB86659FD93 + 2 * step) + (h[step:] ^ (h[step:] >> np.uint64(32)))
        h ^= h >> np.uint64(29)
        step *= 2
    return h * np.uint64(0xBF58476D1CE4E5B9)


def runs_of(data: np.ndarray, doc_starts: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, windows, minimiser's offset, minimiser's hash) of the runs in concatenated documents."""
    none = np.zeros(0, np.int64)
    if len(data) < window:
        return none, none, none, none.astype(np.uint64)
    h = gram_hashes(data, gram)
    wide = window - gram + 1
    # a hash keeps all bits but those that hold a place inside a block of ``wide``: the choice is the same in every chunk
    low = (np.uint64(1) << np.uint64(int(wide).bit_length())) - np.uint64(1)
    ranked = (h & ~low) | (np.arange(len(h), dtype=np.uint64) % np.uint64(wide))
    padded = np.full(-(-len(ranked) // wide) * wide, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(ranked)] = ranked
    blocks = padded.reshape(-1, wide)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(data) - window + 1
    # a window covers the end of its block and the start of the next one; of equal hashes the left one counts
    near, far = behind[:count], ahead[wide - 1 : wide - 1 + count]
    begin = np.arange(count) // wide * wide
    place = np.where((near & ~low) <= (far & ~low), begin + (near & low).astype(np.int64), np.arange(wide - 1, wide - 1 + count) // wide * wide + (far & low).astype(np.int64))
    inside = np.zeros(count + 1, bool)
    ends = np.append(doc_starts[1:], len(data))
    for a, b in zip(doc_starts.tolist(), (ends - window + 1).tolist(), strict=True):
        if b > a:
            inside[a:b] = True
    fresh = inside[:count].copy()
    fresh[1:] &= ~inside[: count - 1] | (place[1:] != place[:-1])
    starts = np.flatnonzero(fresh)
    stops = fresh.copy()
    stops[:-1] = inside[: count - 1] & (fresh[1:] | ~inside[1:count])
    stops[-1] = inside[count - 1]
    last = np.flatnonzero(stops)
    at = place[starts]
    return starts, last - starts + 1, at - starts, h[at]


def agree(a: bytes, b: bytes, low: int) -> int:
    """Length of the common prefix; the first ``low`` bytes are known to agree."""
    high = min(len(a), len(b))
    if a[low:high] == b[low:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def _byte(s: bytes, depth: int) -> int:
    return s[depth] if depth < len(s) else -1


def blind_trie(group: list[int], strings: list[bytes], depth: int) -> tuple[list[int], list[int]]:
    """Sorted order of ``group`` and common-prefix lengths with the one before (the first: ``depth``).

    Inner nodes hold only a depth and the branching bytes. A string descends by those bytes, skipping the rest, is
    compared once with the leaf that it reaches, and goes in where the two part.
    """
    root: list = [group[0]]  # a leaf is a list of equal strings, an inner node a tuple (depth, children)
    holder: list = [root]
    for i in group[1:]:
        s = strings[i]
        node, path = holder[0], []
        while isinstance(node, tuple):
            path.append(node)
            child = node[1].get(_byte(s, node[0]))
            node = child if child is not None else next(iter(node[1].values()))
        other = strings[node[0]]
        same = agree(s, other, depth)
        if same == len(s) == len(other):
            node.append(i)
            continue
        parent, below = None, holder[0]
        for node in path:
            if node[0] >= same:
                break
            parent, below = node, node[1].get(_byte(s, node[0]))
        if isinstance(below, tuple) and below[0] == same:
            below[1][_byte(s, same)] = [i]
            continue
        split = (same, {_byte(other, same): below, _byte(s, same): [i]})
        if parent is None:
            holder[0] = split
        else:
            parent[1][_byte(s, parent[0])] = split
    order: list[int] = []
    common: list[int] = []
    stack: list = [(holder[0], depth)]
    while stack:
        node, shared = stack.pop()
        if isinstance(node, tuple):
            children = sorted(node[1].items(), reverse=True)
            for k, (_, child) in enumerate(children):
                stack.append((child, node[0] if k < len(children) - 1 else shared))
        else:
            for k, i in enumerate(node):
                order.append(i)
                common.append(shared if k == 0 else len(strings[i]))
    return order, common


def multikey_quicksort(order: np.ndarray, group: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorts the places of ``order`` inside each ``group`` by rows of ``words``, in place; returns the depth (in words) at which each place
    parts from the one before it (the number of columns where it doesn't, or where a new group begins) and the final groups.

    Multikey quicksort on all segments at once: each takes the median of three of its words at its depth as pivot and is split into
    smaller, equal and larger ones by counting; the equal ones go on at the next depth, the others at the same. Segments of one
    place, or that have used up the words, rest.
    """
    n, depths = words.shape
    parts_at = np.full(n, depths, np.int64)
    depth = np.zeros(n, np.int64)  # of the segment of each place
    segment = group.copy()  # the number of each place's segment, rising
    live = np.arange(n)
    while len(live):
        seg = segment[live]
        fresh = np.r_[True, seg[1:] != seg[:-1]]
        first = np.flatnonzero(fresh)
        size = np.diff(np.append(first, len(live)))
        of = np.repeat(np.arange(len(first)), size)
        many = size[of] > 1
        if not many.all():
            live = live[many]
            continue
        value = words[order[live], depth[live]]
        pivot = np.sort(np.stack([value[first], value[first + size // 2], value[first + size - 1]]), axis=0)[1]
        side = (value > pivot[of]).astype(np.int64) + (value >= pivot[of])  # 0 smaller, 1 equal, 2 larger
        counts = np.stack([np.bincount(of[side == k], minlength=len(first)) for k in range(3)], axis=1)
        begins = first[:, None] + np.concatenate([np.zeros((len(first), 1), np.int64), np.cumsum(counts, axis=1)[:, :2]], axis=1)
        target = np.empty(len(live), np.int64)
        for k in range(3):  # a place goes behind those of its side that stood before it
            mine = np.flatnonzero(side == k)
            rank = np.arange(len(mine)) - np.repeat(np.cumsum(counts[:, k]) - counts[:, k], counts[:, k])
            target[mine] = begins[of[mine], k] + rank
        moved, moved_side = np.empty_like(live), np.empty_like(side)
        moved[target], moved_side[target] = order[live], side
        order[live] = moved
        edge = np.flatnonzero((moved_side[1:] != moved_side[:-1]) & (of[1:] == of[:-1])) + 1
        parts_at[live[edge]] = depth[live[edge]]
        step = np.zeros(n, np.int64)
        step[live[edge]] = 1
        segment = segment + np.cumsum(step)
        depth[live[moved_side == 1]] += 1
        live = live[depth[live] < depths]
    return parts_at, segment


def deep_shallow(keys: np.ndarray, strings: list[bytes], shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of ``strings`` within equal ``keys``, and the common-prefix length with the one before (-1: another key).

    Multikey quicksort on eight bytes at a time down to ``shallow`` bytes, then a blind trie for each group that still agrees.
    """
    n = len(strings)
    words = np.frombuffer(b"".join(s[:shallow].ljust(shallow, b"\0") for s in strings), ">u8").astype(np.uint64).reshape(n, shallow // 8)
    order = np.argsort(keys, kind="stable")
    group = np.zeros(n, np.int64)  # of each place in the order
    group[1:] = np.cumsum(keys[order][1:] != keys[order][:-1])
    new_key = np.diff(group, prepend=-1) > 0
    parts_at, group = multikey_quicksort(order, group, words)
    exact = np.where(new_key, -1, np.minimum(8 * parts_at, shallow))
    for p in np.flatnonzero((exact >= 0) & (exact < shallow)):  # the word says where they part at the earliest
        exact[p] = agree(strings[order[p - 1]], strings[order[p]], int(exact[p]))
    edges = np.flatnonzero(np.diff(group, prepend=-1, append=-1))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if b - a > 1:
            sorted_group, lengths = blind_trie(order[a:b].tolist(), strings, 0)
            order[a:b] = sorted_group
            exact[a + 1 : b] = lengths[1:]
    return order, exact


def repeated_windows(keys: np.ndarray, offsets: np.ndarray, counts: np.ndarray, strings: list[bytes], window: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For each reach ``d`` to the left: the runs that have such a window, and a class number each (equal windows, equal classes)."""
    right_order, right = deep_shallow(keys, [s[o:] for s, o in zip(strings, offsets.tolist(), strict=True)])
    left_order, left = deep_shallow(keys, [s[:o][::-1] for s, o in zip(strings, offsets.tolist(), strict=True)])
    n = len(strings)
    out = []
    right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for d in range(int((offsets - counts + 1).min()), int(offsets.max()) + 1):
        have = np.flatnonzero((offsets >= d) & (offsets - counts + 1 <= d))
        if len(have):
            right_class[right_order] = np.cumsum(right < window - d)
            left_class[left_order] = np.cumsum(left < d)
            out.append((d, have, right_class[have] * (n + 1) + left_class[have]))
    return out


def scan_runs(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """id (of the text), start, windows, offset, key, content of every run of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: list[bytes] = []
            rows: list[int] = []
            places: list[int] = []  # where in its text each piece begins
            size = 0

            def scan(batch=batch, texts=texts, rows=rows, places=places) -> pa.RecordBatch:
                joined = b"".join(texts)
                begins = np.cumsum([0, *map(len, texts[:-1])])
                starts, counts, offsets, keys = runs_of(np.frombuffer(joined, np.uint8), begins, window, gram)
                view = memoryview(joined)
                content = np.fromiter((xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(starts.tolist(), (starts + counts + window - 1).tolist(), strict=True)), np.uint64, len(starts))
                piece = np.searchsorted(begins, starts, side="right") - 1
                out = [batch["id"].take(pa.array(np.array(rows)[piece])), pa.array(starts - begins[piece] + np.array(places)[piece]), pa.array(counts.astype(np.int32)), pa.array(offsets.astype(np.int32)), pa.array(keys.view(np.int64)), pa.array(content.view(np.int64))]
                texts.clear()
                rows.clear()
                places.clear()
                return pa.RecordBatch.from_arrays(out, names=["id", "start", "windows", "offset", "key", "content"])

            for i, t in enumerate(batch["text"]):
                raw = t.as_buffer()
                if raw is None or raw.size < window:
                    continue
                for at in range(0, raw.size - window + 1, LONG):  # the windows that begin in LONG bytes
                    texts.append(raw.slice(at, min(LONG + window - 1, raw.size - at)).to_pybytes())
                    rows.append(i)
                    places.append(at)
                    size += len(texts[-1])
                    if size >= CHUNK:
                        yield scan()
                        size = 0
            if texts:
                yield scan()

    text_batches(docs.sparkSession)
    return docs.select(text_key("text").alias("id"), "text").mapInArrow(run, "id binary, start long, windows int, offset int, key long, content long")


def _fetch(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """Bytes of the runs in ``wanted`` (id, start, windows, ...), each once."""
    by_text = wanted.groupBy("id").agg(F.collect_list(F.struct("start", "windows", "offset", "key", "block", "blocks", "single")).alias("runs")).withColumnRenamed("id", "__id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[dict] = []
            for id_, text, runs in zip(batch["id"], batch["text"], batch["runs"].to_pylist(), strict=True):
                raw = text.as_buffer().to_pybytes()
                out += [r | {"id": id_.as_py(), "bytes": raw[r["start"] : r["start"] + r["windows"] + window - 1]} for r in runs]
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    schema = pa.schema([("id", pa.binary()), ("start", pa.int64()), ("windows", pa.int32()), ("offset", pa.int32()), ("key", pa.int64()), ("block", pa.int32()), ("blocks", pa.int32()), ("single", pa.bool_()), ("bytes", pa.binary())])
    texts = docs.select(text_key("text").alias("id"), "text").join(by_text, F.col("id") == F.col("__id")).select("id", "text", "runs")
    return texts.mapInArrow(run, "id binary, start long, windows int, offset int, key long, block int, blocks int, single boolean, bytes binary").dropDuplicates(["id", "start"])


def _sort_blocks(members: DataFrame, window: int) -> DataFrame:
    """Windows of single runs: id, start, windows, settled (repeated inside the block), several, h1, h2, n.

    Settled ones are ranges of window starts. For minimisers of several blocks, each window that isn't settled comes alone, with its digest
    and a number of places (2 for one whose content is known to occur several times).
    A task works through its sorted rows a few groups at a time; it never holds more than BATCH rows and one block.
    """

    def one(got: pa.Table) -> Iterator[pa.RecordBatch]:
        _, keys = np.unique(np.stack([got["key"].to_numpy(), got["block"].to_numpy().astype(np.int64)], axis=1), axis=0, return_inverse=True)
        offsets, counts, start = got["offset"].to_numpy().astype(np.int64), got["windows"].to_numpy().astype(np.int64), got["start"].to_numpy()
        strings, single, several = got["bytes"].to_pylist(), got["single"].to_numpy(zero_copy_only=False), got["blocks"].to_numpy() > 1
        ids = got["id"].combine_chunks()
        hit_run, hit_begin = [], []
        for d, have, classes in repeated_windows(keys.ravel(), offsets, counts, strings, window):
            _, first, same, many = np.unique(classes, return_index=True, return_inverse=True, return_counts=True)
            again = many[same] > 1
            settled = have[again & single[have]]
            hit_run.append(settled)
            hit_begin.append(offsets[settled] - d)
            show = first[several[have[first]]]  # one of each class stands for it in the other blocks
            at = have[show]
            if len(at):
                begin = offsets[at] - d
                digests = b"".join(xxhash.xxh3_128_digest(strings[i][b : b + window]) for i, b in zip(at.tolist(), begin.tolist(), strict=True))
                halves = np.frombuffer(digests, ">i8").astype(np.int64).reshape(-1, 2)
                done, twice = again[show] & single[at], again[show] | ~single[at]
                yield batch_of(ids.take(pa.array(at)), start[at] + begin, np.ones(len(at)), done, np.ones(len(at), bool), halves[:, 0], halves[:, 1], np.where(twice, 2, 1))
        run, begin = np.concatenate(hit_run or [np.zeros(0, np.int64)]), np.concatenate(hit_begin or [np.zeros(0, np.int64)])
        if len(run):  # windows that follow each other become one range
            by = np.lexsort((begin, run))
            run, begin = run[by], begin[by]
            fresh = np.flatnonzero(np.r_[True, (run[1:] != run[:-1]) | (begin[1:] != begin[:-1] + 1)])
            long, zero = np.diff(np.append(fresh, len(run))), np.zeros(len(fresh), np.int64)
            yield batch_of(ids.take(pa.array(run[fresh])), start[run[fresh]] + begin[fresh], long, zero == 0, zero != 0, zero, zero, zero)

    def batch_of(ids, start, windows, settled, several, h1, h2, n) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(start, pa.int64()), pa.array(windows.astype(np.int32)), pa.array(settled), pa.array(several), pa.array(h1), pa.array(h2), pa.array(np.asarray(n).astype(np.int32))], names=["id", "start", "windows", "settled", "several", "h1", "h2", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:  # sorted by key and block
            held.append(batch)
            rows += batch.num_rows
            if rows >= BATCH:
                got = pa.Table.from_batches(held, schema=schema)
                key, block = got["key"].to_numpy(), got["block"].to_numpy()
                ends = np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1]))
                if len(ends):  # all but the last group are whole
                    cut = int(ends[-1]) + 1
                    yield from one(got.slice(0, cut))
                    got = got.slice(cut)
                held, rows = got.combine_chunks().to_batches(), len(got)
        if rows:
            yield from one(pa.Table.from_batches(held, schema=schema))

    schema = pa.schema([("key", pa.int64()), ("block", pa.int32()), ("blocks", pa.int32()), ("offset", pa.int32()), ("windows", pa.int32()), ("start", pa.int64()), ("single", pa.bool_()), ("id", pa.binary()), ("bytes", pa.binary())])
    dealt = members.select(*schema.names).repartition("key", "block").sortWithinPartitions("key", "block")
    return dealt.mapInArrow(run, "id binary, start long, windows int, settled boolean, several boolean, h1 long, h2 long, n int")


def repeated_ranges(docs: DataFrame, window: int = 200, gram: int = 32, block: int = 20_000) -> DataFrame:
    """id, start, windows: ranges of window starts that are repeated, for the texts of ``docs`` (text)."""
    runs = keep(scan_runs(docs, window, gram), "suffix-runs")
    per_key = runs.groupBy("key").agg(F.count("*").alias("n"), F.min("content").alias("least"), F.max("content").alias("most")).where("n > 1")
    per_key = keep(per_key.select(F.col("key").alias("__key"), (F.col("least") != F.col("most")).alias("mixed")), "suffix-keys")
    hits = keep(runs.join(per_key, F.col("key") == F.col("__key")).drop("__key"), "suffix-hits")
    whole = hits.where(~F.col("mixed")).select("id", "start", "windows")
    per_content = hits.where("mixed").groupBy("key", "content").agg(
        F.count("*").alias("n"), F.min(F.struct("id", "start", "windows", "offset")).alias("r")
    )
    per_content = keep(per_content.select("key", "content", "n", "r.*"), "suffix-contents")
    several = keep(per_content.where("n > 1").select(F.col("key").alias("__key"), F.col("content").alias("__content")), "suffix-several")
    whole = whole.unionAll(hits.where("mixed").join(several, (F.col("key") == F.col("__key")) & (F.col("content") == F.col("__content"))).select("id", "start", "windows"))
    blocks = keep(per_content.groupBy("key").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")).withColumnRenamed("key", "__key"), "suffix-blocks")
    wanted = per_content.join(blocks, F.col("key") == F.col("__key")).withColumns({"block": F.pmod(F.xxhash64("content"), F.col("blocks")).cast("int"), "single": F.col("n") == 1})
    members = keep(_fetch(docs, wanted.select("id", "start", "windows", "offset", "key", "block", "blocks", "single"), window), "suffix-members")
    windows = keep(_sort_blocks(members, window), "suffix-windows")
    parts = windows.where("settled").select("id", "start", "windows")
    across = windows.where("several").groupBy("h1", "h2").agg(F.sum("n").alias("n")).where("n > 1")
    across = keep(across.select(F.col("h1").alias("__h1"), F.col("h2").alias("__h2")), "suffix-across")
    open_ = windows.where(F.col("several") & ~F.col("settled") & (F.col("n") == 1))
    found = open_.join(across, (F.col("h1") == F.col("__h1")) & (F.col("h2") == F.col("__h2"))).select("id", "start", "windows")
    return whole.unionAll(parts).unionAll(found).groupBy("id", "start").agg(F.max("windows").alias("windows"))


def cut(raw: bytes, ranges: list[tuple[int, int]], window: int) -> tuple[bytes, int, int]:
    """(remaining bytes, bytes removed, maximal removed runs) for ranges (first window start, windows)."""
    edge = np.zeros(len(raw) + 1, np.int32)
    for start, count in ranges:
        edge[start] += 1
        edge[start + count + window - 1] -= 1
    gone = np.cumsum(edge[:-1]) > 0
    left = np.frombuffer(raw, np.uint8)[~gone].tobytes()
    return left, int(gone.sum()), int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())


def dedup_substrings(docs: DataFrame, window: int = 200, keep_text: bool = False) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept (the remaining bytes)."""
    ranges = repeated_ranges(docs.select("text"), window)
    by_text = ranges.groupBy("id").agg(F.collect_list(F.struct("start", "windows")).alias("ranges")).withColumnRenamed("id", "__id")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("id", text_key("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text, found in zip(batch["text"], batch["ranges"].to_pylist(), strict=True):
                raw = text.as_buffer().to_pybytes()
                left, removed, spans = cut(raw, [(r["start"], r["windows"]) for r in found], window) if found else (raw, 0, 0)
                out.append((len(raw), removed, spans, hashlib.sha256(left).hexdigest(), left if keep_text else None))
            columns = list(zip(*out, strict=True)) or [()] * 5
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *arrays], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    joined = rows.join(by_text, F.col("id") == F.col("__id"), "left").select("doc_id", "text", "ranges")
    out = joined.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out if keep_text else out.drop("kept")


def op9_deep_shallow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
