"""Fill-in-the-middle transformation with content-defined chunks whose counts are remembered.

A document of n units is cut at two places that a hash of its id draws, and its three parts are written in another order between sentinels.
Units are code points or words. To find the byte at which unit k begins, the text's UTF-8 bytes are cut into chunks where a rolling hash
of the last 32 bytes has a given ending, so passages that documents share give the same chunks wherever they stand. A task
remembers a chunk's summary by its content (a dictionary compares the bytes themselves, so equal hashes of different chunks don't matter): how
many units begin inside, and what stands at its two boundaries. A summary doesn't depend on what comes before: if a unit goes on
across a boundary, combining takes one off. The running sum of the combined counts names the chunk in which a cut falls, and only that chunk is searched.

Texts pass through Python once, in Arrow batches, and nothing is shuffled. What is remembered is bounded by bytes; hashes are computed
over blocks of a long text.

Edge cases: null text is empty; empty texts and texts that hold a sentinel stay plain; a null id is hashed as the empty text; repeated rows
and equal ids are cut alike; very long texts are taken whole; an empty table gives no rows; equal draws give an empty middle; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm.common import table, text_batches

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes that the rolling hash sees; a chunk ends where its lowest bits are 0 (one place in 512), or after so many bytes.
WINDOW, BITS, LONGEST = 32, 9, 8192
#: Bytes of chunks that a task remembers, and the bytes of text that are hashed at once.
REMEMBERED, BLOCK = 64 << 20, 4 << 20

_FACTOR = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(5).integers(0, 2**64, 256, np.uint64, endpoint=False)
#: Which bytes begin or are part of a unit.
_STARTS = {"char": np.array([b & 0xC0 != 0x80 for b in range(256)]), "word": np.array([b not in b"\t\n\v\f\r " for b in range(256)])}


def rolling(data: np.ndarray) -> np.ndarray:
    """At each place the polynomial hash of the (up to) ``WINDOW`` bytes that end there, by doubling."""
    h, width = _BYTES[data], 1
    while width < WINDOW:
        power = np.uint64(pow(_FACTOR, width, 2**64))
        wider = h.copy()
        wider[width:] += h[:-width] * power
        h, width = wider, 2 * width
    return h


def chunk_ends(data: np.ndarray) -> np.ndarray:
    """Where the chunks of one text end; they depend on the bytes before each end only."""
    found, mask = [], np.uint64((1 << BITS) - 1)
    for at in range(0, len(data), BLOCK):
        low = max(0, at - WINDOW + 1)
        ends = np.flatnonzero((rolling(data[low : at + BLOCK]) >> np.uint64(32)) & mask == 0) + low + 1
        found.append(ends[(ends > at) & (ends >= WINDOW)])
    ends = np.union1d(np.concatenate(found), [len(data)]) if found else np.zeros(0, np.int64)
    gaps = np.diff(ends, prepend=0)
    if len(gaps) and gaps.max() > LONGEST:
        begins = ends - gaps
        ends = np.concatenate([np.append(np.arange(b + LONGEST, e, LONGEST), e) for b, e in zip(begins, ends, strict=True)])
    return ends


@dataclass(frozen=True)
class Summary:
    """Units that begin inside a chunk if none goes on from before, and whether its first and last bytes are in a unit."""

    count: int
    first: bool
    last: bool


class Counter:
    """Counts and places of units over chunks that are remembered by their content."""

    def __init__(self, unit: str = "char"):
        self.starts, self.words = _STARTS[unit], unit == "word"
        self.known: dict[bytes, Summary] = {}
        self.held = 0

    def begins(self, data: np.ndarray) -> np.ndarray:
        """Whether a unit begins at each byte, if none goes on from before."""
        there = self.starts[data]
        if self.words:  # the first byte of a word that doesn't go on
            there[1:] &= ~there[:-1]
        return there

    def summary(self, chunk: bytes) -> Summary:
        found = self.known.get(chunk)
        if found is None:
            data = np.frombuffer(chunk, np.uint8)
            found = Summary(int(self.begins(data).sum()), bool(self.starts[data[0]]), bool(self.starts[data[-1]]))
            if self.held > REMEMBERED:
                self.known.clear()
                self.held = 0
            self.known[chunk] = found
            self.held += len(chunk) + 200
        return found

    def index(self, text: bytes) -> Index:
        ends = chunk_ends(np.frombuffer(text, np.uint8)).tolist()
        counts, begin, last = [], 0, False
        for end in ends:
            s = self.summary(text[begin:end])
            counts.append(s.count - (self.words and last and s.first))  # a word that goes on across the boundary begins once
            begin, last = end, s.last
        return Index(self, text, ends, np.cumsum(counts, dtype=np.int64))


@dataclass
class Index:
    """A text's chunks with the running count of the units that begin in them."""

    counter: Counter
    text: bytes
    ends: list[int]
    upto: np.ndarray

    @property
    def n(self) -> int:
        return int(self.upto[-1]) if len(self.upto) else 0

    def place(self, unit: int) -> int:
        """The byte at which ``unit`` (from 0) begins; the text's end for the unit after the last."""
        if unit >= self.n:
            return len(self.text)
        if unit == 0:
            return 0  # what stands before the first unit belongs to it
        i = int(np.searchsorted(self.upto, unit, side="right"))
        begin = self.ends[i - 1] if i else 0
        data = np.frombuffer(self.text[max(0, begin - 1) : self.ends[i]], np.uint8)
        begins = np.flatnonzero(self.counter.begins(data)[min(begin, 1) :])
        return begin + int(begins[unit - (int(self.upto[i - 1]) if i else 0)])


def draws(doc_id: object, seed: str) -> list[int]:
    """Four numbers below 2^32 from the id."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(h[i : i + 8], 16) for i in range(0, 32, 8)]


def fill_in_middle(docs: DataFrame, seed: str = "1", rate: int = 90, spm_rate: int = 20, unit: str = "char") -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars (in units), output.

    ``rate`` percent of the documents are transformed, ``spm_rate`` percent of these with the suffix first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(unit)
        p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
        for batch in batches:
            out: list[tuple] = []
            for doc_id, cell in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                text = cell.as_buffer().to_pybytes() if cell.is_valid else b""
                index = counter.index(text)
                h = draws(doc_id, seed)
                if not text or p in text or s in text or m in text or h[2] % 100 >= rate:
                    out.append((index.n, "plain", None, None, text))
                    continue
                low, high = sorted((h[0] % (index.n + 1), h[1] % (index.n + 1)))
                a, b = index.place(low), index.place(high)
                first, middle, last = text[:a], text[a:b], text[b:]
                if h[3] % 100 < spm_rate:
                    out.append((index.n, "spm", low, high - low, b"".join((s, last, p, first, m, middle))))
                else:
                    out.append((index.n, "psm", low, high - low, b"".join((p, first, s, last, m, middle))))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
            made = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            made[-1] = made[-1].view(pa.string())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *made], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    text_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The exact text of an output: the sentinels stand once each, since texts that hold one stay plain."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    return F.when(form == "psm", F.concat(parts[1], parts[3], parts[2])).when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output)


def op13_chunk_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle(table(spark, sf_dir, "documents"))
    back = restored(F.col("output"), F.col("form"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


ORACLE = """WITH t AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
h AS (SELECT doc_id, t, length(t)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM t),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
 CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substring(t, 1, a) AS pre, substring(t, a + 1, b - a) AS mid, substring(t, b + 1) AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
 sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM p"""
