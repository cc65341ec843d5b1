"""Best-fit packing by a grouping genetic algorithm on islands.

Texts are tokenised and cut: a document of more than ``length`` tokens gives pieces of ``length`` tokens, the first one
shorter if the count doesn't divide; every full piece is a sequence. The shorter pieces are packed. They are dealt into
problems of about ``problem`` pieces by a hash, and each problem is worked on by ``islands`` islands. An individual is a
packing (groups of pieces). Crossover takes well-filled whole bins of one parent, adds those bins of the other that hold
none of the same pieces, and puts the displaced pieces back by best fit, largest first. After each of ``epochs`` rounds
an island's best packing moves to the next island of its problem (a Spark shuffle on (problem, island)); at the end the
best of all islands stays. Bins filled to ``settled`` of the length are then final; the pieces of the others are dealt
anew into fewer problems until one is left, so the waste doesn't grow with the number of problems.

A task holds one problem at a time, of bounded size whatever the input. Texts pass through the tokeniser once; from then
on only piece lengths move.

Token ids are those of the public byte-level vocabulary without added tokens, then the end id 2. Texts in plain Latin
script, punctuation and blanks go through the faster of two libraries that read this vocabulary, all others, and any
that spell a special token, through the other; on the former they give the same ids.

Edge cases: null text is empty (the end id alone); repeated rows and equal ids are documents of their own; very long
texts are tokenised whole; of islands with equally good packings the one of the smaller number stays; an empty table gives no rows; other
columns are left out.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybook.llm.common import keep, table, text_batches

END = 2
_PLAIN = re.compile("[\t\n\r -~¡-¬®-ɏ‘-„]*")


class Ids:
    """Texts to id arrays."""

    def __init__(self, json_path: str, rank_path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.any = Tokenizer.from_file(json_path)
        self.special = [str(t) for t in self.any.get_added_tokens_decoder().values()]
        with open(rank_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.plain = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if _PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            return np.frombuffer(self.plain.encode_to_numpy(text).tobytes(), np.uint32)
        return np.array(self.any.encode(text, add_special_tokens=False).ids, np.uint32)


def pieces(docs: DataFrame, length: int = 1024, tokenizer: str = "byte_bpe_50k") -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, piece, start, length, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        ids_of = Ids(public_tokenizers.path(f"{tokenizer}.json"), public_tokenizers.path(f"{tokenizer}.tiktoken"), public_tokenizers.PATTERN)
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids = np.append(ids_of(text.as_py() or ""), np.uint32(END)).astype("<u4")
                cut = len(ids) % length or length
                edges = [0, *range(min(cut, len(ids)), len(ids) + 1, length)]
                raw = memoryview(ids.tobytes())
                out += [(doc_id, i, a, b - a, zlib.crc32(raw[4 * a : 4 * b])) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
            columns = list(zip(*out, strict=True)) or [()] * 5
            types = [batch.schema.field("doc_id").type, pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    text_batches(docs.sparkSession)
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


@dataclass
class Packing:
    """Each piece's bin, and how much of each bin is used."""

    bin_of: np.ndarray
    used: np.ndarray

    def fitness(self, length: int) -> tuple[int, float]:
        """Fewer bins first, then fuller ones (mean square fill)."""
        return -len(self.used), float(((self.used / length) ** 2).sum())


def best_fit(order: np.ndarray, sizes: np.ndarray, length: int, start: Packing | None = None) -> Packing:
    """``start`` with the pieces ``order`` put in one by one, each into the bin that it leaves the least room in.

    A bit per amount of free room tells which amounts there are, so the tightest bin is found by a bit scan.
    """
    bin_of = np.full(len(sizes), -1) if start is None else start.bin_of.copy()
    used = [] if start is None else start.used.tolist()
    rooms: list[list[int]] = [[] for _ in range(length + 1)]
    mask = 0
    for b, u in enumerate(used):
        rooms[length - u].append(b)
    for room, there in enumerate(rooms):
        if there:
            mask |= 1 << room
    into = []
    for size in sizes[order].tolist():
        fits = mask >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                mask ^= 1 << room
            used[b] += size
        else:
            b, room = len(used), length
            used.append(size)
        rooms[room - size].append(b)
        mask |= 1 << (room - size)
        into.append(b)
    bin_of[order] = into
    return Packing(bin_of, np.array(used, np.int64))


def crossover(mine: Packing, other: Packing, sizes: np.ndarray, length: int, rng: np.random.Generator) -> Packing:
    """Injects well-filled bins of ``other`` into ``mine``, drops bins that would double a piece, best-fits what they held."""
    chosen = (other.used >= np.quantile(other.used, 0.5)) & (rng.random(len(other.used)) < 0.5)
    taken = chosen[other.bin_of]
    whole = np.ones(len(mine.used), bool)
    whole[mine.bin_of[taken]] = False
    whole &= (mine.used >= 0.9 * length) | (rng.random(len(mine.used)) >= 0.5)  # mutation: ill-filled bins are opened again
    stays = whole[mine.bin_of] & ~taken
    bin_of = np.full(len(sizes), -1)
    bin_of[taken] = (np.cumsum(chosen) - 1)[other.bin_of[taken]]
    bin_of[stays] = chosen.sum() + (np.cumsum(whole) - 1)[mine.bin_of[stays]]
    displaced = np.flatnonzero(bin_of < 0)
    falling = displaced[np.argsort(-sizes[displaced], kind="stable")]
    return best_fit(falling, sizes, length, Packing(bin_of, np.concatenate([other.used[chosen], mine.used[whole]])))


def evolve(sizes: np.ndarray, length: int, seed: Packing | None, population: int, generations: int, rng: np.random.Generator) -> Packing:
    """The best packing after ``generations`` crossovers; a packing at the lower bound ends it."""
    bound = -(-int(sizes.sum()) // length)
    people = [seed or best_fit(np.argsort(-sizes, kind="stable"), sizes, length)]
    if len(people[0].used) <= bound:
        return people[0]
    while len(people) < population:
        jitter = sizes * (1 + 0.3 * rng.random(len(sizes)))
        people.append(best_fit(np.argsort(-jitter), sizes, length))
    scored = sorted(((p.fitness(length), k, p) for k, p in enumerate(people)), key=lambda x: x[:2], reverse=True)
    for g in range(generations):
        if -scored[0][0][0] <= bound:
            break
        i, j = rng.choice(len(scored), 2, replace=False)
        child = crossover(scored[i][2], scored[j][2], sizes, length, rng)
        scored[-1] = (child.fitness(length), population + g, child)
        scored.sort(key=lambda x: x[:2], reverse=True)
    return scored[0][2]


def _pack_round(items: DataFrame, problems: int, length: int, islands: int, epochs: int, population: int, generations: int, round_no: int) -> DataFrame:
    """``items`` (uid, length) -> uid, length, bin (unique in the round), fill."""
    dealt = items.withColumn("problem", F.pmod(F.xxhash64("uid", F.lit(round_no)), F.lit(problems)))
    dealt = keep(dealt.select("problem", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), "uid", "length", F.lit(-1).cast("long").alias("elite")), "pack-dealt")

    def make(epoch: int):
        def island(pdf: pd.DataFrame) -> pd.DataFrame:
            """Rows of one island: its pieces, each with its bin in the packing that came in (-1: none)."""
            pdf = pdf.sort_values("uid", kind="stable").reset_index(drop=True)
            sizes, problem, number = pdf["length"].to_numpy(), int(pdf["problem"].iloc[0]), int(pdf["island"].iloc[0])
            elite = pdf["elite"].to_numpy()
            seed = None if (elite < 0).any() else Packing(elite, np.bincount(elite, sizes).astype(np.int64))
            rng = np.random.default_rng([problem, number, epoch, round_no])
            best = evolve(sizes, length, seed, population, generations, rng)
            return pdf.assign(elite=best.bin_of, bins=len(best.used), square=best.fitness(length)[1])

        return island

    schema = "problem long, island int, uid long, length long, elite long, bins int, square double"
    for epoch in range(epochs):
        done = keep(dealt.groupBy("problem", "island").applyInPandas(make(epoch), schema), "pack-elites")
        moved = done.withColumn("island", (F.col("island") + 1) % islands)  # the elites travel round the ring
        dealt = moved.select("problem", F.col("island").cast("int").alias("island"), "uid", "length", F.col("elite").cast("long").alias("elite"))
    ranks = done.groupBy("problem").agg(F.min(F.struct(F.col("bins"), -F.col("square"), F.col("island"))).alias("top"))
    ranks = ranks.select(F.col("problem").alias("__p"), F.col("top.island").alias("__i"))
    best = done.join(ranks, (F.col("problem") == F.col("__p")) & (F.col("island") == F.col("__i")))
    best = best.select("uid", "length", (F.col("problem") * 1_000_000 + F.col("elite")).alias("bin"))
    fills = best.groupBy("bin").agg(F.sum("length").alias("fill")).withColumnRenamed("bin", "__bin")
    return keep(best.join(fills, F.col("bin") == F.col("__bin")).drop("__bin"), "pack-best")


def pack(cut: DataFrame, length: int = 1024, problem: int = 2000, islands: int = 3, epochs: int = 2, population: int = 4, generations: int = 12, settled: float = 0.995) -> DataFrame:
    """``cut`` (length and others, each row at most ``length`` long) with sequence_id and offset."""
    cut = keep(cut.withColumn("__uid", F.monotonically_increasing_id()), "pack-pieces")
    full = cut.where(F.col("length") == length).withColumns({"sequence_id": -1 - F.col("__uid"), "offset": F.lit(0).cast("long")})
    left = cut.where(F.col("length") < length).select(F.col("__uid").alias("uid"), "length")
    placed, round_no = [], 0
    while True:
        problems = max(1, round(left.count() / problem))
        packed = _pack_round(left, problems, length, islands, epochs, population, generations, round_no)
        final = packed if problems == 1 else packed.where(F.col("fill") >= settled * length)
        placed.append(final.select("uid", "length", (F.lit(round_no) * (1 << 52) + F.col("bin")).alias("sequence_id")))
        if problems == 1:
            break
        rest = packed.where(F.col("fill") < settled * length).select("uid", "length")
        if rest.count() > 0.7 * problems * problem:  # few bins are full: go on with the fullest that there are
            settled *= 0.98
        left, round_no = rest, round_no + 1
    seats = placed[0]
    for p in placed[1:]:
        seats = seats.unionAll(p)
    inside = Window.partitionBy("sequence_id").orderBy("uid").rowsBetween(Window.unboundedPreceding, -1)  # at most ``length`` rows
    seats = seats.select(F.col("uid").alias("__seat"), "sequence_id", F.coalesce(F.sum("length").over(inside), F.lit(0)).alias("offset"))
    some = cut.where(F.col("length") < length).join(seats, F.col("__uid") == F.col("__seat")).drop("__seat")
    return full.unionByName(some).drop("__uid")


def pack_documents(docs: DataFrame, length: int = 1024, tokenizer: str = "byte_bpe_50k", **options) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of all pieces of ``docs`` (doc_id, text)."""
    return pack(pieces(docs, length, tokenizer), length, **options)


def op8_island_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
