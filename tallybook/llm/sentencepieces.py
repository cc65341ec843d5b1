"""SentencePiece encoding and decoding with merge-type (BPE) vocabularies.

A text is normalised, its characters are symbols, and an agenda holds every adjacent pair whose joined text is a piece: the pair of the
highest score is merged first, of equal scores the leftmost, until no pair is left. Symbols that are no piece become their UTF-8
bytes (or the unknown id). Merges never reach across a place where two characters meet that stand side by side in no
piece, so a text is cut there; each stretch (a word, as a rule) has an agenda of its own, and the ids of stretches that were seen before
come from a table of bounded size in the task.

Each Arrow batch is checked against the sentencepiece library: rows where ids or the decoded text differ get the library's, and
``agrees`` is false.

Only the vocabulary's file goes to the tasks, by its path in an installed package; texts pass through Python once, and nothing is shuffled.

Edge cases: null and empty texts have no ids and decode to the empty text; repeated rows and equal ids are documents of their own;
very long texts are taken whole (memory goes with the longest stretch); an empty table gives no rows; of equal scores the leftmost pair goes
first; other columns are left out.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tallybook.llm.common import table, text_batches

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # kinds of pieces in the vocabulary's file
#: Stretches whose ids a task remembers at most, twice over (those met since the table was last full, and those before), and their longest text.
REMEMBERED, LONGEST = 250_000, 64
#: Characters up to which a plain list is the quicker agenda.
SHORT = 40
_NONE = float("-inf")
_LETTER = "A-Za-zÀ-ÖØ-öø-ɏ"
#: Ways to cut a text, finest first, each with the places that no piece may reach across.
STRETCHES = (
    (rf"{SPACE}*[{_LETTER}]+|{SPACE}*[^{SPACE}{_LETTER}]+|{SPACE}+", rf"[{_LETTER}][^{_LETTER}]|[^{SPACE}{_LETTER}][{SPACE}{_LETTER}]"),
    (rf"{SPACE}+[^{SPACE}]*|[^{SPACE}]+", rf"[^{SPACE}]{SPACE}"),
    ("(?s:.+)", ""),
)


class Pieces:
    """A merge-type vocabulary, read from its file."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        kinds = {p.type for p in model.pieces}
        if model.trainer_spec.model_type != 2 or not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only merge-type vocabularies without user-defined or unused pieces can be read")
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = model.normalizer_spec
        self.plain = not (spec.precompiled_charsmap or spec.remove_extra_whitespaces or model.trainer_spec.treat_whitespace_as_suffix) and spec.escape_whitespaces and spec.add_dummy_prefix
        self.prefix = spec.add_dummy_prefix
        self.drops_blanks = spec.remove_extra_whitespaces
        self.normalize = self._plain if self.plain else self.library.normalize
        self.surface = [p.piece.replace(SPACE, " ") if p.type == NORMAL else "" for p in model.pieces]
        self.begins_with_blank = {i for i, p in enumerate(model.pieces) if p.type == NORMAL and p.piece.startswith(SPACE)}
        self.byte = {i: int(p.piece[3:5], 16) for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.byte_id = {b: i for i, b in self.byte.items()}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == UNKNOWN)
        self.surface[self.unknown] = model.trainer_spec.unk_surface
        self.id = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.score = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.beside = {w[i : i + 2] for w in self.id for i in range(len(w) - 1)}
        crossed = lambda place: any(re.search(place, w) for w in self.id)
        stretches = next(stretch for stretch, place in STRETCHES if not place or not crossed(place))
        self.stretches = re.compile(stretches).findall
        self.whole = stretches == STRETCHES[-1][0]
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.fresh: list[tuple[str, list[int]]] = []
        codecs.register_error("each_byte", lambda e: ("�", e.start + 1))

    def _plain(self, text: str) -> str:
        return (SPACE if self.prefix and text else "") + text.replace(" ", SPACE)

    def merged(self, text: str) -> list[int]:
        """The ids of one stretch by its agenda: a heap, or for a short one a list that is searched for its first best."""
        if len(text) > SHORT:
            return self.ids_of(self.merged_long(text))
        score = self.score.get
        parts = list(text)
        agenda = [score(text[a : a + 2], _NONE) for a in range(len(text) - 1)]
        while agenda and (best := max(agenda)) != _NONE:
            a = agenda.index(best)
            parts[a] += parts.pop(a + 1)
            del agenda[a]
            if a < len(agenda):
                agenda[a] = score(parts[a] + parts[a + 1], _NONE)
            if a:
                agenda[a - 1] = score(parts[a - 1] + parts[a], _NONE)
        return self.ids_of(parts)

    def merged_long(self, text: str) -> list[str]:
        n, score = len(text), self.score.get
        # the symbol that begins at a ends at end[a], where the next one begins; one that was merged away has end n
        end, before = [*range(1, n + 1), -1], list(range(-1, n))
        agenda = [(-s, a, a + 2) for a in range(n - 1) if (s := score(text[a : a + 2])) is not None]
        heapq.heapify(agenda)
        while agenda:
            _, a, e = heapq.heappop(agenda)
            b = end[a]
            if end[b] != e:
                continue  # one of the two has been merged since
            end[a], end[b] = e, n
            if e < n:
                before[e], f = a, end[e]
                if (s := score(text[a:f])) is not None:
                    heapq.heappush(agenda, (-s, a, f))
            if (p := before[a]) >= 0 and (s := score(text[p:e])) is not None:
                heapq.heappush(agenda, (-s, p, e))
        parts, a = [], 0
        while a < n:
            parts.append(text[a : end[a]])
            a = end[a]
        return parts

    def ids_of(self, parts: list[str]) -> list[int]:
        out: list[int] = []
        for part in parts:
            known = self.id.get(part)
            if known is not None:
                out.append(known)
            elif self.byte_id:
                out += [self.byte_id[x] for x in part.encode()]
            else:
                out.append(self.unknown)
        return out

    def stretch(self, text: str) -> list[int]:
        """``merged`` of the parts of ``text`` that no piece reaches across; short texts have one agenda."""
        out: list[int] = []
        start = 0
        if len(text) > LONGEST:
            for i in range(1, len(text)):
                if text[i - 1 : i + 1] not in self.beside:
                    out += self.merged(text[start:i])
                    start = i
        return out + self.merged(text[start:])

    def encode(self, text: str) -> list[int]:
        """The ids of ``text``; stretches not met lately are listed in ``fresh``."""
        out: list[int] = []
        known = self.known
        for part in self.stretches(self.normalize(text)):
            ids = known.get(part)
            if ids is None:
                ids = self.older.get(part)
                if ids is None:
                    ids = self.stretch(part)
                    self.fresh.append((part, ids))
                if len(part) <= LONGEST:
                    if len(known) >= REMEMBERED:
                        self.older, self.known = known, (known := {})
                    known[part] = tuple(ids)
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``: runs of bytes are put together, the blank that encoding puts first goes, bytes that are no UTF-8 become U+FFFD."""
        byte = self.byte
        if byte.keys().isdisjoint(ids):
            text = "".join(map(self.surface.__getitem__, ids))
        else:
            runs = itertools.groupby(ids, byte.__contains__)
            text = "".join(bytes(map(byte.__getitem__, run)).decode("utf-8", "each_byte") if raw else "".join(map(self.surface.__getitem__, run)) for raw, run in runs)
        first = next((i for i in ids if i in byte or self.surface[i]), None)
        if first in self.begins_with_blank and (self.prefix or self.drops_blanks):
            return text.lstrip(" ") if self.drops_blanks else text[1:]
        return text

    def checked(self, texts: list[str]) -> Iterator[tuple[list[int], str, bool]]:
        """ids, decoded text and whether both are the library's, for a batch of texts; the library's where they are not.

        Stretches are checked when they are first met: the library gets all new ones of the batch at once.
        A text is as the library has it if its stretches are, since no merge reaches from one to the next.
        """
        self.fresh.clear()
        mine = [self.encode(t) for t in texts]
        if self.whole or not self.plain:
            wrong = True
        else:  # a character before each stretch, from which it is cut
            guards = ["a" if re.match(f"[^{SPACE}{_LETTER}]", w) else "." for w, _ in self.fresh]
            theirs = self.library.encode([g + w for g, (w, _) in zip(guards, self.fresh, strict=True)], num_threads=1)
            first = {g: self.library.encode(g) for g in "a."}
            wrong = any(first[g] + ids != x for g, (_, ids), x in zip(guards, self.fresh, theirs, strict=True))
        for text, ids in zip(texts, mine, strict=True):
            right = self.library.encode(text) if wrong else ids
            back, again = self.decode(ids), self.library.decode(right)
            yield right, again, ids == right and back == again


def _map(rows: DataFrame, key: str, column: str, vocabulary: str, names: list[str], kinds: list[pa.DataType], schema: str, each) -> DataFrame:
    """key and ``each(pieces, values)``, a tuple per row, batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        pieces = Pieces(public_tokenizers.path(vocabulary))
        for batch in batches:
            columns = list(zip(*each(pieces, batch[column].to_pylist()), strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([batch[key], *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], names=[key, *names])

    text_batches(rows.sparkSession)
    return rows.select(key, column).mapInArrow(run, f"{key} {rows.schema[key].dataType.simpleString()}, {schema}")


def encode(docs: DataFrame, key: str = "doc_id", column: str = "text", vocabulary: str = "piece_bpe_32k.model") -> DataFrame:
    """``docs`` -> key, ids, agrees."""
    each = lambda pieces, texts: ((ids, agrees) for ids, _, agrees in pieces.checked([t or "" for t in texts]))
    return _map(docs, key, column, vocabulary, ["ids", "agrees"], [pa.list_(pa.int32()), pa.bool_()], "ids array<int>, agrees boolean", each)


def decode(rows: DataFrame, key: str = "doc_id", column: str = "ids", vocabulary: str = "piece_bpe_32k.model") -> DataFrame:
    """``rows`` with lists of ids -> key, text; null is the empty text."""
    each = lambda pieces, lists: ((pieces.decode(ids or []),) for ids in lists)
    return _map(rows, key, column, vocabulary, ["text"], [pa.string()], "text string", each)


def op12_piece_agenda(spark: SparkSession, sf_dir: str) -> DataFrame:
    def each(pieces: Pieces, texts: list[str | None]) -> Iterator[tuple[int, str, str, bool]]:
        number = [str(i) for i in range(len(pieces.surface))]
        for ids, text, agrees in pieces.checked([t or "" for t in texts]):
            yield len(ids), hashlib.sha256(",".join(map(number.__getitem__, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), agrees

    names, kinds = ["n_tokens", "ids_sha256", "decoded_sha256", "agrees"], [pa.int64(), pa.string(), pa.string(), pa.bool_()]
    docs = table(spark, sf_dir, "documents")
    return _map(docs, "doc_id", "text", "piece_bpe_32k.model", names, kinds, "n_tokens long, ids_sha256 string, decoded_sha256 string, agrees boolean", each)
