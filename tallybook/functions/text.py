"""Codes, names and small vocabularies as column expressions. All take a string column; unreadable is null."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Mapping
from contextvars import ContextVar
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.vocabulary import CHANNELS, DOC_PREFIXES, MOVEMENT_TYPES

_open: ContextVar[Stage | None] = ContextVar("_open", default=None)


class Stage:
    """Rows on which parsers put their intermediate values as columns, so that each is computed once and all of it is compiled.

    While a stage is open (``with Stage(rows) as stage``), every ``let`` binds its value to a column; the expressions that parsers return then refer to
    these columns and belong on ``stage.rows()``. A value's level is one above the highest that it refers to, and each level is one
    projection. Values are computed for every row, so what is bound must not fail on any.

    The JVM never compiles a method of more than 8,000 bytes of bytecode to machine code, and whole-stage generation puts all projections of a parser into one.
    So where ``spark.sql.codegen.hugeMethodLimit`` has its default, it is set to 8,000 for the session: Spark then runs longer
    chains projection by projection, whose code it splits into small methods.
    """

    def __init__(self, rows: DataFrame):
        self.given = rows
        self._levels: list[dict[str, Column]] = []
        self._level: dict[str, int] = {}
        self._clean: set[str] = set()
        conf = rows.sparkSession.conf
        if conf.get("spark.sql.codegen.hugeMethodLimit") == "65535":
            conf.set("spark.sql.codegen.hugeMethodLimit", 8000)

    def __enter__(self) -> Stage:
        self._token = _open.set(self)
        return self

    def __exit__(self, *_) -> None:
        _open.reset(self._token)

    def bind(self, c: Column) -> Column:
        name = f"__let{len(self._level)}"
        level = max((self._level[n] + 1 for n in re.findall(r"__let\d+", str(c))), default=0)
        if level == len(self._levels):
            self._levels.append({})
        self._levels[level][name] = c
        self._level[name] = level
        return F.col(name)

    def held(self, c: Column) -> Column:
        """``c`` as a column, so that it may be used several times."""
        return c if str(c)[len("Column<'") : -2] in self._level else self.bind(c)

    def bind_clean(self, c: Column) -> Column:
        """A column of which ``clean`` and ``trimmed`` know that they change nothing."""
        out = self.bind(clean(c))
        self._clean.add(str(out))
        return out

    def is_clean(self, c: Column) -> bool:
        return str(c) in self._clean

    def rows(self) -> DataFrame:
        out = self.given
        for level in self._levels:
            out = out.withColumns(level)
        return out


def staged(rows: DataFrame, **values: Callable[[], Column]) -> DataFrame:
    """``rows`` with new columns whose parsers are compiled."""
    with Stage(rows) as stage:
        made = {name: build() for name, build in values.items()}
    return stage.rows().select(*[c for c in rows.columns if c not in made], *[c.alias(name) for name, c in made.items()])


def staging() -> bool:
    """Whether a stage is open, so that columns that go into an expression are cheap."""
    return _open.get() is not None


def let(c: Column, f: Callable[[Column], Column]) -> Column:
    """``f(c)`` with ``c`` evaluated once, however often ``f`` uses it (nested expressions would be copied into the plan).

    On an open stage ``c`` becomes a column; elsewhere, as in a lone expression, a lambda's variable, which Spark doesn't compile.
    """
    stage = _open.get()
    return f(stage.bind(c)) if stage else F.get(F.transform(F.array(c), f), F.lit(0))


#: White space of Unicode, as Java's patterns know it.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def trim(c: Column) -> Column:
    return F.trim(c, F.lit(WHITE))


def trimmed(c: Column) -> Column:
    """Without white space around it. On a stage, texts between two visible ASCII characters pass as they are."""
    stage = _open.get()
    if not stage:
        return trim(c)
    if stage.is_clean(c):
        return c
    held = stage.held(c)
    return F.when(held.rlike(r"^[!-~](?:.*[!-~])?\z"), held).otherwise(trim(held))


def clean(c: Column) -> Column:
    """Trimmed, with single blanks (any Unicode white space); null becomes the empty string.

    On a stage, ASCII words with single blanks between pass as they are: replacing costs several times as much as looking.
    """
    replaced = lambda x: F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), r"(?U)\s+", " "))
    stage = _open.get()
    if not stage:
        return replaced(c)
    if stage.is_clean(c):
        return c
    held = stage.held(c)
    return F.when(held.rlike(r"^(?:[!-~]++(?: [!-~]++)*+)?\z"), held).otherwise(replaced(held))


def number_text(c: Column) -> Column:
    """A double as text, whole numbers without a fraction."""
    return F.when(c == F.floor(c), F.floor(c).cast("string")).otherwise(c.cast("string"))


def blank(c: Column) -> Column:
    return clean(c) == ""


def lookup(c: Column, words: Mapping[str, str]) -> Column:
    """The word's meaning, whatever its case; null if it has none. The map is a literal of the plan."""
    return meaning(clean(c), words)


def meaning(c: Column, words: Mapping[str, str]) -> Column:
    """The same for a text without blanks around it."""
    pairs = [F.lit(x) for pair in words.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), F.lower(c))


def _digits(c: Column, width: int) -> Column:
    """A text of digits as a number of at least ``width`` digits."""
    n = c.cast("int").cast("string")
    return F.lpad(n, F.greatest(F.length(n), F.lit(width)), F.lit("0"))


def sku(c: Column) -> Column:
    """``fab cot 1`` -> ``FAB-COT-001``."""
    shape = r"^([A-Z]{3})([A-Z]{3})(\d{1,3})$"
    whole = lambda s: F.when(s.rlike(shape), F.concat(F.substring(s, 1, 3), F.lit("-"), F.substring(s, 4, 3), F.lit("-"), F.lpad(F.substring(s, 7, 3), 3, "0")))
    rest = lambda s: F.when(s.rlike(r"^[A-Za-z0-9]*\z"), s).otherwise(F.regexp_replace(s, "[^A-Za-z0-9]", ""))
    usual = F.replace(F.replace(clean(c), F.lit(" "), F.lit("")), F.lit("-"), F.lit(""))  # the usual separators without a pattern
    return let(usual, lambda s: let(F.upper(rest(s)), whole))


def document(c: Column, domain: str) -> Column:
    """``po 2019/42`` -> ``PO-2019-00042`` if the prefix belongs to the domain."""
    shape = rf"^({'|'.join(DOC_PREFIXES[domain])})\W*(\d{{4}})\W*(\d{{1,5}})$"
    (n,) = {len(p) for p in DOC_PREFIXES[domain]}  # of one length, so the parts have fixed places once the separators are gone
    whole = lambda x: F.concat(F.substring(x, 1, n), F.lit("-"), F.substring(x, n + 1, 4), F.lit("-"), F.lpad(F.substring(x, n + 5, 5), 5, "0"))
    return let(F.upper(clean(c)), lambda s: let(F.when(s.rlike(shape), F.regexp_replace(s, r"\W+", "")), whole))


def employee(c: Column) -> Column:
    """``EMP-14``, ``e14``, ``14`` -> ``E014``."""
    shape = r"^(?:EMP|E)?\W*(\d{1,4})$"
    return let(F.upper(clean(c)), lambda s: F.when(s.rlike(shape), F.concat(F.lit("E"), _digits(F.regexp_extract(s, shape, 1), 3))))


@cache
def _folds() -> tuple[str, str, dict[str, str]]:
    """Characters beyond ASCII whose compatibility decomposition has one ASCII character, these, and those with several."""
    to = {chr(i): unicodedata.normalize("NFKD", chr(i)).encode("ascii", "ignore").decode() for i in range(128, 0x110000) if not 0xD800 <= i < 0xE000}
    one = {c: x for c, x in to.items() if len(x) == 1}
    return "".join(one), "".join(one.values()), {c: x for c, x in to.items() if len(x) > 1}


def ascii_fold(c: Column) -> Column:
    """Compatibility decomposition without what isn't ASCII, by tables (from Python's Unicode data) that are literals of the plan.

    A character decomposes whatever stands beside it. Plain ASCII passes as it is; the few characters that stand for several go through a map.
    """
    one, to, several = _folds()
    pairs = F.create_map(*[F.lit(x) for pair in several.items() for x in pair])
    spelled = F.array_join(F.transform(F.split(c, ""), lambda x: F.coalesce(F.try_element_at(pairs, x), x)), "")
    rare = F.when(c.rlike(f"[{''.join(several)}]"), spelled).otherwise(c)
    return F.when(c.rlike(r"^[\x00-\x7f]*$"), c).otherwise(F.regexp_replace(F.translate(rare, one, to), r"[^\x00-\x7f]+", ""))


def name_key(c: Column) -> Column:
    """The same for ``SMITH John``, ``Smith, John`` and ``john smith``: letters only, words in order."""
    words = F.split(F.trim(F.regexp_replace(F.lower(ascii_fold(clean(c))), r"[^a-z]+", " ")), " ")
    return F.array_join(F.sort_array(words), " ")


def channel(c: Column) -> Column:
    return lookup(c, CHANNELS)


def movement_type(c: Column) -> Column:
    return lookup(c, MOVEMENT_TYPES)


def description_key(c: Column) -> Column:
    """Lower-case letters and digits with single blanks between; null if nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " ")), F.lit(""))
