"""Records of text files whose borders depend on what stands before them, read by many tasks.

A quoted line break or a brace in a string ends nothing, and whether a byte lies in quotes depends on all quotes before
it. So every block of a file is measured first under both assumptions about its beginning: the quotes in it, how its
depth of brackets changes, and how many records would end at each depth. A running sum over the blocks settles
where each of them begins, and then the blocks are read again, now knowing it. Only records that cross a border of
blocks are put together from parts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabweave.storage import stage

_ESCAPED = re.compile(r"\\.", re.DOTALL)


@dataclass(frozen=True)
class Syntax:
    """How records are told apart.

    Text is read in pieces that end with ``separator``. ``measure`` gives the quotes of a piece and the change of depth
    outside of quotes, if it begins outside and if it begins inside. Outside of quotes the separator itself changes
    the depth by ``step``, and a record ends with it where the depth is ``level`` afterwards.
    """

    separator: str
    measure: Callable[[str], tuple[int, int, int]]
    step: int
    level: int


def _json_measure(piece: str) -> tuple[int, int, int]:
    parts = (_ESCAPED.sub("", piece) if "\\" in piece else piece).split('"')
    return len(parts) - 1, *(_depth("".join(parts[first::2])) for first in (0, 1))


def _depth(text: str) -> int:
    return text.count("{") + text.count("[") - text.count("]")


# Elements of one array: a closing brace ends an object, at the depth of the array an element.
JSON_ARRAY = Syntax("}", _json_measure, step=-1, level=1)
# Lines, unless the line feed is in quotes; quotes in quotes are doubled.
QUOTED_LINES = Syntax("\n", lambda piece: (piece.count('"'), 0, 0), step=0, level=0)


class _Reader:
    """Goes through the pieces of a block from an assumed beginning."""

    def __init__(self, syntax: Syntax, quoted: bool, depth: int):
        self.syntax, self.quoted, self.depth = syntax, quoted, depth

    def ends(self, measured: tuple[int, int, int]) -> bool:
        """Take one piece; whether its separator stands outside of quotes."""
        quotes, outside, inside = measured
        self.depth += inside if self.quoted else outside
        self.quoted ^= quotes % 2 == 1
        if not self.quoted:
            self.depth += self.syntax.step
        return not self.quoted


def _pieces(spark: SparkSession, path: str, syntax: Syntax) -> DataFrame:
    """Pieces in the order of the file, block by block; a block is what one task reads of a file."""
    text = spark.read.option("lineSep", syntax.separator).text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )


_SUMMARY = "file string, block long, quotes long, depth array<long>, levels array<array<long>>, ends array<array<long>>"


def _summaries(pieces: DataFrame, syntax: Syntax) -> DataFrame:
    """One line per block: its quotes, and per assumption the change of depth and the endings by depth."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], tuple[list[int], list[_Reader], list[Counter]]] = {}
        for batch in batches:
            for file, block, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (file, block) not in found:
                    found[file, block] = [0], [_Reader(syntax, q, 0) for q in (False, True)], [Counter(), Counter()]
                quotes, readers, ends = found[file, block]
                measured = syntax.measure(value)
                quotes[0] += measured[0]
                for reader, levels in zip(readers, ends, strict=True):
                    if reader.ends(measured):
                        levels[reader.depth] += 1
        rows = [
            (f, b, q[0], [r.depth for r in readers], [list(e) for e in ends], [list(e.values()) for e in ends])
            for (f, b), (q, readers, ends) in found.items()
        ]
        lists = pa.list_(pa.list_(pa.int64()))
        types = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), lists, lists)
        columns = list(zip(*rows, strict=True)) or [()] * len(types)
        names = [field.split()[0] for field in _SUMMARY.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return pieces.mapInArrow(summarise, _SUMMARY)


@dataclass(frozen=True)
class _Beginning:
    """What stands before a block: whether it begins in quotes, its depth, the records before it in its file and in
    all files, and whether no block follows it in its file."""

    quoted: bool
    depth: int
    number: int
    position: int
    last: bool


def _beginnings(summaries: DataFrame, syntax: Syntax) -> dict[tuple[str, int], _Beginning]:
    """The beginning of every block.

    The driver gets one line per block, which is one per ``spark.sql.files.maxPartitionBytes`` of text.
    """
    rows = sorted(summaries.collect(), key=lambda r: (r["file"], r["block"]))
    out: dict[tuple[str, int], _Beginning] = {}
    quotes = depth = number = position = 0
    for i, row in enumerate(rows):
        last = i + 1 == len(rows) or rows[i + 1]["file"] != row["file"]
        out[row["file"], row["block"]] = _Beginning(quotes % 2 == 1, depth, number, position, last)
        levels = dict(zip(row["levels"][quotes % 2], row["ends"][quotes % 2], strict=True))
        ended = levels.get(syntax.level - depth, 0)
        number, position = number + ended, position + ended
        depth, quotes = depth + row["depth"][quotes % 2], quotes + row["quotes"]
        if last:
            quotes = depth = number = 0
    return out


def read_records(spark: SparkSession, path: str, syntax: Syntax) -> DataFrame:
    """``file, number, position, text``: the records of one or more files, numbered from 0 in each of them.

    ``position`` goes on from file to file, in the order of their names, counting records that end with the separator.
    What follows the last separator of a file is a record of its file as well if it is more than white space. The text
    is read twice, by as many tasks as Spark splits the files into, and written once with its borders settled; only
    records on a border of blocks move.
    """
    pieces = _pieces(spark, path, syntax)
    known = _beginnings(_summaries(pieces, syntax), syntax)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, block = None, None
        for batch in batches:
            rows: list[tuple] = []
            for file, start, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != (file, start):
                    rows += block.close() if block else []
                    at = file, start
                    if at not in known:
                        raise ValueError("the files were split in another way than before; read them again")
                    block = _Block(at, known[at], syntax)
                rows += block.take(value)
            yield _record_rows(rows)
        if block:
            yield _record_rows(block.close())

    parts = stage(pieces.mapInArrow(assemble, _PART), "records")
    crossing = parts.where("NOT whole").groupBy("file", "number").agg(
        F.min("position").alias("position"), F.array_sort(F.collect_list(F.struct("block", "text"))).alias("parts")
    )
    text = F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text")
    joined = crossing.select("file", "number", "position", text)
    complete = parts.where("whole").select("file", "number", "position", "text").unionByName(joined)
    return complete.where(F.trim(F.translate("text", "\t\r\n", "")) != "")


class _Block:
    """Puts the records of one block together. A record that may have begun in the block before, or that has not ended
    here, is given as a part."""

    def __init__(self, at: tuple[str, int], beginning: _Beginning, syntax: Syntax):
        self.at, self.beginning, self.syntax = at, beginning, syntax
        self.reader = _Reader(syntax, beginning.quoted, beginning.depth)
        self.ended, self.whole = 0, at[1] == 0
        self.held: list[str] = []
        self.next: str | None = None

    def take(self, value: str) -> list[tuple]:
        """A piece; it is gone through when the next one is there, as the last one of a file has no separator."""
        out = [] if self.next is None else self._go_on(self.next)
        self.next = value
        return out

    def _go_on(self, value: str) -> list[tuple]:
        self.held.append(value + self.syntax.separator)
        if not (self.reader.ends(self.syntax.measure(value)) and self.reader.depth == self.syntax.level):
            return []
        return self._row()

    def _row(self) -> list[tuple]:
        b = self.beginning
        row = (*self.at, b.number + self.ended, b.position + self.ended, self.whole, "".join(self.held))
        self.held, self.whole, self.ended = [], True, self.ended + 1
        return [row]

    def close(self) -> list[tuple]:
        out = []
        if self.next is not None:
            if self.beginning.last:
                self.held.append(self.next)
            else:
                out = self._go_on(self.next)
        self.whole = False
        return out + (self._row() if self.held else [])


_PART = "file string, block long, number long, position long, whole boolean, text string"


def _record_rows(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), *[pa.int64()] * 3, pa.bool_(), pa.string())
    columns = list(zip(*rows, strict=True)) or [()] * len(types)
    names = [field.split()[0] for field in _PART.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)
