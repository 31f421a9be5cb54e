"""Fill-in-middle: cut texts in three and move the middle to the end.

Where to cut follows from a digest of the row's id, so a rerun cuts at the same places. A
text is taken as fixed blocks of bytes. A Fenwick tree over the blocks holds how many units
and how many code points start in each; descending it by halving steps finds the block of
a cut and the counts before it, and only that block is looked at to find the place.
"""

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholaris.llm.arrow import map_batches, small_batches, texts

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
BLOCK = 4096
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def point_starts(text: np.ndarray) -> np.ndarray:
    """Where code points start in UTF-8 bytes."""
    return (text & 0xC0) != 0x80


def word_starts(text: np.ndarray) -> np.ndarray:
    """Where words start; the first unit takes the blanks before it, each one those after it."""
    blank = _BLANK[text]
    starts = ~blank
    starts[1:] &= blank[:-1]
    first = np.flatnonzero(starts)[:1]
    starts[first] = False
    starts[:1] = True
    return starts


UNITS: dict[str, Callable[[np.ndarray], np.ndarray]] = {"points": point_starts, "words": word_starts}


@dataclass(frozen=True)
class Rule:
    """How rows are dealt: the seed, the units of the cuts, shares in hundredths of plain texts and of suffix-first ones."""

    seed: str = "1"
    units: str = "points"
    plain_from: int = 90
    suffix_first_below: int = 20
    block: int = BLOCK


class Fenwick:
    """Counts by block, two kinds at once, with prefix sums in a logarithm of steps."""

    def __init__(self, counts: np.ndarray):
        """`counts` has a row for each kind and a column for each block."""
        self.size = counts.shape[1]
        sums = np.zeros((counts.shape[0], self.size + 1), np.int64)
        np.cumsum(counts, axis=1, out=sums[:, 1:])
        nodes = np.arange(self.size + 1)
        # Node i covers the blocks after i without its lowest bit, up to i.
        self.nodes = sums - sums[:, nodes & (nodes - 1)]
        self.top = 1 << (self.size.bit_length() - 1) if self.size else 0

    def find(self, wanted: int) -> tuple[int, int, int]:
        """The block where unit number `wanted` (from 0) starts, and the units and second counts before that block."""
        block, units, others, step = 0, 0, 0, self.top
        while step:
            after = block + step
            if after <= self.size and units + self.nodes[0, after] <= wanted:
                block = after
                units += int(self.nodes[0, after])
                others += int(self.nodes[1, after])
            step >>= 1
        return block, units, others


class Cutter:
    """Finds places in one text by units."""

    def __init__(self, text: bytes, units: str = "points", block: int = BLOCK):
        values = np.frombuffer(text, np.uint8)
        self.size, self.block = len(values), block
        self.points = point_starts(values)
        self.starts = self.points if units == "points" else UNITS[units](values)
        edges = np.arange(0, self.size, block)
        kinds = (self.starts, self.points)
        counts = np.stack([np.add.reduceat(k, edges, dtype=np.int64) if len(edges) else np.zeros(0, np.int64) for k in kinds])
        self.n_units, self.n_points = (int(x) for x in counts.sum(axis=1))
        self.tree = Fenwick(counts)

    def cut(self, units: int) -> tuple[int, int]:
        """(bytes, code points) of the first `units` units."""
        if units >= self.n_units:
            return self.size, self.n_points
        block, before, points = self.tree.find(units)
        at = block * self.block
        local = int(np.flatnonzero(self.starts[at : at + self.block])[units - before])
        return at + local, points + int(np.count_nonzero(self.points[at : at + local]))


def deal(seed: str, row_id: int | str | None) -> list[int]:
    """Four numbers below 2**32 from the seed and the id; a null id counts as an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if row_id is None else row_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def rearranged(text: bytes, row_id, rule: Rule = Rule()) -> tuple[int, str, int | None, int | None, bytes]:  # noqa: B008
    """(units, form, code points of prefix and of middle, output) of one text."""
    one, two, three, four = deal(rule.seed, row_id)
    cutter = Cutter(text, rule.units, rule.block)
    n = cutter.n_units
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or three % 100 >= rule.plain_from:
        return n, "plain", None, None, text
    (first, before), (second, upto) = (cutter.cut(x) for x in sorted((one % (n + 1), two % (n + 1))))
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if four % 100 < rule.suffix_first_below:
        form, parts = "spm", (SUFFIX, suffix, PREFIX, prefix)
    else:
        form, parts = "psm", (PREFIX, prefix, SUFFIX, suffix)
    return n, form, before, upto - before, b"".join((*parts, MIDDLE, middle))


def transformed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rule: Rule = Rule()) -> DataFrame:  # noqa: B008
    """(id, n, form, prefix_chars, middle_chars, output) of every row, in one pass without a shuffle.

    `form` is psm (prefix, suffix, middle), spm (suffix, prefix, middle) or plain: the text
    as it was, because it is empty, holds one of the marks, or was dealt so; its counts are
    null. Null texts are empty. Rows with one id are cut by the same numbers, each by its
    own length; a null id is dealt like an empty one. An empty table gives no rows. Other
    columns are neither read nor returned. A text of any length is one unit of work: a byte
    and two flags for each of its bytes are held, and its output.
    """
    rows = docs.select(F.col(id_column).alias(id_column), F.col(text_column).alias("text"))
    kind = rows.schema[id_column].dataType.simpleString()
    names = [id_column, "n", "form", "prefix_chars", "middle_chars", "output"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            found = [rearranged(text, i, rule) for i, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True)]
            columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)]
            columns[-1] = columns[-1].cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    schema = f"`{id_column}` {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    return map_batches(rows, work, schema)


def restored(output, form):
    """The text before it was rearranged, from the columns `output` and `form`."""
    part = F.split(output, "<[PSM]>", -1)
    psm = F.concat(part[1], part[3], part[2])
    spm = F.concat(part[2], part[3], part[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
