"""Quality rules: word counts, repetition, and bands of zstandard compression ratios.

Text that repeats itself compresses too well, noise too badly. A whole document is
compared with the band of its length, as short texts carry the compressor's fixed cost;
fixed chunks, smaller ones in short texts, find a repetitive or noisy part that the whole
would hide.
"""

import bisect
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholaris.llm.arrow import map_batches, small_batches, texts

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Bands:
    """Limits of raw bytes / compressed bytes.

    `limits` holds (bytes from, least, most) in ascending order: a document and each of its
    chunks is judged by the last entry whose `bytes from` its own length reaches. The least
    ratios lie above those of random words of letters and digits and below those of prose.
    The greatest are 1.3 times what prose of that length reaches at the most, rounded: text
    written two or three times over, and lines made from one template, lie above them.
    `chunks` holds (bytes from, bytes of a chunk) in the same way, by the document's length.
    A last chunk shorter than half a chunk is judged together with the one before it. A
    document is rejected as well if more than `bad_share` of its chunks lie outside.
    """

    limits: tuple[tuple[int, float, float], ...] = (
        (0, 1.02, 1.9),
        (128, 1.07, 1.9),
        (160, 1.13, 2.0),
        (192, 1.18, 2.1),
        (224, 1.24, 2.15),
        (256, 1.28, 2.3),
        (320, 1.32, 2.4),
        (384, 1.355, 2.4),
        (448, 1.38, 2.45),
        (512, 1.42, 2.65),
        (640, 1.46, 2.7),
        (768, 1.5, 2.8),
        (1024, 1.54, 2.95),
        (1536, 1.58, 3.15),
        (2048, 1.62, 3.4),
        (4096, 1.65, 3.6),
        (16384, 1.7, 3.8),
        (65536, 1.7, 4.0),
    )
    chunks: tuple[tuple[int, int], ...] = ((0, 256), (2048, 512), (16384, 4096))
    bad_share: float = 0.25
    level: int = 3


BANDS = Bands()
MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, n_bytes long, whole_ratio double, n_chunks long, n_bad_chunks long, kept boolean"
)


def repeated_words(words: list[bytes]) -> int:
    """Words covered by a three-word window that occurs twice or more."""
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    _, pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)
    windows = pairs[:-1] * len(numbers) + ids[2:]
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    starts = counts[inverse] > 1
    covered = np.zeros(len(words), bool)
    for offset in range(3):
        covered[offset : offset + len(starts)] |= starts
    return int(covered.sum())


class Measure:
    """Measures one text after another; holds the compressor."""

    def __init__(self, bands: Bands):
        self.bands = bands
        self.starts = [x[0] for x in bands.limits]
        self.chunk_starts = [x[0] for x in bands.chunks]
        self.compressor = zstandard.ZstdCompressor(level=bands.level)
        table = np.zeros((2, 256), np.int64)
        table[0] = [(b & 0xC0) != 0x80 and b not in BLANKS for b in range(256)]
        table[1] = [b in SYMBOLS for b in range(256)]
        self.table = table

    def ratio(self, text: bytes) -> float:
        return len(text) / len(self.compressor.compress(text)) if text else 0.0

    def chunks(self, text: bytes) -> list[bytes]:
        _, size = self.bands.chunks[bisect.bisect_right(self.chunk_starts, len(text)) - 1]
        n = (len(text) + size // 2) // size
        cuts = [i * size for i in range(max(n, 1))] + [len(text)]
        return [text[a:b] for a, b in itertools.pairwise(cuts)] if text else []

    def inside(self, ratio: float, length: int) -> bool:
        _, least, most = self.bands.limits[bisect.bisect_right(self.starts, length) - 1]
        return least <= ratio <= most

    def __call__(self, text: bytes) -> tuple:
        words = text.split()
        bytes_by_value = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
        word_chars, n_symbols = (int(x) for x in self.table @ bytes_by_value)
        lines = [line for line in text.split(b"\n") if line and not line.isspace()]
        repeats = repeated_words(words)
        failed = len(words) < 50 or 100 * repeats > 50 * len(words)
        ratio = self.ratio(text)
        chunks = self.chunks(text)
        bad = sum(not self.inside(self.ratio(x), len(x)) for x in chunks)
        kept = not failed and self.inside(ratio, len(text)) and bad <= self.bands.bad_share * len(chunks)
        return (
            len(words), word_chars, n_symbols, len(lines) - len(set(lines)), repeats,
            failed, len(text), ratio, len(chunks), bad, kept,
        )


def measured(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", bands: Bands = BANDS) -> DataFrame:
    """The id, the measures and the verdict `kept` of every row.

    Null and empty texts have no words: they fail the base rules and are not kept. Rows
    are judged one by one, so repeated ids, repeated rows and null ids stay as they are;
    an empty table gives no rows. Other columns are neither read nor returned. A text of
    any length is one unit of work: its words and one number a word are held in memory.
    """
    rows = docs.select(F.col(id_column).alias(id_column), F.col(text_column).alias("text"))
    kind = rows.schema[id_column].dataType.simpleString()
    names = [part.split()[0] for part in MEASURES.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = Measure(bands)
        for batch in small_batches(batches, "text"):
            found = list(zip(*map(measure, texts(batch.column(1))), strict=True))
            if found:
                yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, found)], [id_column, *names])

    return map_batches(rows, work, f"`{id_column}` {kind}, {MEASURES}")


def kept(docs: DataFrame, text_column: str = "text", bands: Bands = BANDS) -> DataFrame:
    """The rows whose text passes, with all their columns, in one pass without a shuffle."""
    at = docs.columns.index(text_column)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = Measure(bands)
        for batch in batches:
            verdicts = [measure(x)[-1] for part in small_batches([batch], text_column) for x in texts(part.column(at))]
            yield batch.filter(pa.array(verdicts, pa.bool_()))

    return map_batches(docs, work, docs.schema)
