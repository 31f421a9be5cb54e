"""Token counts by greedy longest match, in time linear in the word.

A word is cut from the left, each time by the longest piece of the vocabulary that fits:
first one that may start a word, then ones that may continue it. The pieces form two
tries, with a failure link on every node: where a word leaves the trie, the link leads to
the node that greedy cutting of the same characters would be at, and the node knows how
many pieces have been cut off on the way. So a word is read once, character by character,
and only the number of its pieces is ever made.
"""

import functools
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholaris.llm.arrow import map_batches, small_batches, texts

START, CONTINUE, NOWHERE = 0, 1, -1


class LongestMatch:
    """count(word): pieces of a word, or 0 if the vocabulary cannot cut it.

    An empty starting piece is the mark before a word as a piece of its own: a word that no
    other starting piece fits is cut by continuing pieces from its first character. With
    `by_bytes`, a character that no piece fits counts as the bytes of its UTF-8 form.
    """

    def __init__(self, starting: Iterable[str], continuing: Iterable[str], by_bytes: bool = False):
        # A node's edges by character; START and CONTINUE are the roots.
        self.edges: list[dict[str, int]] = [{}, {}]
        self.by_bytes = by_bytes
        starting, continuing = set(starting), set(continuing) - {""}
        pieces = dict.fromkeys([self._add(START, p) for p in starting if p] + [self._add(CONTINUE, p) for p in continuing], 1)
        if by_bytes:
            # Other characters are met at the root only, and never lie within a piece.
            for character in set().union(*starting, *continuing) - continuing:
                pieces[self._add(CONTINUE, character)] = len(character.encode())
        self.links = [NOWHERE] * len(self.edges)
        self.popped = [0] * len(self.edges)
        if "" in starting:
            self.links[START], self.popped[START] = CONTINUE, 1
        self._link(pieces)

    def _add(self, node: int, piece: str) -> int:
        for character in piece:
            if character not in self.edges[node]:
                self.edges[node][character] = len(self.edges)
                self.edges.append({})
            node = self.edges[node][character]
        return node

    def _link(self, pieces: dict[int, int]) -> None:
        level = [START, CONTINUE]
        while level:
            following = []
            for parent in level:
                for character, node in self.edges[parent].items():
                    following.append(node)
                    if node in pieces:
                        self.links[node], self.popped[node] = CONTINUE, pieces[node]
                        continue
                    # What the parent's characters are cut into, and on from there.
                    at, popped = self.links[parent], self.popped[parent]
                    while at != NOWHERE and character not in self.edges[at]:
                        popped += self.popped[at]
                        at = self.links[at]
                    if at != NOWHERE:
                        self.links[node], self.popped[node] = self.edges[at][character], popped
            level = following

    def count(self, word: str) -> int:
        node, popped = START, 0
        for character in word:
            while (following := self.edges[node].get(character)) is None:
                if node == CONTINUE and self.by_bytes:
                    popped += len(character.encode())
                    following = CONTINUE
                    break
                if self.links[node] == NOWHERE:
                    return 0
                popped += self.popped[node]
                node = self.links[node]
            node = following
        while node != CONTINUE:
            if self.links[node] == NOWHERE:
                return 0
            popped += self.popped[node]
            node = self.links[node]
        return popped


class _Counts(dict):
    """Counts of words seen lately; a full store is emptied."""

    def __init__(self, count: Callable[[str], int], most: int = 400_000):
        super().__init__()
        self.of, self.most = count, most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = found = self.of(word.decode())
        return found


@functools.lru_cache(maxsize=2)
def piece_counts(path: str, all_pieces: bool = False) -> _Counts:
    """Counts by the pieces of a sentencepiece file, one store for a worker process.

    A piece with the word mark starts a word, any other continues one. Control and unknown
    pieces are left out. So are byte pieces and the word mark alone without `all_pieces`;
    with it, a marked piece also continues a word that holds the mark's character itself.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    numbers = range(model.get_piece_size())
    pieces = [model.id_to_piece(i) for i in numbers if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    starting = [p.removeprefix("▁") for p in pieces if p.startswith("▁")]
    if all_pieces:
        return _Counts(LongestMatch(starting, pieces, sum(map(model.is_byte, numbers)) == 256).count)
    return _Counts(LongestMatch([p for p in starting if p], [p for p in pieces if "▁" not in p]).count)


def token_counts(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", all_pieces: bool = False
) -> DataFrame:
    """(id, n_words, n_tokens, n_unknown) of every row.

    Words are what ASCII white space separates. A word that the vocabulary cannot cut is
    one unknown token; with `all_pieces`, the lone word mark and the byte pieces are part of
    the vocabulary, and where it holds both, it cuts every word. Null and empty texts have none. Rows are taken one by one, without a
    shuffle; repeated rows and null ids stay, an empty table gives no rows, other columns
    are not read.
    """
    rows = docs.select(F.col(id_column).alias(id_column), F.col(text_column).alias("text"))
    kind = rows.schema[id_column].dataType.simpleString()
    names = [id_column, "n_words", "n_tokens", "n_unknown"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = piece_counts(path, all_pieces)
        for batch in small_batches(batches, "text"):
            found = []
            for text in texts(batch.column(1)):
                pieces = [counts[word] for word in text.split()]
                unknown = pieces.count(0)
                found.append((len(pieces), sum(pieces) + unknown, unknown))
            if found:
                yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, zip(*found, strict=True))], names)

    return map_batches(rows, work, f"`{id_column}` {kind}, n_words long, n_tokens long, n_unknown long")
