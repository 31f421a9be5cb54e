"""Byte-level BPE as a lazily determinised transducer, and streaming decoding.

A sequence of tokens is what the merges make of its bytes exactly if every two neighbours
are compatible: the merges, run over the two together, leave the border between them. So
a transducer can read bytes and guess where tokens end. A guess is the tokens it has
completed and a place in the trie of all tokens; a token may be completed only next to a
compatible one. All guesses are followed at once: a state is their set, without the tokens
that all of them share, which are final and emitted. A guess dies when its trie path does, or
when no token on the path is compatible, so a token is emitted at the latest after as many bytes as the longest token has. States
and transitions are made when a text first needs them, and thrown away when they are many.

Decoding takes ids as they come and keeps the bytes of an unfinished character.
"""

import base64
import functools
import gc
import hashlib
import re
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholaris.llm.arrow import map_batches, small_batches

# The white space of Unicode's White_Space property, which the splitting pattern means by \s.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Pieces that the pattern never joins: a run without white space, with one leading space,
# and a run of white space, without its last character if text follows.
_COARSE = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_NEVER = 1 << 62
# A guess is asked whether any token can still complete it where at most so many could.
ASKED = 64


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a file with a base64 token and a rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merges:
    """The merges that ranks stand for: always the adjacent pair of least joint rank, leftmost first.

    Tokens are named by their ranks.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        # Rank of the token that two tokens make together.
        self.joint = {
            left << 32 | right: rank
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if (left := ranks.get(token[:cut])) is not None and (right := ranks.get(token[cut:])) is not None
        }
        self.bytes = {rank: token for token, rank in ranks.items()}
        self.left: dict[int, list[tuple[int, int]]] = {}
        self.right: dict[int, list[tuple[int, int]]] = {}

    def apply(self, data: bytes, below: int = _NEVER) -> list[int]:
        """What the merges of rank under `below` make of single bytes."""
        parts = [self.ranks[data[i : i + 1]] for i in range(len(data))]
        while len(parts) > 1:
            ranked = [self.joint.get(a << 32 | b, _NEVER) for a, b in pairwise(parts)]
            least = min(ranked)
            if least >= below:
                break
            at = ranked.index(least)
            parts[at : at + 2] = [least]
        return parts

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The parts at one end of a token as it grows from a byte, each with the rank of the merge that ends it."""
        grown, end = [], _NEVER
        while True:
            grown.append((token, end))
            if len(self.bytes[token]) == 1:
                return grown[::-1]
            end, token = token, self.apply(self.bytes[token], token)[side]

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the bytes of a and b leaves a and b.

        Follows the growth of a's right end and b's left end in the order of ranks: the
        border goes if the two ends of some moment have a joint rank that comes before
        either end is merged into its own token. Of equal ranks the leftmost comes first.
        """
        right = self.right.get(a)
        if right is None:
            right = self.right[a] = self._spine(a, -1)
        left = self.left.get(b)
        if left is None:
            left = self.left[b] = self._spine(b, 0)
        i = j = 0
        while i < len(right) and j < len(left):
            (x, x_end), (y, y_end) = right[i], left[j]
            joint = self.joint.get(x << 32 | y)
            if joint is not None and joint < x_end and joint <= y_end:
                return False
            if x_end <= y_end:
                i += 1
            else:
                j += 1
        return True


# A guess: the ranks completed and not yet emitted, and the place in the trie.
Guess = tuple[tuple[int, ...], int]


class Transducer:
    """encode(piece): the ranks of a piece's tokens, as little-endian uint32 bytes."""

    def __init__(self, ranks: dict[bytes, int], most_states: int = 250_000, most_pairs: int = 500_000):
        self.merges, self.ranks = Merges(ranks), ranks
        self.most_states, self.most_pairs = most_states, most_pairs
        self.packed = {rank: rank.to_bytes(4, "little") for rank in ranks.values()}
        # The trie: nodes are numbers, 0 the root; only nodes with children have an entry.
        self.children: dict[int, dict[int, int]] = {0: {}}
        self.ends: dict[int, int] = {}
        nodes = 1
        for token, rank in ranks.items():
            if self.merges.apply(token) != [rank]:
                continue  # no merges lead to it: it stands only for a whole piece
            node = 0
            for byte in token:
                below = self.children.setdefault(node, {})
                nodes += byte not in below
                node = below.setdefault(byte, nodes - 1)
            self.ends[node] = rank
        # The tokens below a node, where they are few enough to be asked one by one.
        self.below: dict[int, list[int]] = {}
        self._tokens_below(0)
        self.pairs: dict[int, bool] = {}
        self.hopes: dict[int, bool] = {}
        self._forget()

    def _tokens_below(self, node: int) -> list[int]:
        found = []
        for child in self.children.get(node, {}).values():
            found += [self.ends[child]] if child in self.ends else []
            found += self._tokens_below(child)
        if len(found) <= ASKED:
            self.below[node] = found
        return found

    def _hopeful(self, before: int, node: int) -> bool:
        """Whether a token below the node could follow the token before."""
        key = before << 32 | node
        answer = self.hopes.get(key)
        if answer is None:
            if len(self.hopes) >= self.most_pairs:
                self.hopes.clear()
            answer = self.hopes[key] = any(self.merges.compatible(before, token) for token in self.below[node])
        return answer

    def _forget(self) -> None:
        self.numbers: dict[tuple[int, tuple[Guess, ...]], int] = {}
        self.states: list[tuple[int, tuple[Guess, ...]]] = []
        self.moves: dict[int, tuple[int, bytes]] = {}
        self.asked: set[int] = set()
        self.start = self._number(-1, (((), 0),))

    def _number(self, last: int, guesses: tuple[Guess, ...]) -> int:
        key = (last, guesses)
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.states)
            self.states.append(key)
        return number

    def _compatible(self, a: int, b: int) -> bool:
        key = a << 32 | b
        answer = self.pairs.get(key)
        if answer is None:
            if len(self.pairs) >= self.most_pairs:
                self.pairs.clear()
            answer = self.pairs[key] = self.merges.compatible(a, b)
        return answer

    def _move(self, state: int, byte: int) -> tuple[int, bytes]:
        """The state after a byte, and the tokens that have become certain."""
        last, guesses = self.states[state]
        children, ends, after, dones, whole = self.children, self.ends, [], [], None
        for done, node in guesses:
            node = children[node].get(byte)
            if node is None:
                continue
            before = done[-1] if done else last
            if node in children and (before < 0 or node not in self.below or self._hopeful(before, node)):
                after.append((done, node))
                dones.append(done)
            # One token only can end here, as the bytes so far have one tokenization.
            if whole is None and (rank := ends.get(node)) is not None and (before < 0 or self._compatible(before, rank)):
                whole = (*done, rank)
        after.append((whole, 0))
        # What all guesses share is what the first and the last of them in order share.
        dones.append(whole)
        shared = 0
        for x, y in zip(min(dones), max(dones), strict=False):
            if x != y:
                break
            shared += 1
        if not shared:
            return self._number(last, tuple(after)), b""
        rest = tuple([(done[shared:], node) for done, node in after])
        return self._number(whole[shared - 1], rest), b"".join([self.packed[rank] for rank in whole[:shared]])

    def _follow(self, state: int, rest: bytes) -> list[int]:
        """The ranks still to come after a state, for bytes that no move is made for: guesses, one by one."""
        last, guesses = self.states[state]
        children, ends, pairs = self.children, self.ends, self.pairs
        # (place, token before, the token before and all before that, back to the state)
        live = []
        for done, node in guesses:
            link = None
            for rank in done:
                link = (rank, link)
            live.append((node, done[-1] if done else last, link))
        for byte in rest:
            after, whole = [], None
            for node, before, link in live:
                node = children[node].get(byte)
                if node is None:
                    continue
                if node in children:
                    after.append((node, before, link))
                if whole is None and (rank := ends.get(node)) is not None:
                    if before < 0 or ((known := pairs.get(before << 32 | rank)) is None and self._compatible(before, rank)) or known:
                        whole = (0, rank, (rank, link))
            after.append(whole)
            live = after
        ranks, link = [], live[-1][2]
        while link is not None:
            ranks.append(link[0])
            link = link[1]
        return ranks[::-1]

    def encode(self, piece: bytes) -> bytes:
        if (rank := self.ranks.get(piece)) is not None:
            return self.packed[rank]
        if len(self.states) > self.most_states or len(self.asked) > self.most_pairs:
            self._forget()
        state, moves, out = self.start, self.moves, []
        for i, byte in enumerate(piece):
            key = state << 8 | byte
            move = moves.get(key)
            if move is None:
                if key not in self.asked:
                    # Most moves are needed once: one is made when it is asked for again.
                    self.asked.add(key)
                    out += [self.packed[rank] for rank in self._follow(state, piece[i:])]
                    return b"".join(out)
                move = moves[key] = self._move(state, byte)
            state, emitted = move
            if emitted:
                out.append(emitted)
        # At the end the guess without an unfinished token, always the last, is the right one.
        out += [self.packed[rank] for rank in self.states[state][1][-1][0]]
        return b"".join(out)


class Recent:
    """Values of keys used lately: two generations, the older of which goes when the newer is full."""

    def __init__(self, most: int):
        self.most, self.new, self.old = most, {}, {}

    def put(self, key: str, value: bytes) -> dict[str, bytes]:
        """Keep a value; returns the newer generation."""
        if len(self.new) >= self.most:
            self.old, self.new = self.new, {}
        self.new[key] = value
        return self.new


class Encoder:
    """ids(text) by a rank file and a splitting pattern, as little-endian uint32 bytes."""

    def __init__(self, path: str, pattern: str, most: int = 500_000):
        self.transducer = Transducer(read_ranks(path))
        self.pattern = regex.compile(pattern.replace(r"[^\s", f"[^{_SPACE}").replace(r"\s", f"[{_SPACE}]").replace(r"\S", f"[^{_SPACE}]"))
        # The ids of what the pattern matches, and of the runs that it is matched in.
        self.recent = Recent(most)

    def _matched(self, run: str) -> bytes:
        """The ids of a run that is not known."""
        matches = self.pattern.findall(run)
        if len(matches) == 1:
            return self.transducer.encode(run.encode())
        out = []
        for piece in matches:
            ids = self.recent.new.get(piece) or self.recent.old.get(piece)
            if ids is None:
                ids = self.transducer.encode(piece.encode())
                self.recent.put(piece, ids)
            out.append(ids)
        return b"".join(out)

    def ids(self, text: str) -> bytes:
        recent, out = self.recent, []
        new = recent.new
        for run in _COARSE.findall(text):
            ids = new.get(run)
            if ids is None:
                ids = recent.old.get(run) or self._matched(run)
                new = recent.put(run, ids)
            out.append(ids)
        return b"".join(out)


@contextmanager
def no_cycles():
    """Without the search for reference cycles, which would walk over all states again and again."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


@functools.lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """One for a worker process, so that later tasks find the states of earlier ones."""
    return Encoder(path, pattern)


# States of the UTF-8 machine: (bytes still to come, least and greatest next byte). START is
# between characters, BROKEN after a byte that cannot follow.
START, BROKEN = (0, 0, 0), (-1, 0, 0)


def utf8_next(state: tuple[int, int, int], byte: int) -> tuple[int, int, int]:
    more, least, most = state
    if more < 0:
        return BROKEN
    if more:
        return ((more - 1, 0x80, 0xBF) if more > 1 else START) if least <= byte <= most else BROKEN
    if byte < 0x80:
        return START
    if 0xC2 <= byte <= 0xDF:
        return 1, 0x80, 0xBF
    if 0xE0 <= byte <= 0xEF:
        return 2, 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF
    if 0xF0 <= byte <= 0xF4:
        return 3, 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF
    return BROKEN


class Vocabulary:
    """Token bytes by id, and what each does to the UTF-8 machine."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = pa.array(tokens, pa.binary())
        self.bytes = tokens
        self.steps: dict[tuple[tuple[int, int, int], int], tuple[int, int, int]] = {}
        self.closed = np.array([self.step(START, i) == START for i in range(len(tokens))])

    def step(self, state: tuple[int, int, int], token: int) -> tuple[int, int, int]:
        key = (state, token)
        if key not in self.steps:
            for byte in self.bytes[token]:
                state = utf8_next(state, byte)
            self.steps[key] = state
        return self.steps[key]


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    ranks = read_ranks(path)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return Vocabulary(tokens)


def decoded(ids: np.ndarray, words: Vocabulary, chunk: int = 1 << 16) -> Iterator[tuple[bytes, tuple[int, int, int]]]:
    """The bytes of ids, a chunk at a time, and the state of the UTF-8 machine after each.

    Text is valid if the state never is BROKEN and ends as START. Tokens of whole characters
    leave START as it is, so the machine only walks over the others and those beside them.
    """
    state = START
    for at in range(0, len(ids), chunk):
        part = ids[at : at + chunk]
        found = words.tokens.take(pa.array(part))
        first, last = found.offset, found.offset + len(found)
        offsets = np.frombuffer(found.buffers()[1], np.int32)[first : last + 1]
        data = found.buffers()[2]
        place = 0
        opened = np.flatnonzero(~words.closed[part])
        for i in opened.tolist():
            if state != START and i > place:
                state = words.step(state, int(part[place]))  # a closed token cannot go on a character
            state = words.step(state, int(part[i]))
            place = i + 1
        if state != START and place < len(part):
            state = words.step(state, int(part[place]))
        yield (data.to_pybytes()[offsets[0] : offsets[-1]] if data else b""), state


def decode_text(ids: Iterable[int], words: Vocabulary) -> str:
    """The text of ids; bytes that are no UTF-8 become U+FFFD."""
    return b"".join(part for part, _ in decoded(np.fromiter(ids, np.int64), words)).decode("utf-8", "replace")


def encoded(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, ids array<int>) of every text; null and empty texts have no ids."""
    rows = docs.select(F.col(id_column).alias(id_column), F.col(text_column).alias("text"))
    kind = rows.schema[id_column].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, pattern).ids
        for batch in small_batches(batches, "text"):
            with no_cycles():
                found = [np.frombuffer(encode(text or ""), "<u4").astype(np.int32) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], [id_column, "ids"])

    return map_batches(rows, work, f"`{id_column}` {kind}, ids array<int>")


def round_trip(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256, valid) of every text, encoded and decoded again.

    The digests are of the ids as little-endian uint32 and of the decoded bytes; `valid`
    says that these are UTF-8. Null and empty texts have no tokens. Rows are taken one by
    one, without a shuffle; repeated rows and null ids stay, an empty table gives no rows.
    """
    rows = docs.select(F.col(id_column).alias(id_column), F.col(text_column).alias("text"))
    kind = rows.schema[id_column].dataType.simpleString()
    names = [id_column, "n_tokens", "ids_sha256", "decoded_sha256", "valid"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, words = encoder(path, pattern).ids, vocabulary(path)
        for batch in small_batches(batches, "text"):
            found, column = [], batch.column(1).to_pylist()
            with no_cycles():
                all_ids = [encode(text or "") for text in column]
            for ids in all_ids:
                digest, state, valid = hashlib.sha256(), START, True
                for part, state in decoded(np.frombuffer(ids, "<u4"), words):
                    digest.update(part)
                    valid &= state != BROKEN
                found.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), digest.hexdigest(), valid and state == START))
            if found:
                yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, zip(*found, strict=True))], names)

    return map_batches(rows, work, f"`{id_column}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, valid boolean")
