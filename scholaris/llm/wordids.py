"""Token ids by a `tokenizers` file whose tokens never cross white space.

Words repeat, so the library tokenizes each distinct word once and a task joins the stored
ids. Memory is bounded: words that have not been met for long are forgotten.
"""

import functools
import re
from array import array
from collections.abc import Callable
from os.path import commonprefix

from tokenizers import Tokenizer

# What the file's pre-tokenizer never joins: a run of letters, and a run of ASCII that
# holds neither letters nor an apostrophe. Letters are a to z and the small ones of
# Latin-1, in UTF-8; words with anything else go to the library whole, so that in what is
# looked at here a byte beyond ASCII is part of such a letter.
_RUNS = re.compile(rb"[a-z\x80-\xbf\xc3]+|[!-&(-@\[-`{-~]+")
# From the first character of a word that is neither to the word's end, in text whose only
# white space is the space. Bytes of a character after its first are left to the first.
_OTHERS = re.compile(rb"(?:[^ !-&(-@\[-`a-~\x80-\xbf\xc3]|\xc3(?![\x9f-\xb6\xb8-\xbf]))[^ ]*")
_SPACES = bytes(32 if b in b"\t\n\x0b\x0c\r" else b for b in range(256))
_LETTER_STARTS = frozenset(b"abcdefghijklmnopqrstuvwxyz\xc3")
MOST_WORDS, MOST_RUNS = 50_000, 400_000


def _byte_characters() -> dict[int, str]:
    """The usual printable stand-ins of byte-level vocabularies, by byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _packed(ids: list[int]) -> bytes:
    """Ids as uint32 of the machine's order, which is little-endian wherever Spark runs on x86 or ARM."""
    return array("I", ids).tobytes()


class _Store(dict):
    """What `make` gives for a key; of keys used lately, two generations of at most `most` are kept."""

    def __init__(self, make: Callable[[bytes], bytes], most: int):
        super().__init__()
        self.make, self.most = make, most
        self.old: dict[bytes, bytes] = {}

    def __missing__(self, key: bytes) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class WordIds:
    """ids(text): the ids the library gives for a whole text, as little-endian uint32 bytes.

    For files that compose characters (NFC), lower-case, and then split at white space and
    between letters and other characters. A special token's string, as it stands there and not
    in other letters, is that token, as the library has it; the texts between are tokenized
    by themselves.
    """

    def __init__(self, path: str, most_words: int = MOST_WORDS, most_runs: int = MOST_RUNS):
        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.normalized or t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError("added tokens that take in what stands around them")
        self.special = {t.content.encode(): _packed([i]) for i, t in added.items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.special_strings = re.compile(b"(" + b"|".join(map(re.escape, longest_first)) + b")")
        # A plain search for how they all begin settles nearly every text.
        self.special_start = commonprefix(longest_first) if added else None
        # What is left between them goes to the library in small letters, and holds none.
        self.tokenizer.encode_special_tokens = True
        # The narrowest numbers that hold every id.
        self.kind = "<u2" if self.tokenizer.get_vocab_size(True) <= 1 << 16 else "<u4"
        self.model = self.tokenizer.model
        self.characters = {i: c for i, c in _byte_characters().items() if chr(i) != c}
        self.runs = _Store(self._run, most_runs)
        self.words = _Store(self._library, most_words)

    def _library(self, text: bytes) -> bytes:
        return _packed(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids)

    def _run(self, run: bytes) -> bytes:
        if run[0] not in _LETTER_STARTS:
            return self._library(run)
        # One pre-token that normalisation leaves as it is: straight to the merges.
        characters = run.decode() if run.isascii() else run.decode("latin-1").translate(self.characters)
        return _packed([token.id for token in self.model.tokenize(characters)])

    def ids(self, text: bytes) -> bytes:
        if self.special_start is not None and self.special_start in text and self.special_strings.search(text):
            parts = self.special_strings.split(text)
            return b"".join([self.special[x] if i % 2 else self._plain_ids(x) for i, x in enumerate(parts)])
        return self._plain_ids(text)

    def _plain_ids(self, text: bytes) -> bytes:
        # Lower-casing ASCII first merges words that differ in case only. A combining mark
        # (U+0300 to U+036F) could compose differently with the small letter.
        if b"\xcc" not in text and b"\xcd" not in text:
            text = text.lower()
        text = text.translate(_SPACES)
        # Words with other characters are looked up whole, all between them run by run.
        found, start = [], 0
        for other in _OTHERS.finditer(text):
            left = text.rfind(b" ", start, other.start()) + 1 or start
            found += map(self.runs.__getitem__, _RUNS.findall(text, start, left))
            start = other.end()
            found.append(self.words[text[left:start]])
        found += map(self.runs.__getitem__, _RUNS.findall(text, start))
        return b"".join(found)


@functools.lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One for a worker process, so that later tasks find the words of earlier ones."""
    return WordIds(path)
