"""Texts encoded word by word, equal words once.

A text is cut before every single space that stands between two characters that are no white space. Byte-level BPE with its
usual pattern and sentencepiece BPE with escaped spaces both begin a token there and merge nothing across, so the ids of
the words, joined, are the ids of the text. Words repeat far more often than texts do; a Python worker keeps the results of
short ones, in two generations of bounded size.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import chain
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: White space of both tokenizers and sentencepiece's own sign for a space, beside which nothing is cut.
BLANK, FULL = r"[\s▁]", r"[^\s▁]"
PIECE = re.compile(rf"{BLANK}*{FULL}+(?:(?! {FULL}){BLANK}+{FULL}*)*|{BLANK}+")
OTHER_BLANKS = [c for c in map(chr, range(0x3001)) if re.match(BLANK, c) and c not in " \n"]
UNUSUAL = ["\0", *OTHER_BLANKS]  # what a joined word has not, with the added tokens
#: Fixed value: the pattern of byte-level BPE.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
LONGEST, MOST = 80, 550_000  # characters of a word that is kept; words of a generation
JOINED = 20_000  # fresh words in one call of the library
GATHERED = 1 << 18  # words whose ids are gathered at a time


def words_of(text: str, lines: bool = False) -> list[str]:
    """The first word and the others without the space they are cut at. With `lines`, the text is also cut before single
    line ends between words, which stay: such words begin with \\n."""
    if has_odd_blanks(text):
        first, *others = PIECE.findall(text) or [""]
        return [first, *(p[1:] for p in others)]
    return (spaced_lines(text) if lines else text).split(" ")


def has_odd_blanks(text: str) -> bool:
    return "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " " or any(c in text for c in OTHER_BLANKS)


def spaced_lines(text: str) -> str:
    """The text with a space before each line end, if all of them are single ones between words."""
    if "\n" in text and "\n\n" not in text and text[0] != "\n" and text[-1] != "\n":
        return text.replace("\n", " \n")
    return text


def split_texts(texts: list[str], odd: bool) -> tuple[list[str], pa.ListArray]:
    """`words_of`, with lines, of texts that all have odd blanks or all have none: the first words and the others."""
    if odd:
        words = [words_of(t, lines=True) for t in texts]
        return [w[0] for w in words], pa.array([w[1:] for w in words], pa.list_(pa.large_string()))
    parts = [spaced_lines(t).partition(" ") for t in texts]
    others = pc.split_pattern(pa.array([rest if space else None for _, space, rest in parts], pa.large_string()), " ")
    return [p[0] for p in parts], others


class Cache:
    """Results of a function from distinct words to a dictionary. When the newer generation is full, it becomes the older one."""

    def __init__(self, function: Callable[[list[str]], dict[str, Any]], most: int = MOST):
        self.function, self.most = function, most
        self.newer: dict[str, Any] = {}
        self.older: dict[str, Any] = {}
        self.passing: list[str] = []

    def look_up(self, words: set[str]) -> dict[str, Any]:
        """A dictionary that has at least these words, until the next call."""
        for word in self.passing:
            del self.newer[word]
        if len(self.newer) > self.most:
            self.newer, self.older = {}, self.newer
        missing = words.difference(self.newer)
        known = missing & self.older.keys()
        self.newer.update((w, self.older[w]) for w in known)
        fresh = list(missing - known)
        self.newer.update(self.function(fresh))
        self.passing = [w for w in fresh if len(w) > LONGEST]
        return self.newer


class Numbers(dict):
    """Words' numbers, given at the first look-up, and the packed ids of all of them in one array; `starts` and `sizes` are by number."""

    def __init__(self, width: str):
        super().__init__()
        self.fresh: list[str] = []  # numbered, their ids not known yet
        self.given = self.used = 0
        self.ids, self.starts, self.sizes = np.zeros(1 << 16, width), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def __missing__(self, word: str) -> int:
        self[word] = number = self.given
        self.given += 1
        self.fresh.append(word)
        return number

    def add(self, found: dict[str, bytes]) -> list[str]:
        """Places the ids of the fresh words and returns the long ones. Their ids stand behind the others, and the next call overwrites them."""
        words, self.fresh = self.fresh, []
        long = [w for w in words if len(w) > LONGEST]
        order = np.argsort([len(w) > LONGEST for w in words], kind="stable") if long else np.arange(len(words))
        data = [found[words[i]] for i in order.tolist()] if long else [found[w] for w in words]
        sizes = np.fromiter(map(len, data), np.int64, len(data)) // self.ids.itemsize
        ends = self.used + np.cumsum(sizes)
        stop, numbers = int(ends[-1]), self.given - len(words) + order
        if stop > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(2 * stop - self.used, self.ids.dtype)])
        if self.given > len(self.sizes):
            self.starts, self.sizes = (np.concatenate([a, np.zeros(2 * self.given - len(a), np.int64)]) for a in (self.starts, self.sizes))
        self.ids[self.used : stop] = np.frombuffer(b"".join(data), self.ids.dtype)
        self.starts[numbers], self.sizes[numbers] = ends - sizes, sizes
        self.used = int(ends[len(words) - len(long) - 1]) if len(long) < len(words) else self.used
        return long

    def known(self, word: str) -> bytes:
        start = self.starts[self[word]]
        return self.ids[start : start + self.sizes[self[word]]].tobytes()

    def gather(self, numbers: np.ndarray) -> bytes:
        sizes = self.sizes[numbers]
        stops = np.cumsum(sizes)
        return self.ids[np.arange(sizes.sum()) + np.repeat(self.starts[numbers] - stops + sizes, sizes)].tobytes()


class IdCache:
    """Ids of texts from their words: one look-up a word gives its number, and the ids of all are gathered at once.

    Bounded as `Cache`: two generations, of which long words are no part.
    """

    def __init__(self, function: Callable[[list[str]], dict[str, bytes]], width: str, most: int = MOST):
        self.function, self.width, self.most = function, width, most
        self.newer, self.older = Numbers(width), Numbers(width)

    def __call__(self, firsts: list[str], others: pa.ListArray) -> list[bytes]:
        """Ids of texts from their first words, which come as keys of their own, and the others."""
        if len(self.newer) > self.most:
            self.newer, self.older = Numbers(self.width), self.newer
        here, long = self.newer, []
        words = others.flatten().dictionary_encode()  # the words of a call repeat as well
        ask = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        numbers = np.fromiter(map(here.__getitem__, chain(ask, firsts)), np.int64, len(ask) + len(firsts))
        counts = pc.fill_null(pc.list_value_length(others), 0).to_numpy()
        numbers = np.insert(numbers[words.indices.to_numpy()], np.cumsum(counts) - counts, numbers[len(ask) :])
        if here.fresh:
            found = {w: self.older.known(w) for w in here.fresh if w in self.older}
            found.update(self.function([w for w in here.fresh if w not in found]))
            long = here.add(found)
        data = b"".join(here.gather(numbers[i : i + GATHERED]) for i in range(0, len(numbers), GATHERED))
        for word in long:
            del here[word]
        stops = np.cumsum(here.sizes[numbers])
        edges = [0, *(stops[np.cumsum(counts + 1) - 1] * here.ids.itemsize).tolist()]
        return [data[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]


CACHES: dict[tuple, Any] = {}


def shared_cache(*key: Any, make: Callable[[], Callable[[list[str]], dict[str, Any]]], most: int = MOST) -> Cache:
    """The worker's cache of this key; `make` builds its function the first time."""
    if key not in CACHES:
        CACHES[key] = Cache(make(), most)
    return CACHES[key]


def byte_alphabet() -> dict[str, int]:
    """Byte-level BPE's characters and the bytes they stand for: printable ones for themselves, others in a row from 256."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


def byte_tokens(tokenizer) -> list[bytes]:
    """Bytes of each id of a byte-level tokenizer; added tokens are plain text."""
    alphabet, added = byte_alphabet(), tokenizer.get_added_tokens_decoder()
    names = [tokenizer.id_to_token(i) for i in range(tokenizer.get_vocab_size())]
    return [added[i].content.encode() if i in added else bytes(alphabet[c] for c in name) for i, name in enumerate(names)]


class WordEncoder:
    """Ids of words that follow a space, as packed integers of `width`.

    Words go to the library's model in long joins, already split by the byte-level pattern, and the ids are told apart by
    their bytes. Words that end in white space or hold an added token go to the whole tokenizer, one by one.
    """

    def __init__(self, tokenizer, width: str = "<u4"):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.width = tokenizer, width
        self.size = np.dtype(width).itemsize
        self.lengths = np.array([len(t) for t in byte_tokens(tokenizer)], dtype=np.int64)
        self.added = [] if tokenizer.encode_special_tokens else [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.model = Tokenizer(tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.letters = {chr(b): c for c, b in byte_alphabet().items() if chr(b) != c}

    def texts(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts by the whole tokenizer."""
        return [np.array(e.ids, dtype=self.width).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def join(self, words: list[str], joined: str) -> list[bytes]:
        shown = "\0".join(PATTERN.findall(joined)).encode().decode("latin-1")
        for plain, letter in self.letters.items():
            if plain != "\0" and plain in shown:
                shown = shown.replace(plain, letter)
        (found,) = self.model.encode_batch_fast([shown.replace("\0", " ")], add_special_tokens=False)
        ids = np.array(found.ids, dtype=np.int64)
        own = [len(w) for w in words] if joined.isascii() else [len(w.encode()) for w in words]
        ends = np.cumsum(own) + (np.arange(1, len(own) + 1) if joined[0] == " " else 0)
        stops = np.cumsum(self.lengths[ids])
        places = np.searchsorted(stops, ends)
        if not np.array_equal(stops[np.minimum(places, len(stops) - 1)], ends):
            raise ValueError("a token crosses the cut between two words")
        data, edges = ids.astype(self.width).tobytes(), [0, *((places + 1) * self.size).tolist()]
        return [data[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]

    def spaced(self, words: list[str]) -> list[bytes]:
        """As a call, but words that begin with a line end follow a space as well."""
        odd = [i for i, w in enumerate(words) if w[:1] == "\n"]
        found = self([w for w in words if w[:1] != "\n"])
        for i, ids in zip(odd, self.texts([" " + words[i] for i in odd]), strict=True):
            found.insert(i, ids)
        return found

    def __call__(self, words: list[str]) -> list[bytes]:
        found = self.look(words)
        return [found[w] for w in words]

    def look(self, words: list[str]) -> dict[str, bytes]:
        found: dict[str, bytes] = {}
        every, plain = " ".join(words), words
        if "  " in every or "\n " in every or every[-1:] in " \n" or any(c in every for c in UNUSUAL) or any(a in every for a in self.added):
            plain = [w for w in words if w and not w[-1].isspace() and w[-1] != "▁" and (w[0] == "\n" or not w[0].isspace()) and "\0" not in w]
            plain = [w for w in plain if not any(a in w for a in self.added)]
        for begin, part in (("\n", [w for w in plain if w[0] == "\n"]), (" ", [w for w in plain if w[0] != "\n"])):
            for start in range(0, len(part), JOINED):
                some = part[start : start + JOINED]
                found.update(zip(some, self.join(some, "".join(some) if begin == "\n" else " " + " ".join(some)), strict=True))
        rest = [w for w in words if w not in found] if len(found) < len(words) else []
        found.update(zip(rest, self.texts([w if w[:1] == "\n" else " " + w for w in rest]), strict=True))
        return found
