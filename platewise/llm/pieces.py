"""Byte-level BPE of whole Arrow batches with the tokenizers library.

The split pattern of these vocabularies gives pieces that are encoded each by itself, so the ids of a text are the ids of
its pieces back to back. A batch is split into pieces with array operations on its bytes, the library's model encodes every
*different* piece once, and the ids are laid out again in text order. Pieces that a worker has met before come from a table of
bounded size.

The class of a character is taken from the Unicode tables. A text with a code point that Python's tables do not know is
split by the library itself, so a difference between Unicode versions cannot change a result.
"""

from __future__ import annotations

import base64
import functools
import json
import os
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from tokenizers import Regex, Tokenizer, decoders, models, pre_tokenizers

from platewise.llm.arrays import RunHash, byte_values, ranges, text_bytes

KNOWN_PIECES = 800_000  # pieces that a worker remembers, about 40 bytes each
ENCODED_BYTES = 1 << 20  # text bytes encoded at once: the more, the more pieces repeat
RECENT_PIECES = 50_000  # of these, the ones that there is room for at first
LONG_PIECE = 48  # bytes; longer pieces are compared as text

_LETTER, _NUMBER, _SPACE, _OTHER, _UNKNOWN = range(5)
_MARK = ord("'")


@functools.cache
def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves; the others, in order, for the code points from 256 on.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


@functools.cache
def _byte_of() -> dict[str, int]:
    return {c: b for b, c in enumerate(byte_characters())}


def characters(token: bytes) -> str:
    table = byte_characters()
    return "".join(table[b] for b in token)


def token_bytes(token: str) -> bytes:
    """The bytes that a vocabulary entry stands for; an entry with another character, such as a special one, is UTF-8."""
    table = _byte_of()
    return bytes(table[c] for c in token) if all(c in table for c in token) else token.encode()


def tokenizer_from_ranks(ranks: dict[bytes, int], pattern: str) -> Tokenizer:
    """A tokenizer of the library that merges as the ranks say: always the adjacent pair whose joint token ranks lowest."""
    merges = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        for cut in range(1, len(token)):
            if token[:cut] in ranks and token[cut:] in ranks:
                merges.append((characters(token[:cut]), characters(token[cut:])))
    vocabulary = {characters(token): rank for token, rank in ranks.items()}
    out = Tokenizer(models.BPE(vocab=vocabulary, merges=merges, ignore_merges=True))
    out.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    out.decoder = decoders.ByteLevel()
    return out


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@functools.lru_cache(maxsize=4)
def definition(path: str, pattern: str) -> str:
    """The tokenizer in the library's own format. The file is read on the driver only."""
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as file:
            return file.read()
    return tokenizer_from_ranks(read_ranks(path), pattern).to_str()


def share(spark: SparkSession, path: str, pattern: str):
    """Broadcast definition; its size is that of the vocabulary file, whatever the corpus."""
    return spark.sparkContext.broadcast(definition(path, pattern))


@functools.cache
def _classes(plane: int) -> np.ndarray:
    """Classes of the 65,536 code points of a plane."""
    table = np.full(1 << 16, _OTHER, np.uint8)
    for low in range(1 << 16):
        point = plane << 16 | low
        c = chr(point)
        category = unicodedata.category(c)
        if category[0] == "L":
            table[low] = _LETTER
        elif category[0] == "N":
            table[low] = _NUMBER
        elif c.isspace() and not 0x1C <= point <= 0x1F:
            table[low] = _SPACE
        elif category == "Cn":
            table[low] = _UNKNOWN
    return table


def byte_classes(data: np.ndarray) -> np.ndarray:
    """The class of the character that each byte of valid UTF-8 belongs to."""
    classes = _classes(0)[:256][data]
    lead = np.flatnonzero(data >= 0xC0)
    if not len(lead):
        return classes
    a = data[lead].astype(np.int32)
    three, four = np.flatnonzero(a >= 0xE0), np.flatnonzero(a >= 0xF0)
    points = (a & 0x1F) << 6 | data[lead + 1] & 0x3F
    points[three] = (points[three] & 0x3FF) << 6 | data[lead[three] + 2] & 0x3F
    points[four] = (points[four] & 0x7FFF) << 6 | data[lead[four] + 3] & 0x3F
    found = _classes(0)[points & 0xFFFF]
    for plane in np.unique(points[four] >> 16).tolist():
        mine = four[points[four] >> 16 == plane]
        found[mine] = _classes(plane)[points[mine] & 0xFFFF]
    classes[lead] = classes[lead + 1] = found
    classes[lead[three] + 2] = found[three]
    classes[lead[four] + 3] = found[four]
    return classes


def piece_starts(data: np.ndarray, begins: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Where each piece of texts given as UTF-8 back to back begins.

    Runs of letters, of numbers and of other signs take one space before them along; a run of white space gives up its last
    character to what follows; 's 't 're 've 'm 'll 'd are pieces where a piece would begin at the mark.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    head = np.zeros(n + 1, bool)
    head[begins] = True
    space = classes == _SPACE
    start = np.ones(n, bool)
    start[1:] = classes[1:] != classes[:-1]
    start[1:] &= space[1:] | (data[:-1] != 0x20)
    start |= head[:n]
    last = np.flatnonzero(space[:-1] & ~(space[1:] | head[1:n]))  # the last byte of the run
    for _ in range(3):
        last -= (data[last] & 0xC0) == 0x80
    start[last] = True
    marks = np.flatnonzero((data == _MARK) & start)
    if len(marks):
        padded = np.zeros(n + 2, data.dtype)
        padded[:n] = data
        ends = np.append(begins[begins > 0], n)
        room = ends[np.searchsorted(ends, marks, side="right")] - marks - 1
        a, b = padded[marks + 1], padded[marks + 2]
        single = np.isin(a, [ord(c) for c in "stmd"])
        double = np.zeros(len(marks), bool)
        for x, y in ("re", "ve", "ll"):
            double |= (a == ord(x)) & (b == ord(y))
        size = np.where((room >= 1) & single, 1, np.where((room >= 2) & double, 2, 0))
        for length in (1, 2):
            at = marks[size == length]
            for k in range(1, length + 1):
                start[at + k] = False
            after = at + length + 1
            start[after[after < n]] = True
    return np.flatnonzero(start)


@dataclass
class Encoded:
    """Ids of a slice of texts back to back, and what is needed to place them."""

    ids: np.ndarray  # int32
    first: np.ndarray  # index of the first id of each text, n + 1


class ByteTable:
    """The bytes behind each id."""

    def __init__(self, definition: str) -> None:
        parsed = json.loads(definition)
        entries = parsed["model"]["vocab"] | {t["content"]: t["id"] for t in parsed.get("added_tokens", [])}
        bytes_of = [b""] * (max(entries.values()) + 1)
        for token, i in entries.items():
            bytes_of[i] = token_bytes(token)
        self.length = np.array([len(b) for b in bytes_of], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(bytes_of), np.uint8)

    def decode(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the ids back to back, and where those of each text begin."""
        length = self.length[ids]
        place = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(length, out=place[1:])
        return self.flat[ranges(self.start[ids], length)], place[first]

    def offsets(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last (exclusive) code point of each id within its text.

        An id that begins or ends inside a character covers that character; neighbours may then share it.
        """
        data, begins = self.decode(ids, first)
        points = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=points[1:])
        place = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(self.length[ids], out=place[1:])
        base = np.repeat(points[begins[:-1]], np.diff(first))
        inside = np.zeros(len(data) + 1, bool)
        inside[:-1] = (data & 0xC0) == 0x80
        start = points[place[:-1]] - inside[place[:-1]]
        return start - base, points[place[1:]] - base


def _appended(values: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """``values`` with ``more`` behind the first ``used``; doubled where there is no room."""
    if used + len(more) > len(values):
        values = np.concatenate([values[:used], np.zeros(max(used, len(more)), values.dtype)])
    values[used : used + len(more)] = more
    return values


def _replaced(ids: np.ndarray, first: np.ndarray, rows: dict[int, list[int]]) -> Encoded:
    """The ids with those of some texts replaced."""
    parts, at, lengths = [], 0, np.diff(first)
    for k in sorted(rows):
        parts += [ids[at : first[k]], np.array(rows[k], np.int32)]
        at, lengths[k] = first[k + 1], len(rows[k])
    return Encoded(np.concatenate([*parts, ids[at:]]), np.concatenate([[0], np.cumsum(lengths)]))


class KeyTable:
    """The number noted for each of many different 64-bit keys, in open addressing: whole arrays of keys step on together."""

    def __init__(self, room: int) -> None:
        self.n = 0
        self._clear(1 << max(4, (2 * room - 1).bit_length()))

    def _clear(self, size: int) -> None:
        self.keys = np.zeros(size, np.uint64)  # 0: free
        self.numbers = np.zeros(size, np.int32)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys & np.uint64(len(self.keys) - 1)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for those not noted."""
        out = np.full(len(keys), -1, np.int32)
        left, at = np.arange(len(keys)), self._place(keys)
        while len(left):
            here = self.keys[at]
            same = here == keys[left]
            out[left[same]] = self.numbers[at[same]]
            on = ~same & (here != 0)
            left, at = left[on], (at[on] + 1) & (len(self.keys) - 1)
        return out

    def add(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        """Note keys that are not in the table; it doubles before half of it is full."""
        self.n += len(keys)
        if 2 * self.n > len(self.keys):
            full = self.keys != 0
            keys, numbers = np.concatenate([self.keys[full], keys]), np.concatenate([self.numbers[full], numbers])
            self._clear(1 << (2 * self.n).bit_length())
        left, at = np.arange(len(keys)), self._place(keys)
        while len(left):
            free = self.keys[at] == 0
            self.keys[at[free]] = keys[left[free]]
            mine = self.keys[at] == keys[left]  # of several keys at one free place the last has it
            self.numbers[at[mine]] = numbers[left[mine]]
            left, at = left[~mine], (at[~mine] + 1) & (len(self.keys) - 1)


class Encoder:
    """Encodes slices of texts; lives as long as the worker."""

    def __init__(self, definition: str, known: int = KNOWN_PIECES, recent: int = RECENT_PIECES) -> None:
        self.definition = definition
        self.model = Tokenizer.from_str(definition).model
        self.character = np.array([ord(c) for c in byte_characters()], np.uint16)
        self.limit, self.room = known, recent
        self._forget()

    @functools.cached_property
    def tokenizer(self) -> Tokenizer:
        """The library's own way with whole texts; needed for rare texts only."""
        out = Tokenizer.from_str(self.definition)
        out.encode_special_tokens = True
        return out

    def _forget(self) -> None:
        self.slots = KeyTable(self.room)
        self.flat, self.n_flat = np.zeros(1 << 16, np.int32), 0  # ids of all known pieces back to back, with room to grow
        self.length, self.offset, self.n_known = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32), 0

    def _pieces(self, data: np.ndarray, first: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the wanted pieces back to back and the number of each, from the library's model."""
        size = first[wanted + 1] - first[wanted]
        text = self.character[data[ranges(first[wanted], size)]].tobytes().decode("utf-16-le")
        ends = np.cumsum(size).tolist()
        ids, lengths, tokenize = [], [], self.model.tokenize
        for a, b in zip([0, *ends], ends):
            found = [token.id for token in tokenize(text[a:b])]
            ids += found
            lengths.append(len(found))
        return np.array(ids, np.int32), np.array(lengths, np.int32)

    def _different(self, data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different pieces back to back and the number of each; the library encodes those not met before."""
        if self.n_known > self.limit:
            self._forget()
        keys = RunHash(byte_values()[data]).of(first[:-1], first[1:])
        keys[keys == 0] = 1
        slots = self.slots.find(keys)
        long = np.diff(first) > LONG_PIECE
        slots[long] = -1
        new = np.flatnonzero(slots < 0)
        new = new[np.argsort(long[new], kind="stable")]  # the long ones last: they are not kept
        ids, lengths = self._pieces(data, first, new)
        slots[new] = np.arange(self.n_known, self.n_known + len(new))
        self.offset = _appended(self.offset, self.n_known, self.n_flat + np.cumsum(lengths) - lengths)
        self.length = _appended(self.length, self.n_known, lengths)
        self.flat = _appended(self.flat, self.n_flat, ids)
        length = self.length[slots]
        out = self.flat[ranges(self.offset[slots], length)]
        kept = len(new) - int(long.sum())
        self.slots.add(keys[new[:kept]], slots[new[:kept]])
        self.n_known, self.n_flat = self.n_known + kept, self.n_flat + int(lengths[:kept].sum())
        return out, length

    def encode(self, column: pa.Array) -> Encoded:
        data, begins = text_bytes(column)
        if not len(data):
            return Encoded(np.zeros(0, np.int32), np.zeros(len(begins), np.int64))
        if data.max() >= 0x80:
            data.tobytes().decode("utf-8")  # an error, if it isn't UTF-8
        classes = byte_classes(data)
        start = piece_starts(data, begins[:-1], classes)
        places = pa.py_buffer(np.append(start, len(data)).astype(np.int32))
        pieces = pa.Array.from_buffers(pa.binary(), len(start), [None, places, pa.py_buffer(data)]).dictionary_encode()
        codes = pieces.indices.to_numpy()
        ids, length = self._different(*text_bytes(pieces.dictionary))
        offset = np.cumsum(length, dtype=np.int64) - length
        length = length[codes]
        ids = ids[ranges(offset[codes], length)]
        place = np.zeros(len(start) + 1, np.int64)
        np.cumsum(length, out=place[1:])
        first = place[np.searchsorted(start, begins)]
        unknown = np.flatnonzero(classes == _UNKNOWN)
        if not len(unknown):
            return Encoded(ids, first)
        texts = np.unique(np.searchsorted(begins, unknown, side="right") - 1).tolist()
        whole = {t: data[begins[t] : begins[t + 1]].tobytes().decode("utf-8") for t in texts}
        return _replaced(ids, first, {t: self.tokenizer.encode(x, add_special_tokens=False).ids for t, x in whole.items()})

    @functools.cached_property
    def added(self) -> list[str]:
        """Texts that the definition has an id of their own for."""
        return [t["content"] for t in json.loads(self.definition).get("added_tokens", [])]

    @functools.cached_property
    def marking(self) -> Tokenizer:
        """The library with its default setting, which gives added tokens their id."""
        return Tokenizer.from_str(self.definition)

    def encode_marked(self, column: pa.Array) -> Encoded:
        """As ``encode``, but texts that hold an added token go to the library whole."""
        got = self.encode(column)
        hit = np.zeros(len(column), bool)
        for content in self.added:
            hit |= pc.fill_null(pc.match_substring(column, content), False).to_numpy(zero_copy_only=False)
        if not hit.any():
            return got
        whole = {k: self.marking.encode(column[k].as_py(), add_special_tokens=False).ids for k in np.flatnonzero(hit).tolist()}
        return _replaced(got.ids, got.first, whole)


@functools.lru_cache(maxsize=2)
def _encoder(definition: str) -> Encoder:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Encoder(definition)


def encoder(shared) -> Encoder:
    """The worker's encoder for a broadcast definition."""
    return _encoder(shared.value)


def release() -> None:
    """Give the worker's memory back, for jobs in which other operators follow."""
    _encoder.cache_clear()


@functools.lru_cache(maxsize=2)
def _byte_table(definition: str) -> ByteTable:
    return ByteTable(definition)


def byte_table(shared) -> ByteTable:
    """The worker's byte table for a broadcast definition."""
    return _byte_table(shared.value)


def vocabulary_size(definition: str) -> int:
    parsed = json.loads(definition)
    return 1 + max([*parsed["model"]["vocab"].values(), *(t["id"] for t in parsed.get("added_tokens", []))])
