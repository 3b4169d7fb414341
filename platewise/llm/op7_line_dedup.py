"""Fuzzy line de-duplication: SimHash, pigeonhole blocks, edit similarity, one occurrence per connected group.

A line is normalised to its words: ASCII capitals lower-cased, all but letters, digits and what is beyond ASCII dropped; digits count as
they are. Equal normalised lines are one node, whatever their number. A line's SimHash has 64 bits, each the majority of its different words' hashes, in eight
blocks of eight bits. Two nodes are candidates if two or more of their blocks agree and at most ten bits differ, and linked if their edit similarity in words,
1 - distance / longer length, is 0.8 or more (words are compared by a code of 41,984 values).

By the pigeonhole principle no pair is missed whose SimHashes differ in six bits or fewer; pairs that differ in seven to ten are found if their differences leave two
blocks alone. The README has the share of links, by edit similarity alone, that this finds. Whether two lines are linked depends on the two lines only.

First all SimHashes are compared within their buckets (two blocks and their values), packed into arrays. Near ones whose lengths, or the parities of the
numbers of words in 64 classes, rule out the similarity are no candidates: an edit step changes two classes at most. That leaves the nodes that have a
near one, in groups of which each is near some other. Only these enter the linking, which never makes all pairs of a group. Of each connected group the occurrence with the smallest (doc_id, line number) stays.

Edge cases: lines of fewer than five words stay and are no occurrences. A null text has no lines, an empty one a single empty
line. Rows with one doc_id and one text count as one document; rows with one doc_id and different texts are different documents. Documents without a doc_id stay as they
are. A document goes only if lines of it were removed and no word is left. Other columns are kept by ``deduplicate``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platewise.llm.arrays import LETTERS_AND_DIGITS, RunHash, Words, let_workers_import, mix, ranges, slices, split_words, text_bytes
from platewise.llm.linking import link_groups
from platewise.llm.steps import settled

WORDS = 5
SIMILARITY = 0.8
BLOCKS, SAME = 8, 2  # blocks of a SimHash, and how many of them candidates share
NEAR_BITS = 10  # most bits in which candidates may differ: three in 100,000 unlike lines that share two blocks are as near as that
ROWS = 256  # lines of a bucket up to which all buckets are compared together
AT_ONCE = 1 << 20  # pairs compared at once in a larger bucket, and near pairs held before they are shortened to chains
PACKED_ROWS = 1 << 16  # nodes packed together

_NEWLINE = 0x0A
_PACKED = 1 << 24  # lines whose number fits above 40 bits
_LANE_MOST = 255
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64).ravel()  # the bits of a byte, one to a byte
_CODES = (0x3400, 41_984)  # first code point and number of the codes that stand for words


def split_lines(column: pa.Array) -> tuple[Words, np.ndarray]:
    """Words by line of all texts back to back, and the number of lines of each text."""
    data, begins = text_bytes(column)
    breaks = np.flatnonzero(data == _NEWLINE) + 1
    present = np.asarray(column.is_valid())
    starts = np.concatenate([begins[:-1][present], breaks])
    owner = np.concatenate([np.flatnonzero(present), np.searchsorted(begins, breaks - 1, side="right") - 1])
    order = np.lexsort((starts, owner))
    counts = np.bincount(owner, minlength=len(column))
    return split_words(data, np.append(starts[order], len(data)), LETTERS_AND_DIGITS), counts


def line_keys(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that stand for the normalised line."""
    low, high = words.first[:-1], words.first[1:]
    a = RunHash(words.hashes).of(low, high)
    b = RunHash(mix(words.hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5))).of(low, high)
    return a.view(np.int64), b.view(np.int64)


def simhash(words: Words) -> np.ndarray:
    """For each line, the bits that are set in more than half of the hashes of its different words."""
    lines = len(words.first) - 1
    out = np.zeros(lines, np.int64)
    for low in range(0, lines, _PACKED):  # one round but for texts of millions of lines
        first = words.first[low : low + _PACKED + 1]
        line = np.repeat(np.arange(len(first) - 1, dtype=np.uint64), np.diff(first))
        # Line number above 40 bits of the word's hash: one sort brings equal words of a line together.
        features = np.sort(line << np.uint64(40) | words.hashes[first[0] : first[-1]] >> np.uint64(24))
        if len(features):
            features = features[np.append(True, features[1:] != features[:-1])]  # six times as fast as np.unique
            owner = (features >> np.uint64(40)).astype(np.int64)
            begin = np.flatnonzero(np.diff(owner, prepend=-1))
            size = np.diff(np.append(begin, len(features)))
            # Eight counters of eight bits are added at once, so a longer line is counted in parts.
            parts = -(-size // _LANE_MOST)
            part = np.cumsum(parts) - parts
            cut = np.repeat(begin - part * _LANE_MOST, parts) + np.arange(parts.sum()) * _LANE_MOST
            hashed = mix(features << np.uint64(24)).view(np.uint8).reshape(-1, 8)
            set_ = np.empty((len(begin), 64), np.int32)
            for k in range(8):
                counts = np.add.reduceat(_LANES[hashed[:, k]], cut).view(np.uint8).reshape(-1, 8)
                set_[:, 8 * k : 8 * k + 8] = np.add.reduceat(counts, part, axis=0, dtype=np.int32)
            out[low + owner[begin]] = np.packbits(2 * set_ > size[:, None], axis=1).view(np.int64).ravel()
    return out


_CHOICES = list(combinations(range(BLOCKS), SAME))


def block_keys(hashes: np.ndarray) -> np.ndarray:
    """Keys of each SimHash (rows): one for each choice of two blocks, with their values."""
    blocks = np.ascontiguousarray(hashes).view(np.uint8).reshape(len(hashes), BLOCKS).astype(np.int64)
    return np.stack([(k << 16) | blocks[:, i] << 8 | blocks[:, j] for k, (i, j) in enumerate(_CHOICES)], axis=1)


def word_codes(words: Words) -> np.ndarray:
    """One character for each word, as its code point."""
    first, count = _CODES
    return (first + words.hashes % np.uint64(count)).astype("<u2")


def parities(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each line the classes of words, of 64, that it holds an odd number of."""
    bits = np.uint64(1) << (mix(codes.astype(np.uint64) + np.uint64(1)) >> np.uint64(58))
    out = np.zeros(len(first) - 1, np.uint64)
    some = np.flatnonzero(np.diff(first))
    if len(some):
        out[some] = np.bitwise_xor.reduceat(bits, first[some])
    return out.view(np.int64)


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        words, counts = split_lines(batch.column("text"))
        k0, k1 = line_keys(words)
        number = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        columns = {name: np.repeat(batch.column(name).to_numpy(zero_copy_only=False), counts) for name in ("doc_id", "tag")}
        codes, n_words = word_codes(words), np.diff(words.first).astype(np.int32)
        columns |= {"line": number.astype(np.int32), "n_words": n_words, "k0": k0, "k1": k1, "sim": simhash(words), "bag": parities(codes, words.first)}
        columns["codes"] = _spelled(codes, words.first, n_words, k0, k1)
        yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in columns.items()})


def _spelled(codes: np.ndarray, first: np.ndarray, n_words: np.ndarray, k0: np.ndarray, k1: np.ndarray) -> pa.Array:
    """The line as UTF-16 with one character for each word; null for short lines and for repeated ones of a batch."""
    order = np.lexsort((k1, k0))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(k0[order]) != 0) | (np.diff(k1[order]) != 0)
    told = np.zeros(len(order), bool)
    told[order[new]] = True
    told &= n_words >= WORDS
    ends = np.append(0, np.cumsum(np.where(told, n_words, 0)) * codes.itemsize).astype(np.int32)
    data = codes[np.repeat(told, n_words)].tobytes()
    valid = np.packbits(told, bitorder="little").tobytes()
    return pa.Array.from_buffers(pa.binary(), len(told), [pa.py_buffer(valid), pa.py_buffer(ends.tobytes()), pa.py_buffer(data)])


def _tagged(docs: DataFrame) -> DataFrame:
    """Documents with an id; ``tag`` tells texts of one id apart."""
    docs = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return let_workers_import(docs.withColumn("tag", F.xxhash64("text")))


def lines(docs: DataFrame) -> DataFrame:
    """Every line of every document with an id: its words, key, SimHash and, once a batch, the codes of its words."""
    return _tagged(docs).mapInArrow(_lines, "doc_id long, tag long, line int, n_words int, k0 long, k1 long, sim long, bag long, codes binary")


_PACK = (("sim", "<i8"), ("node", "<i8"), ("bag", "<i8"), ("n_words", "<i4"))
_PACK_BYTES = sum(np.dtype(kind).itemsize for _, kind in _PACK)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= PACKED_ROWS:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes by the first block of a choice and its value, byte by byte. Without ``bag`` and ``n_words`` the SimHashes alone decide."""
    for part in _gathered(batches):
        columns = [part.column(c).to_numpy() if c in part.column_names else np.zeros(part.num_rows, kind) for c, kind in _PACK]
        table = np.concatenate([x.astype(kind).view(np.uint8).reshape(len(x), -1) for x, (_, kind) in zip(columns, _PACK)], axis=1)
        for i in range(BLOCKS - 1):
            rows = table[np.argsort(table[:, i], kind="stable")]
            cut = np.append(np.flatnonzero(np.diff(rows[:, i].astype(np.int64), prepend=-1)), len(rows))
            shelves = i << 8 | rows[cut[:-1], i].astype(np.int64)
            packs = [rows[a:b].T.tobytes() for a, b in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(shelves), pa.array(packs, pa.binary())], names=["shelf", "pack"])


def _unpacked(packs: list[bytes]) -> list[np.ndarray]:
    """The columns of ``_PACK``, by length and node."""
    rows = np.ascontiguousarray(np.concatenate([np.frombuffer(p, np.uint8).reshape(_PACK_BYTES, -1) for p in packs], axis=1).T)
    out, at = [], 0
    for _, kind in _PACK:
        size = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(rows[:, at : at + size]).view(kind).ravel())
        at += size
    by = np.lexsort((out[1], out[3]))
    return [x[by] for x in out]


def _chains(close: np.ndarray) -> np.ndarray:
    """For each row of a symmetric table of near pairs the first row that a chain of near ones leads to."""
    return _joined(len(close), *np.nonzero(close))


def _joined(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` rows the first row that a chain of the pairs ``a``, ``b`` leads to."""
    label = np.arange(n)
    while len(a):
        least = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if (label == before).all():
            break
    return label


class _Near:
    """Near pairs of a shelf, shortened to chains whenever there are many."""

    def __init__(self) -> None:
        self.a, self.b, self.held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.a.append(a)
        self.b.append(b)
        self.held += len(a)
        if self.held > AT_ONCE:
            at, first = self.chains()
            self.a, self.b, self.held = [at], [first], 0

    def chains(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows with a near one, and the first row of the chain of each."""
        a, b = np.concatenate(self.a), np.concatenate(self.b)
        at, place = np.unique(np.concatenate([a, b]), return_inverse=True)
        return at, at[_joined(len(at), place[: len(a)], place[len(a) :])]


def _near_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of each bucket that have a candidate there, under a key for each chain of such nodes, with a number that equal groups of any bucket share and the smallest node.

    Rows come by shelf: the first block of a choice and its value, with the buckets of all choices that begin with it.
    """

    def near(shelf: int, packs: list[bytes]) -> pa.RecordBatch:
        sim, node, bag, n_words = _unpacked(packs)
        blocks = sim.view(np.uint8).reshape(-1, BLOCKS)
        sim, bag = sim.view(np.uint64), bag.view(np.uint64)
        seconds = range((shelf >> 8) + 1, BLOCKS)
        row = np.concatenate([np.argsort(blocks[:, j], kind="stable") for j in seconds])
        bucket = np.repeat(np.array(seconds), len(sim)) << 8
        bucket |= blocks[row, bucket >> 8]
        own, length = sim[row], n_words[row].astype(np.int64)
        # Rows of a bucket come by length: those that are not too long for a row end here.
        end = np.searchsorted(bucket << 32 | length, bucket << 32 | length * 100 // round(100 * SIMILARITY), side="right")
        cut = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(own))
        size = np.diff(cut)
        found = _Near()

        def candidates(a: np.ndarray, b: np.ndarray) -> None:
            odd = np.bitwise_count(bag[row[a]] ^ bag[row[b]])
            alike = (b < end[a]) & (odd <= 2 * _most(length[b]) - (length[b] - length[a]))
            found.add(a[alike], b[alike])

        # All buckets of ordinary size together: each row against the next one, the one after that, ..
        ordinary = np.repeat(size <= ROWS, size)
        left = np.flatnonzero(ordinary)
        step = 1
        while len(left := left[left + step < end[left]]):
            if 3 * len(left) > len(own):  # faster without picking rows
                close = np.flatnonzero(np.bitwise_count(own[:-step] ^ own[step:]) <= NEAR_BITS)
                close = close[ordinary[close]]
            else:
                close = left[np.bitwise_count(own[left] ^ own[left + step]) <= NEAR_BITS]
            if len(close):
                candidates(close, close + step)
            step += 1
        for k in np.flatnonzero(size > ROWS).tolist():
            at, stop = int(cut[k]), int(cut[k + 1])
            while at < stop:
                some = min(at + max(1, AT_ONCE // (stop - at)), stop)
                a, b = np.nonzero(np.bitwise_count(own[at:some, None] ^ own[None, at : end[some - 1]]) <= NEAR_BITS)
                candidates(at + a[a < b], at + b[a < b])
                at = some
        at, first = found.chains()
        salt = mix((shelf << 16 | bucket[at]).view(np.uint64))
        keys = mix(node[row[first]].view(np.uint64) * np.uint64(3) + salt).view(np.int64)
        _, group = np.unique(first, return_inverse=True)
        members = np.zeros(len(at), np.uint64)
        np.add.at(members, group, mix(node[row[at]].view(np.uint64) + np.uint64(1)))
        leader = np.full(len(at), np.iinfo(np.int64).max)
        np.minimum.at(leader, group, node[row[at]])
        columns = [keys, mix(members[group]).view(np.int64), leader[group], node[row[at]]]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["key", "members", "leader", "node"])

    now, packs = None, []
    for batch in batches:
        for shelf, pack in zip(batch.column("shelf").to_pylist(), batch.column("pack").to_pylist()):
            if shelf != now and packs:
                yield near(now, packs)
                packs = []
            now = shelf
            packs.append(pack)
    if packs:
        yield near(now, packs)


def _most(longer):
    """Most edit steps of linked lines: distance / longer <= 1 - similarity, in whole numbers."""
    return longer * round(100 * (1 - SIMILARITY)) // 100


def _near(a: Column, b: Column) -> Column:
    """Lengths and parities that the edit similarity allows, and SimHashes near enough."""
    low, high = F.least(a["n_words"], b["n_words"]), F.greatest(a["n_words"], b["n_words"])
    differ, odd = (F.bit_count(a[c].bitwiseXOR(b[c])) for c in ("sim", "bag"))
    most = F.floor(high * round(100 * (1 - SIMILARITY)) / 100)
    return (low * 100 >= high * round(100 * SIMILARITY)) & (differ <= NEAR_BITS) & (odd <= 2 * most - (high - low))


def _prepare(found: DataFrame, wanted: DataFrame):
    def prepare(nodes: DataFrame):
        told = found.where("codes IS NOT NULL").select("k0", "k1", "codes")
        # The lines grow with the corpus, the wanted ones with them: neither is broadcast.
        codes = wanted.select("node", "k0", "k1").join(told, ["k0", "k1"]).groupBy("node").agg(F.first("codes").alias("codes"))
        codes = settled(codes.select("node", F.decode("codes", "UTF-16LE").alias("codes")), "line-codes")
        return _check(codes), _check_blocks(codes)

    return prepare


def _check(codes: DataFrame):
    def check(pairs: DataFrame) -> DataFrame:
        joined = settled(pairs, "line-pairs").join(codes.toDF("a", "a_codes"), "a").join(codes.toDF("b", "b_codes"), "b")
        longer = F.greatest(F.length("a_codes"), F.length("b_codes"))
        # distance / longer <= 1 - similarity, in whole numbers
        joined = joined.withColumn("most", F.floor(longer * round(100 * (1 - SIMILARITY)) / 100).cast("int"))
        close = F.expr("levenshtein(a_codes, b_codes, least(most, 64)) >= 0 OR levenshtein(a_codes, b_codes, most) >= 0")
        return joined.where(close).select("a", "b")

    return check


def within(a: str, b: str, most: int) -> bool:
    """Whether the edit distance is ``most`` or less; one step of bit operations for each character of ``b``."""
    if not a or not b:
        return max(len(a), len(b)) <= most
    places: dict[str, int] = {}
    for k, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << k
    full, last = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, distance = full, 0, len(a)
    for left, c in zip(range(len(b) - 1, -1, -1), b):
        same = places.get(c, 0)
        flat = (((same & up) + up) ^ up) | same | down
        more, less = down | (full & ~(flat | up)), up & flat
        distance += bool(more & last) - bool(less & last)
        if distance - left > most:
            return False
        more, less = (more << 1 | 1) & full, less << 1 & full
        up, down = less | (full & ~((same | down) | more)), more & (same | down)
    return distance <= most


class Held:
    """Held lines of a block, indexed by word: one look-up gives the number of words shared with each of them."""

    def __init__(self) -> None:
        self.nodes: list[int] = []
        self.codes: list[str] = []
        self.group: dict[int, int] = {}  # links found within the block, as a forest over components
        self.index: tuple | None = None

    def add(self, node: int, component: int, codes: str) -> None:
        self.nodes.append(node)
        self.codes.append(codes)
        self.group.setdefault(node, component)

    def root(self, x: int) -> int:
        while self.group.get(x, x) != x:
            x = self.group[x]
        return x

    @staticmethod
    def _numbered(codes: str) -> np.ndarray:
        """Words of the line, the second and further ones of a kind as words of their own."""
        words = np.sort(np.frombuffer(codes.encode("utf-32-le"), "<u4")).astype(np.int64)
        return words << 32 | np.arange(len(words)) - np.searchsorted(words, words)

    def links(self, node: int, component: int, codes: str) -> list[int]:
        """Held nodes that the given one is linked with and that were not connected with it yet."""
        if self.index is None:
            sizes = np.array([len(c) for c in self.codes])
            flat = np.concatenate([self._numbered(c) for c in self.codes])
            order = np.argsort(flat, kind="stable")
            self.index = (flat[order], np.repeat(np.arange(len(sizes)), sizes)[order], sizes)
        flat, owner, sizes = self.index
        mine = self._numbered(codes)
        low, high = np.searchsorted(flat, mine), np.searchsorted(flat, mine, side="right")
        both = np.bincount(owner[ranges(low, high - low)], minlength=len(sizes))
        longer = np.maximum(sizes, len(codes))
        most = _most(longer)
        self.group.setdefault(node, component)
        out = []
        for k in np.flatnonzero(both >= longer - most).tolist():
            a, b = self.root(self.nodes[k]), self.root(node)
            if a != b and within(self.codes[k], codes, int(most[k])):
                self.group[max(a, b)] = min(a, b)
                out.append(self.nodes[k])
        return out


def _confirm_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a block come together, the held ones first."""
    block, held = None, Held()
    for batch in slices(batches, "codes"):
        columns = [batch.column(c).to_pylist() for c in ("key", "chunk", "part", "held", "node", "component", "codes")]
        out_a, out_b = [], []
        for key, chunk, part, is_held, node, component, codes in zip(*columns):
            if (key, chunk, part) != block:
                block, held = (key, chunk, part), Held()
            if is_held:
                held.add(node, component, codes)
            elif held.nodes:
                found = held.links(node, component, codes)
                out_a += found
                out_b += [node] * len(found)
        yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])


def _check_blocks(codes: DataFrame):
    def check(rows: DataFrame) -> DataFrame:
        rows = let_workers_import(settled(rows, "blocks").join(codes, "node"))
        rows = rows.repartition("key", "chunk", "part").sortWithinPartitions("key", "chunk", "part", F.col("held").desc())
        rows = rows.select("key", "chunk", "part", "held", "node", "component", "codes")
        return rows.mapInArrow(_confirm_block, "a long, b long").distinct()

    return check


def _decided(docs: DataFrame) -> DataFrame:
    """Every line with its own place and the place that stands for its group; a place is doc_id, line and tag."""
    found = settled(lines(docs), "lines")
    usable = found.where(F.col("n_words") >= WORDS)
    place = F.struct("doc_id", "line", "tag")
    same = [F.min(c).alias(c) for c in ("n_words", "sim", "bag")]
    nodes = usable.groupBy("k0", "k1").agg(F.min(place).alias("first"), F.count("*").alias("n"), *same)
    nodes = settled(nodes.withColumn("node", F.monotonically_increasing_id()), "line-nodes")
    packed = nodes.select("node", "sim", "bag", "n_words").mapInArrow(_packed, "shelf long, pack binary")
    packed = packed.repartition("shelf").sortWithinPartitions("shelf")
    groups = packed.mapInArrow(_near_groups, "key long, members long, leader long, node long")
    buckets = settled(groups.select(F.col("members").alias("key"), "leader", "node").distinct(), "near-lines")
    wanted = settled(nodes.drop("n").join(buckets.select("node").distinct(), "node"), "wanted-lines")
    signatures = wanted.select("node", F.struct("n_words", "sim", "bag").alias("sig"))
    groups = link_groups(buckets, signatures, _near, _prepare(found, wanted), wanted.select("node"))
    # Few lines are linked: what stands for them is worked out for these alone.
    linked = settled(groups.unionByName(groups.select(F.col("component").alias("node"), "component").distinct()), "linked-lines")
    linked = settled(wanted.select("node", "k0", "k1", "first").join(linked, "node"), "linked-places")
    stands = linked.groupBy("component").agg(F.min("first").alias("stands"))
    stands = linked.join(stands, "component").select("k0", "k1", "stands")
    # A line that is alone stands for itself. What stands for a group is the smallest of the first places in it.
    stands = stands.unionByName(nodes.where("n > 1").select("k0", "k1", F.col("first").alias("stands")))
    stands = settled(stands.groupBy("k0", "k1").agg(F.min("stands").alias("stands")), "line-groups")
    placed = stands.withColumn("least", F.lit(WORDS))
    joined = found.join(placed, (found.k0 == placed.k0) & (found.k1 == placed.k1) & (found.n_words >= placed.least), "left")
    own = F.struct(found.doc_id.alias("doc_id"), found.line.alias("line"), found.tag.alias("tag"))
    return joined.select(own.alias("own"), found.n_words, F.coalesce("stands", own).alias("stands"))


def decide(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``line``, ``n_words``, ``kept``, and the line that stands for its group, for every line."""
    own, stands = F.col("own"), F.col("stands")
    return _decided(docs).select(
        own["doc_id"].alias("doc_id"),
        own["line"].alias("line"),
        "n_words",
        (stands == own).alias("kept"),
        stands["doc_id"].alias("group_doc_id"),
        stands["line"].alias("group_line"),
    )


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = batch.column("text").to_pylist()
        for k, dropped in enumerate(batch.column("dropped").to_pylist()):
            if dropped:
                gone = set(dropped)
                texts[k] = "\n".join(x for i, x in enumerate(texts[k].split("\n")) if i not in gone)
        words, counts = split_lines(pa.array(texts, pa.string()))
        ends = np.cumsum(counts)
        left = words.first[ends] - words.first[ends - counts]
        cut = np.array([bool(d) for d in batch.column("dropped").to_pylist()], bool)
        out = pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=["row", "text"])
        yield out.filter(pa.array(~cut | (left > 0)))


def deduplicate(docs: DataFrame) -> DataFrame:
    """``docs`` without the repeated lines; all columns as they were."""
    decided = _decided(docs).where("own <> stands")
    # No longer than the document that it belongs to.
    dropped = decided.groupBy(F.col("own.doc_id").alias("id"), F.col("own.tag").alias("tag")).agg(F.collect_set("own.line").alias("dropped"))
    dropped = settled(dropped, "dropped-lines")
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*others).alias("row"), "text", F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_tag"))
    # The list grows with the corpus, so it is never broadcast, however small it is now.
    rows = rows.join(dropped.hint("merge"), (F.col("_id") == F.col("id")) & (F.col("_tag") == F.col("tag")), "left")
    rows = let_workers_import(rows.select("row", "text", "dropped"))
    kept = rows.mapInArrow(_rewrite, T.StructType([rows.schema["row"], rows.schema["text"]]))
    return kept.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
