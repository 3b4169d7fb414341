import numpy as np
import pyarrow as pa
import pytest

from platewise.llm import linking
from platewise.llm import op7_line_dedup as op7


def smallest_reachable(pairs):
    group = {x: {x} for pair in pairs for x in pair}
    for a, b in pairs:
        if group[a] is not group[b]:
            both = group[a] | group[b]
            for x in both:
                group[x] = both
    return {x: min(g) for x, g in group.items() if min(g) != x}


@pytest.mark.parametrize("at_once", [2, 1 << 19])
def test_edges_shortened_in_parts_connect_the_same(at_once, monkeypatch):
    monkeypatch.setattr(linking, "AT_ONCE", at_once)
    rng = np.random.default_rng(at_once)
    pairs = [(max(p), min(p)) for p in rng.integers(0, 60, (45, 2)).tolist() if p[0] != p[1]]
    batches = [pa.RecordBatch.from_pydict({"node": [a], "to": [b]}, schema=pa.schema([("node", pa.int64()), ("to", pa.int64())])) for a, b in pairs]
    short = [(a, b) for out in linking._forest(iter(batches)) for a, b in zip(out.column("node").to_pylist(), out.column("to").to_pylist())]
    assert smallest_reachable(short) == smallest_reachable(pairs)
    assert all(b < a for a, b in short)


def test_components_of_a_random_graph(spark):
    pairs = [tuple(p) for p in np.random.default_rng(5).integers(0, 400, (330, 2)).tolist()]
    links = spark.createDataFrame(pairs, "a long, b long").repartition(7)
    assert dict(map(tuple, linking.connected(links).collect())) == smallest_reachable([p for p in pairs if p[0] != p[1]])


@pytest.mark.parametrize("rows", [256, 4])
def test_buckets_compared_together_give_the_groups_of_all_pairs(rows, monkeypatch):
    monkeypatch.setattr(op7, "ROWS", rows)  # buckets above it are compared one by one
    rng = np.random.default_rng(6)
    base = rng.integers(-(1 << 62), 1 << 62, 12)
    sims = np.array([b ^ int(sum(1 << int(k) for k in rng.choice(62, rng.integers(0, 9), replace=False))) for b in base for _ in range(9)], np.int64)
    table = pa.RecordBatch.from_pydict({"node": np.arange(len(sims)) * 3, "sim": sims})
    packed = pa.Table.from_batches(op7._packed(iter([table]))).sort_by("shelf").combine_chunks().to_batches()
    got = pa.Table.from_batches(op7._near_groups(iter(packed)))
    found = {}
    for key, node in zip(got["key"].to_pylist(), got["node"].to_pylist()):
        found.setdefault(key, set()).add(node // 3)
    keys, expected = op7.block_keys(sims), []
    for bucket in np.unique(keys):
        members = np.flatnonzero((keys == bucket).any(axis=1)).tolist()
        near = [(a, b) for a in members for b in members if a < b and (int(sims[a]) ^ int(sims[b])).bit_count() <= op7.NEAR_BITS]
        groups = {}
        for x, least in smallest_reachable(near).items():
            groups.setdefault(least, {least}).add(x)
        expected += groups.values()
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, expected))


def test_few_edges_are_connected_without_rounds(spark, monkeypatch):
    """A path, dealt over many partitions, takes one pass; with less room the rounds give the same."""
    pairs = [(k, k + 1) for k in range(300)]
    links = spark.createDataFrame(pairs, "a long, b long").repartition(8)
    written, settled = [], linking.settled
    monkeypatch.setattr(linking, "settled", lambda df, name: written.append(name) or settled(df, name))
    assert dict(map(tuple, linking.connected(links).collect())) == {k: 0 for k in range(1, 301)}
    assert written == ["edges"]
    monkeypatch.setattr(linking, "AT_ONCE", 80)
    assert dict(map(tuple, linking.connected(links).collect())) == {k: 0 for k in range(1, 301)}
    assert len(written) > 2


def test_parities_and_lengths_spare_lines_that_cannot_be_linked():
    """Near SimHashes alone make no candidates; shelves hold each node once for each first block."""
    sims = np.array([5, 5, 5, 5, 5], np.int64)
    table = pa.RecordBatch.from_pydict({"node": np.arange(5), "sim": sims, "bag": np.array([0, 1, 0b111111111, 0, 0], np.int64), "n_words": np.array([10, 10, 10, 40, 39], np.int32)})
    packed = pa.Table.from_batches(op7._packed(iter([table]))).sort_by("shelf").combine_chunks()
    assert len(packed) == op7.BLOCKS - 1
    got = pa.Table.from_batches(op7._near_groups(iter(packed.to_batches())))
    rows = set(zip(got["members"].to_pylist(), got["leader"].to_pylist(), got["node"].to_pylist()))
    assert {(leader, node) for _, leader, node in rows} == {(0, 0), (0, 1), (3, 3), (3, 4)}
    assert len(rows) == 4 and len(set(got["key"].to_pylist())) == 2 * len(op7._CHOICES)


def test_parities_differ_by_no_more_than_edits_allow():
    rng = np.random.default_rng(9)
    for _ in range(300):
        a = rng.integers(0, 500, rng.integers(5, 60)).tolist()
        b, edits = list(a), int(rng.integers(0, len(a) // 5 + 1))
        for _ in range(edits):
            at, kind = int(rng.integers(0, len(b))), int(rng.integers(0, 3))
            b[at : at + (kind != 2)] = [] if kind == 1 else [int(rng.integers(0, 500))]
        bags = op7.parities(np.array(a + b, np.uint16), np.array([0, len(a), len(a) + len(b)])).view(np.uint64)
        assert int(bags[0] ^ bags[1]).bit_count() <= 2 * edits - abs(len(a) - len(b))
