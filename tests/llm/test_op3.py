import heapq
import random
import struct
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from platewise.llm import huffman
from platewise.llm import op3_token_files as op
from platewise.llm.queries import queries
from platewise.workspace import new_path
from tests.llm.conftest import FOLDER

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


def expected(texts):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    start, out = 0, {}
    for i in sorted(texts):
        ids = [*tokenizer.encode(texts[i] or "", add_special_tokens=False).ids, 2]
        out[i] = (i, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)
    return out


def test_query_equals_brute_force(spark, texts):
    assert {r["doc_id"]: tuple(r) for r in queries()["op3_token_files"](spark, FOLDER).collect()} == expected(texts)


def test_small_blocks_and_odd_rows(spark, odd_docs, no_docs):
    folder = new_path(spark, "files")
    op.write(odd_docs, folder, PATH, PATTERN, 2, block_ids=100)
    rows = op.read(spark, folder).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [None, 1, 2, 3, 4, 4, 5, 6]
    assert [r["start"] for r in rows] == [sum(x["n_tokens"] for x in rows[:k]) for k in range(8)]
    assert bytes(rows[1]["ids"]) == struct.pack("<I", 2)
    assert spark.read.parquet(f"{folder}/blocks").count() >= 2
    empty = new_path(spark, "files")
    op.write(no_docs, empty, PATH, PATTERN, 2)
    assert op.read(spark, empty).count() == 0


def cost(counts):
    heap = [c for c in counts if c]
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        joint = heapq.heappop(heap) + heapq.heappop(heap)
        total += joint
        heapq.heappush(heap, joint)
    return total


def test_code_is_optimal_limited_and_decodes():
    rng = random.Random(3)
    for _ in range(100):
        counts = np.array([rng.choice([0, 1, 2, 5, int(1.6 ** rng.randint(0, 30))]) for _ in range(rng.randint(2, 60))])
        used = np.flatnonzero(counts)
        if len(used) > 1:
            assert (huffman.code_lengths(counts, 40) * counts).sum() == cost(counts)
        lengths = huffman.code_lengths(counts, 7)
        assert lengths.max(initial=0) <= 7
        if not len(used):
            continue
        ids = np.array(rng.choices(used.tolist(), k=rng.randint(0, 2000)), dtype=np.int64)
        codes = huffman.canonical(lengths)
        blocks = [ids, ids[:7], ids[:0]]
        packed = [huffman.pack(b, lengths, codes) for b in blocks]
        got = huffman.Table(lengths).unpack([p[0] for p in packed], [p[1] for p in packed], [len(b) for b in blocks])
        assert (got == np.concatenate(blocks)).all()
