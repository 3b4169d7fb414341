import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer, pre_tokenizers

from platewise.llm import huffman, pieces
from platewise.llm.arrays import text_bytes

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


class Counted:
    """The library's model, noting what it is given."""

    def __init__(self, model):
        self.model, self.given = model, []

    def tokenize(self, text):
        self.given.append(text)
        return self.model.tokenize(text)


def test_the_model_sees_each_different_piece_once():
    encoder = pieces.Encoder(pieces.definition(PATH, PATTERN), recent=4)
    encoder.model = Counted(encoder.model)
    own = Tokenizer.from_file(PATH)
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefé漢") for _ in range(rng.randint(1, 12))) for _ in range(500)]
    for _ in range(5):
        texts = [" ".join(rng.choices(words, k=rng.randint(0, 50))) for _ in range(100)]
        got = encoder.encode(pa.array(texts))
        assert got.first[-1] == len(got.ids)
        assert [got.ids[a:b].tolist() for a, b in zip(got.first, got.first[1:])] == [e.ids for e in own.encode_batch(texts)]
    assert len(encoder.model.given) == len(set(encoder.model.given)) == encoder.n_known == encoder.slots.n


def test_long_pieces_are_not_kept():
    encoder = pieces.Encoder(pieces.definition(PATH, PATTERN))
    encoder.model = Counted(encoder.model)
    own, texts = Tokenizer.from_file(PATH), ["q" * 49, "r" * 48, "q" * 49 + " r", "漢" * 17]
    for _ in range(2):
        got = encoder.encode(pa.array(texts))
        assert [got.ids[a:b].tolist() for a, b in zip(got.first, got.first[1:])] == [e.ids for e in own.encode_batch(texts)]
    assert len(encoder.model.given) == 6 and encoder.n_known == 2 and encoder.n_flat == encoder.length[:2].sum()


def test_pieces_are_those_of_the_library():
    own = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    rng = random.Random(7)
    signs = [" ", "  ", "　", "\xa0", " ", "\n", "\x1c", "\x85", "'s", "'ll", "'", "s", "é", "漢", "²", "Ⅷ", "😀", "𝒳", "𐒠", "𠀀", "!", "́"]
    for _ in range(3000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(1, 12)))
        data, begins = text_bytes(pa.array([text]))
        starts = pieces.piece_starts(data, begins[:-1], pieces.byte_classes(data))
        places = [len(text[:a].encode()) for _, (a, b) in own.pre_tokenize_str(text) if a < b]
        assert starts.tolist() == sorted(set(places)), text


def test_key_table_against_a_dictionary():
    rng = np.random.default_rng(3)
    table, known = pieces.KeyTable(2), {}
    for size in (0, 1, 5, 300, 2000):
        keys = np.unique(rng.integers(1, 1 << 20, size, dtype=np.uint64) << np.uint64(40) | rng.integers(0, 4, size, dtype=np.uint64) + np.uint64(1))
        keys = keys[table.find(keys) < 0]
        numbers = np.arange(len(known), len(known) + len(keys), dtype=np.int32)
        table.add(keys, numbers)
        known |= dict(zip(keys.tolist(), numbers.tolist()))
        asked = np.concatenate([np.array(list(known), np.uint64), rng.integers(1 << 62, 1 << 63, 50, dtype=np.uint64)])
        assert table.find(asked).tolist() == [known.get(k, -1) for k in asked.tolist()]
    assert table.n == len(known) and 2 * table.n <= len(table.keys)


def test_decoding_looks_up_once_a_step():
    rng = np.random.default_rng(4)
    counts = np.bincount(rng.zipf(1.3, 40_000) % 3000, minlength=3000)
    lengths = huffman.code_lengths(counts)
    blocks = [rng.permutation(np.repeat(np.arange(3000), counts))[:n] for n in (0, 1, 255, 256, 257, 9999)]
    packed = [huffman.pack(b, lengths, huffman.canonical(lengths)) for b in blocks]
    table = huffman.Table(lengths)
    got = table.unpack([p[0] for p in packed], [p[1] for p in packed], [len(b) for b in blocks])
    assert got.dtype == np.int32 and (got == np.concatenate(blocks)).all()
    assert [a.nbytes for a in vars(table).values() if isinstance(a, np.ndarray)] == [4 << table.width]
