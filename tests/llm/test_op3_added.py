import struct

import public_tokenizers
from tokenizers import Tokenizer

from platewise.llm import op3_token_files as op
from platewise.workspace import new_path

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


def test_added_tokens_have_their_own_id(spark):
    texts = {1: "plain words", 2: "one<|endoftext|>two <|endoftext|>", 3: "<|endoftext|>", 4: "<|endoftext", 5: None}
    tokenizer = Tokenizer.from_file(PATH)
    folder = new_path(spark, "files")
    op.write(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), folder, PATH, PATTERN, 2)
    got = {r["doc_id"]: bytes(r["ids"]) for r in op.read(spark, folder).collect()}
    want = {k: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for k, t in texts.items()}
    assert 50256 in want[2] and got == {k: struct.pack(f"<{len(v)}I", *v) for k, v in want.items()}
