"""What the encoder of texts keeps between batches."""

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from terralot.llm.tokens import ChunkEncoder, library_encoder


def test_chunks_met_again_outlast_a_full_cache():
    asked = []

    def ids_of(strings):
        return np.array([sum(x.encode()) for x in strings], np.uint32), np.ones(len(strings), np.int64)

    def chunks(new):
        asked.extend(new.to_pylist())
        return ids_of(new.to_pylist())

    encoder = ChunkEncoder(chunks, ids_of, entries=10)
    for k in range(30):
        words = ["common", "Common,", *[f"w{k}x{i}" for i in range(4)]]
        ids, bounds = encoder.encode(pa.array(["first " + " ".join(words)]))
        assert ids.tolist() == [sum(b"first"), sum(b"common"), sum(b"Common"), sum(b","), *[sum(x.encode()) for x in words[2:]]] and bounds.tolist() == [0, 8]
    assert asked.count("common") == asked.count("Common") == 1
    assert len(encoder.slots) + len(encoder.elder[0]) <= 40  # two generations, each with a batch beyond its bound


def test_ids_across_generations():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, encoder = Tokenizer.from_file(path), library_encoder(path)
    encoder.forget()
    encoder.entries, before = 12, encoder.entries
    try:
        for k in range(12):
            texts = [f"The same words again, and Again! {k} été étés; n{k * k} of{k}. word{chr(97 + k)}{chr(98 + k)}, the end."] * 2 + ["", f"a  b\n c{k}"]
            ids, bounds = encoder.encode(pa.array(texts))
            for i, text in enumerate(texts):
                assert ids[bounds[i] : bounds[i + 1]].tolist() == library.encode(text, add_special_tokens=False).ids
    finally:
        encoder.entries = before
        encoder.forget()
