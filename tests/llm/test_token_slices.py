"""Slices that the token files are encoded in: large ones look up fewer words and give the same ids."""

import numpy as np
import pyarrow as pa

from sluice.llm import rans
from sluice.llm.queries import WORD_BPE
from sluice.llm.textcols import SLICE_BYTES, slices
from sluice.llm.wordbpe import WordBpe


def test_large_slices_look_up_fewer_words():
    texts = [" ".join(f"word{(7 * i + k) % 3000}x" for k in range(600)) for i in range(1000)] + [None, "", "ẞ É\n"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    looked_up, found = [], []
    for limit in (SLICE_BYTES, rans._SLICE_BYTES):
        encoder, n = WordBpe(WORD_BPE), [0]
        table = encoder.words

        def count(words):
            n[0] += len(words)
            return table(words)
        encoder.words = count
        parts = [encoder.encode_column(part.column(0)) for part in slices(batch, 0, limit)]
        found.append((np.concatenate([ids for ids, _ in parts]), np.concatenate([np.diff(ends) for _, ends in parts])))
        looked_up.append(n[0])
    assert looked_up[1] * 3 < looked_up[0] * 2
    assert all(np.array_equal(a, b) for a, b in zip(*found))
