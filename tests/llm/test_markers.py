"""op3: ids are those of the tokenizer as loaded, also where a text quotes one of its markers."""

from __future__ import annotations

import numpy as np


def test_ids_of_quoted_markers():
    from tokenizers import Tokenizer

    from contrail.llm import packing

    coder, ids = Tokenizer.from_file(packing.vocabulary_path()), packing.tokenizer(packing.vocabulary_path())
    markers = [t.content for t in coder.get_added_tokens_decoder().values()]
    assert markers
    for m in markers:
        for text in (f"one {m} two", f"One{m}TWO", f"a {m.upper()} b\n{m}{m} c", f"{m[:-1]} {m[1:]}", "No marker  here"):
            assert np.frombuffer(ids(text.encode()), "<u4").tolist() == coder.encode(text, add_special_tokens=False).ids, text
    assert np.frombuffer(ids(b"one <|endoftext|> two"), "<u4").tolist() == [637, 49407, 1237]
