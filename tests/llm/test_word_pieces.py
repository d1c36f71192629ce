"""op3: new words go through the vocabulary by their pieces, not by one call each, and the ids stay the same."""

import random

import numpy as np


def _texts():
    rng = random.Random(3)
    letters = "abzEIKSé̀́ñßÅ한각١²½世ﬁ😀क्षİ"
    marks = "0123456789.,;:!?'\"()[]#$%&*<>|_-/\\~^`{}@+=  ​\u0085\x00\x1c\x1f\x7f"
    tails = ["'s", "'t", "'RE", "'ve", "'m", "'ll", "'d", "''s", "'", "s's", "...", "###"]
    word = lambda: "".join(rng.choices(letters, k=rng.randrange(5)) + rng.choices(marks, k=rng.randrange(3))
                           + rng.choices("thesandrle", k=rng.randrange(8)) + [rng.choice(["", "", *tails])])
    return ["".join(word() + rng.choice([" ", "\n", "\t ", "  "]) for _ in range(60)) for _ in range(200)]


def test_ids_of_pieces(monkeypatch):
    import tokenizers

    from contrail.llm import packing

    path, calls = packing.vocabulary_path(), []
    coder = tokenizers.Tokenizer.from_file(path)

    class Counting:
        @staticmethod
        def from_file(name):
            return Counting()

        def __getattr__(self, name):
            return getattr(coder, name)

        def encode(self, *args, **kwargs):
            calls.append(args)
            return coder.encode(*args, **kwargs)

    monkeypatch.setattr(tokenizers, "Tokenizer", Counting)
    texts = _texts()
    ids = packing.tokenizer(path)
    got = [np.frombuffer(ids(t.encode()), "<u4").tolist() for t in texts]
    assert len(calls) <= len(texts)
    calls.clear()
    ids(b"Forty-two words' worth, isn't it? " * 3)
    assert not calls
    # word for word, as a text's ids are those of its lower-cased words
    for t, found in zip(texts, got, strict=True):
        words = t.encode().lower().split()
        assert found == [i for w in words for i in coder.encode(w.decode(), add_special_tokens=False).ids], t
    monkeypatch.setattr(packing, "_splits_as_known", lambda c: False)
    other = packing.tokenizer(path)
    assert [np.frombuffer(other(t.encode()), "<u4").tolist() for t in texts] == got


def test_small_caches(monkeypatch):
    from contrail.llm import packing

    texts = [t.encode() for t in _texts()]
    whole = packing.tokenizer(packing.vocabulary_path())
    expected = [whole(t) for t in texts]
    monkeypatch.setattr(packing, "_CACHE_WORDS", 100)
    small = packing.tokenizer(packing.vocabulary_path())
    assert [small(t) for t in texts] == expected
