"""Words of texts as arrays."""

import numpy as np

from couriermart.llm import words


def test_a_part_that_ends_in_a_word_keeps_its_powers(monkeypatch):
    monkeypatch.setattr(words, "PART_BYTES", 64)
    monkeypatch.setattr(words, "WORD_BYTES", 32)
    monkeypatch.setattr(words, "_tables", words._Kept())
    raw = np.frombuffer(b"abcdefg " * 40 + b"x" * 300 + b" " + b"abcdefg " * 7 + b"abcdefg", np.uint8)
    found = words.find_words(raw, np.array([0, len(raw)]), words.SPACED)
    assert len(found.hash) == 49 and len(np.unique(found.hash)) == 2
    assert list(words._tables) == [96]
