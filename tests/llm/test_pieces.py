"""Piece encoder: what it remembers bounds its memory, not its results."""

import numpy as np
import pytest

pytest.importorskip("hazardloom.llm")
tokenizers = pytest.importorskip("public_tokenizers")

from hazardloom.llm import pieces  # noqa: E402


def test_forgetting_changes_nothing():
    path = tokenizers.path("piece_bpe_32k.model")
    texts = [[f"the {k * 7919 % 997} quick words{k} and unusual{k % 13}ness " + "x" * 60, "", None] for k in range(150)]
    much, little = pieces.Encoder(path), pieces.Encoder(path, remembered=50)
    most = 0
    for k, batch in enumerate(texts):
        ids = [k, k + 1, None]
        assert little.encode(batch, ids) == much.encode(batch, ids)
        most = max(most, len(little.out))
    assert most < 120 < len(much.out)


def test_skips_continue_from_the_agenda_they_leave(monkeypatch):
    """An agenda with one more skip takes over the merges before it: merging again starts where the two part."""
    path = tokenizers.path("piece_bpe_32k.model")
    encoder, merged = pieces.Encoder(path, 0.3), []

    def spy(self, symbol, part, *rest):
        merged.append(len(symbol))
        return plain(self, symbol, part, *rest)

    plain = pieces.Pieces.merge_all
    monkeypatch.setattr(pieces.Pieces, "merge_all", spy)
    encoder.encode(["straightforwardness internationalization " * 50], [3])
    assert len(encoder.out) > 50
    characters = sum(encoder.char.size[encoder.root[np.arange(len(encoder.out))]])
    assert sum(merged) < 0.75 * characters
