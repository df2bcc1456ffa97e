"""Signatures of the n-gram join in slices."""

import numpy as np

from meterflow.llm import ngram_join


def _sets(count=60):
    pick = np.random.default_rng(5)
    return [np.unique(pick.integers(0, 1 << 63, size, dtype=np.uint64)) for size in pick.integers(0, 400, count)]


def _listed(sets, frequent):
    place, value = ngram_join.signatures(sets, frequent)
    return sorted(zip(place.tolist(), value.tolist()))


def test_slices_sign_as_all_sets_at_once(monkeypatch):
    sets = _sets()
    frequent = np.sort(np.concatenate(sets)[::7])
    monkeypatch.setattr(ngram_join, "SLICE_SHINGLES", 1 << 40)
    whole = _listed(sets, frequent)
    assert whole and ngram_join.signatures([], frequent)[0].size == 0
    slices, signed = [], ngram_join._signatures
    monkeypatch.setattr(ngram_join, "_signatures", lambda some, often: slices.append(sum(map(len, some))) or signed(some, often))
    monkeypatch.setattr(ngram_join, "SLICE_SHINGLES", 500)
    assert _listed(sets, frequent) == whole
    assert len(slices) > 10 and max(slices) <= 500
