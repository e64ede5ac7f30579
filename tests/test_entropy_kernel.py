"""The numpy entropy kernel against the plain-Python definition (no Spark)."""

import math
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from pymodel import entropy
from tunnelscan.functions import entropy_arrow as kernel
from tunnelscan.functions.entropy_arrow import _entropies


def _same(got, want):
    return (want is None and math.isnan(got)) or (want is not None and abs(got - want) < 1e-12)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40)), max_size=30))
def test_kernel_matches_definition(strings):
    got = _entropies(strings)
    for s, g in zip(strings, got):
        assert _same(g, None if s is None else entropy(s)), (s, g)


def test_astral_combining_and_long_strings():
    rng = random.Random(3)
    alphabet = ["a", "Z", "9", ".", "é", "é", "😀", "𝔸", "\u0000", "ß"]
    strings = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 3000))) for _ in range(50)]
    strings += ["", "😀", "😀😀", None]
    got = _entropies(strings)
    for s, g in zip(strings, got):
        assert _same(g, None if s is None else entropy(s))


def test_parts_and_overlong_strings_give_the_same(monkeypatch):
    rng = random.Random(4)
    strings = ["".join(rng.choice("abcé😀") for _ in range(rng.randint(0, 200))) for _ in range(60)] + [None, ""]
    whole = _entropies(strings)
    monkeypatch.setattr(kernel, "PART_CHARS", 50)
    for s, a, b in zip(strings, whole, _entropies(strings)):
        assert _same(b, None if s is None else a), s


def test_memory_does_not_follow_the_batch():
    import tracemalloc
    strings = ["lorem ipsum dolor " * 5000] * 60   # 5.4 million characters
    tracemalloc.start()
    _entropies(strings)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80e6
