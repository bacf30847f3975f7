"""The fit keeps a number for each stem, not the groups that hold it."""

import random
import tracemalloc

from terrace.llm import toxicity
from tests.llm import corpus


def plainly(toxic, ordinary):
    """How many groups hold each stem, from a set of groups for each."""
    counts = []
    for texts in (toxic, ordinary):
        held = {}
        for t, family in zip(texts, toxicity._families(texts)):
            for s in toxicity._stems(t):
                held.setdefault(s, set()).add(family)
        counts.append({s: len(f) for s, f in held.items()})
    return counts


def test_holders_are_counted_in_little_memory():
    rng = random.Random(4)
    toxic = [" ".join(corpus.words(rng, 300) + ["vile", "viler"]).encode() for _ in range(60)]
    toxic += [toxic[0] + b" more", toxic[1]]
    ordinary = [" ".join(corpus.words(rng, 1500)).encode() for _ in range(100)]
    a, b = plainly(toxic, ordinary)
    assert toxicity._holders(toxic)[0] == a
    assert toxicity._holders(ordinary, set(a))[0] == {s: k for s, k in b.items() if s in a}
    tracemalloc.start()
    found = toxicity._typical(toxic, ordinary)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert b"vile" in found and not any(s.startswith(b"vile") and s != b"vile" for s in found)
    assert peak < 25_000_000
