"""Near-duplicate grouping where many members of a bucket are not alike."""

import random

import numpy as np
import pytest

from rawlake.llm import near
from test_corpus import brute_components


def edits(seed, n, words=120, changed=(4, 16)):
    """A text and ``n`` versions of it, most of which are not alike among each other."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = [" ".join(base)]
    for k in range(n):
        own = list(base)
        for at in rng.sample(range(words), rng.randint(*changed)):
            own[at] = f"x{seed}-{k}-{at}"
        out.append(" ".join(own))
    return out


def brute_groups(texts):
    sets = [near.shingles(t.encode()) for t in texts]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if near.alike(sets[a], sets[b])]
    return brute_components(range(len(sets)), links)


def groups(spark, texts):
    rows = near.similar(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    first = {}
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        first.setdefault(bytes(r["group"]), r["doc_id"])
    return {r["doc_id"]: first[bytes(r["group"])] for r in rows}


@pytest.mark.parametrize("gather,deepest", [(256, 3), (8, 3), (8, 0), (8, 1)])
def test_groups_agree_with_brute_force_however_buckets_are_dealt(spark, monkeypatch, gather, deepest):
    monkeypatch.setattr(near, "GATHER", gather)
    monkeypatch.setattr(near, "DEEPEST", deepest)
    texts = edits(1, 60) + edits(2, 40, changed=(6, 9)) + edits(3, 20, words=30, changed=(1, 1)) + edits(4, 12, words=9, changed=(0, 1))
    got, want = groups(spark, texts), brute_groups(texts)
    assert got == {k: want[k] for k in range(len(texts))}
    assert len(set(got.values())) > 40


def test_rows_that_leave_buckets_grow_with_members_not_with_pairs(spark, monkeypatch):
    made = []
    own = near.materialize

    def counted(df, label):
        out = own(df, label)
        if label in ("gathered-links", "candidates", "similar-pairs"):
            made.append(out.count())
        return out

    monkeypatch.setattr(near, "materialize", counted)
    sums = []
    for n in (250, 500):
        made.clear()
        near.similar(spark.createDataFrame(list(enumerate(edits(5, n, changed=(7, 14)))), "doc_id bigint, text string")).count()
        sums.append(sum(made))
    # Twice the members make four times the pairs.
    assert sums[1] < 3 * sums[0] < 3 * 70 * 250


def test_fingerprints_of_alike_sets_are_close():
    worst, rng = 0, np.random.default_rng(3)
    for n in (5, 6, 9, 10, 40, 400):
        for _ in range(60):
            pool = rng.integers(0, 2**63, 2 * n, dtype=np.uint64)
            shared = -(-8 * n // 9) if n > 5 else 4
            a, b = np.unique(pool[:n]), np.unique(np.concatenate([pool[:shared], pool[n : 2 * n - shared]]) if n > 5 else pool[:4])
            if near.alike(a, b):
                worst = max(worst, int(np.bitwise_count(near.wide_fingerprint(a) ^ near.wide_fingerprint(b)).sum()))
    assert 20 < worst <= near.APART


def test_alike_counts_four_fifths_of_the_union():
    a = np.arange(9, dtype=np.uint64)
    assert near.alike(a, np.arange(1, 10, dtype=np.uint64)) and not near.alike(a, np.arange(2, 11, dtype=np.uint64))
    none = np.zeros(0, np.uint64)
    assert near.alike(none, none) and not near.alike(none, a[:1])
