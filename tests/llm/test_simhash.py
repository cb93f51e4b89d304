from __future__ import annotations

import numpy as np
import pytest
import xxhash

from tests.llm.helpers import ODD, edited, frame, words
from wayfleet.llm import simhash
from wayfleet.llm.golay import near_indices


def expected(rows, scheme):
    """Component ids by comparing every two fingerprints."""
    prints = [np.frombuffer(simhash.fingerprint((t or "").encode(), scheme), ">u8").astype(np.uint64) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if int(np.bitwise_count(prints[i] ^ prints[j]).sum()) <= scheme.radius:
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [(doc_id, least.get(find(i))) for i, (doc_id, _) in enumerate(rows)]


def sample():
    base = [" ".join(words(k, 300)) for k in range(12)]
    near = [edited(base[k % 12], k, k % 9) for k in range(60)]
    return [*enumerate([*base, *near, *ODD, "One", "two words", "two  WORDS"], 5), (None, base[0]), (None, None), (7, "again")]


def test_near_indices_of_words_two_bits_apart_meet():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 23, 5000)
    b = a ^ (1 << rng.integers(0, 23, 5000)) ^ (1 << rng.integers(0, 23, 5000))
    x, y = near_indices(a), near_indices(b)
    assert all(set(p[p >= 0]) & set(q[q >= 0]) for p, q in zip(x, y, strict=True))
    assert set((x >= 0).sum(axis=1)) == {1, 6}


def test_exact_keys_miss_no_link_of_three_bits():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, (20_000, 1), dtype=np.uint64)
    b = a.copy()
    for _ in range(3):
        b[:, 0] ^= np.uint64(1) << rng.integers(0, 64, len(b), dtype=np.uint64)
    one, two = (set(zip(*map(list, simhash._keys_exact(x)), strict=True)) for x in (a, b))
    assert len({row for row, _ in one & two}) == len(a)


def test_wide_keys_find_most_of_similarity_0_9():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 63, (1000, 2), dtype=np.uint64)
    flips = np.packbits(rng.random((1000, 128)) < 0.104, axis=1).view(np.uint64)
    one, two = (set(zip(*map(list, simhash._keys_wide(x)), strict=True)) for x in (a, a ^ flips))
    assert len({row for row, _ in one & two}) > 940


def test_fingerprint_is_the_majority_of_xxh64():
    text = b"The quick  Brown\tfox jumps\nOVER \xc3\x84"
    own = [b"the quick brown", b"quick brown fox", b"brown fox jumps", b"fox jumps over", b"jumps over \xc3\x84"]
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in own]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert int.from_bytes(simhash.fingerprint(text, simhash.exact()), "big") == bits
    assert simhash.fingerprint(b" \n", simhash.exact()) == bytes(8)
    assert simhash.fingerprint(b"Two words", simhash.exact()) == xxhash.xxh64_digest(b"two words", 42)


@pytest.mark.parametrize("group_rows", [simhash.GROUP_ROWS, 3])
def test_components_equal_brute_force(spark, group_rows):
    rows = sample()
    found = simhash.near_duplicates(frame(spark, rows), simhash.exact(), group_rows).collect()
    assert sorted(((r.doc_id, r.component_id) for r in found), key=str) == sorted(expected(rows, simhash.exact()), key=str)


def test_wide_groups_near_copies_only(spark):
    base = [" ".join(words(k, 400, 10**6)) for k in range(30)]
    rows = [*base, *(edited(base[k], k, 3) for k in range(30))]
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(frame(spark, rows), simhash.wide()).collect()}
    assert all(found[k] == k for k in range(30))
    assert sum(found[30 + k] == k for k in range(30)) >= 28


def test_empty_table(spark):
    assert simhash.near_duplicates(frame(spark, []), simhash.exact()).count() == 0
