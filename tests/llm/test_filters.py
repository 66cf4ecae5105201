import numpy as np
import pytest

from reviewops.llm import filters as f


@pytest.mark.parametrize("half", [1, 2, 5, 16, 17, 31, 32, 33, 40, 50, 63, 64])
def test_keys_and_counts_survive(half):
    r = np.random.default_rng(half)
    bits = 2 * half
    for n in (0, 1, 2, 700):
        left, right = (r.integers(0, 2**64, n, dtype=np.uint64) & f._mask(half) for _ in range(2))
        keys = f.permuted(left, right, half)
        a, b = f.restored(keys, half)
        assert (a == left).all() and (b == right).all()
        unique, counts = f.counted(keys)
        assert counts.sum() == n and len(counts) == len(set(zip(left.tolist(), right.tolist(), strict=True)))
        for lead in (0, 1, min(7, bits)):
            top, rest = f.leading(unique, bits, lead)
            back = f.joined(top, rest, bits - lead)
            assert (back[0] == unique[0]).all() and (back[1] == unique[1]).all()
        counts = counts * r.integers(1, 70_000, len(counts))
        (high, low), again = f.load(f.dump(unique, counts, bits), bits)
        assert (high == unique[0]).all() and (low == unique[1]).all() and (again == counts).all()


def test_every_key_of_a_small_width_has_its_own_permuted_key():
    left, right = (x.ravel().astype(np.uint64) for x in np.meshgrid(np.arange(64), np.arange(64)))
    assert len(np.unique(f.permuted(left, right, 6)[1])) == 4096


def test_merged_filters_add_counts():
    r = np.random.default_rng(3)
    parts = [r.integers(0, 300, 400).astype(np.uint64) for _ in range(5)]
    blobs = [f.dump(*f.counted(f.permuted(p, p, 20)), 40) for p in parts]
    keys, counts, own = f.merged(blobs, 40)
    left, _ = f.restored(keys, 20)
    want = np.unique(np.concatenate(parts), return_counts=True)
    order = np.argsort(left)
    assert (left[order] == want[0]).all() and (counts[order] == want[1]).all()
    assert [len(k[1]) for k in own] == [len(np.unique(p)) for p in parts]


def test_filters_are_compact():
    """Some bits beside the remainder: less than the plain 8-byte keys and counts."""
    keys = f.counted((np.zeros(50_000, np.uint64), np.random.default_rng(4).integers(0, 1 << 40, 50_000).astype(np.uint64)))
    assert len(f.dump(*keys, 40)) < 50_000 * 4.6
