import numpy as np
import pytest

from clickloom.llm.suffixes import BucketQueue, Words8, buckets, repeated


def order_of(text, depth, **options):
    parts = list(buckets(text, depth, **options))
    places = [np.concatenate([low, high]) for _, low, _, high, _ in sorted(parts, key=lambda p: p[0])]
    return np.concatenate(places).tolist()


@pytest.mark.parametrize("seed", range(12))
@pytest.mark.parametrize("options", [{}, {"base": 3, "limit": 7}])
def test_order_and_shared_lengths(seed, options):
    rng = np.random.default_rng(seed)
    text = rng.integers(97, 97 + rng.integers(1, 5), rng.integers(1, 300)).astype(np.uint8)
    if seed % 3 == 0:
        text = np.concatenate([text, text[: len(text) // 2], np.full(30, 98, np.uint8), text])
    raw, depth = text.tobytes(), int(rng.integers(2, 40))
    suffixes = [raw[i : i + depth] for i in range(len(raw))]
    got = order_of(text, depth, **options)
    assert sorted(got) == list(range(len(raw)))
    assert [suffixes[i] for i in got] == sorted(suffixes)
    for _, fall, fall_shared, rise, rise_shared in buckets(text, depth, **options):
        for places, shared in ((fall, fall_shared), (rise, rise_shared)):
            for a, b, n in zip(places, places[1:], shared[1:]):
                same = next((k for k in range(depth) if raw[a + k : a + k + 1] != raw[b + k : b + k + 1] or a + k >= len(raw)), depth)
                assert n == same


@pytest.mark.parametrize("options", [{}, {"base": 50, "limit": 100}])
def test_groups_of_equal_windows(options):
    rng = np.random.default_rng(5)
    pieces = [bytes(rng.integers(97, 100, 40).astype(np.uint8)) for _ in range(6)]
    raw = b"\xff".join(b"".join(pieces[i] for i in rng.integers(0, 6, 4)) for _ in range(12)) + b"\xff"
    group = {}
    for part, (places, number) in enumerate(repeated(np.frombuffer(raw, np.uint8), 20, **options)):
        for p, g in zip(places.tolist(), number.tolist()):
            group[p] = part, g
    whole = [i for i in range(len(raw) - 19) if b"\xff" not in raw[i : i + 20]]
    for a in whole:
        for b in whole:
            assert (group[a] == group[b]) == (raw[a : a + 20] == raw[b : b + 20])


def test_queue_gives_rows_back_in_order():
    queue = BucketQueue(2, limit=5)
    rng = np.random.default_rng(2)
    expected = {}
    for i in range(40):
        keys = rng.integers(0, 6, 3)
        queue.push(keys, np.array([[i, k] for k in range(3)]))
        for k, key in enumerate(keys.tolist()):
            expected.setdefault(key, []).append([i, k])
    assert len(queue.runs) > 3
    for key in range(6):
        assert queue.pop(key).tolist() == expected.get(key, [])
    queue.close()


def test_shared_bytes():
    text = np.frombuffer(b"abcabcabcabd" + b"x" * 30 + b"y" * 3, np.uint8)
    read = Words8(text)
    a, b = np.array([0, 0, 12, 3, 42]), np.array([3, 9, 13, 6, 44])
    assert read.shared(a, b, 16).tolist() == [8, 2, 16, 5, 1]
