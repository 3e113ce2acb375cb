import random

import numpy as np
import pyarrow as pa
import pytest

from seriesloom.llm import suffixes as S
from seriesloom.llm.base import Packed


def hasher(data):
    p = Packed(pa.array([""]))
    p.bytes = np.frombuffer(data, np.uint8)
    return p.bytes, p.hasher()


def brute_starts(data, n):
    seen = {}
    for i in range(len(data) - n + 1):
        seen.setdefault(data[i : i + n], []).append(i)
    return {i for v in seen.values() if len(v) > 1 for i in v}


CASES = [b"", b"a", b"aaaaaaaaaa", b"abababababab", b"mississippi", b"banana" * 5, bytes(range(256)) * 2]


@pytest.mark.parametrize("seed", range(40))
def test_starts(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(S, "CHUNK", rng.choice([4, 16, 1 << 16]))
    data = CASES[seed] if seed < len(CASES) else b"".join(
        rng.choice([bytes(rng.choices(b"ab\xff", k=rng.randrange(30))), b"ab" * rng.randrange(20), b"a" * rng.randrange(40), b"abcdefghijklmno"])
        for _ in range(rng.randrange(60))
    )
    t, h = hasher(data)
    for n in (2, 5, 20):
        for buffer in (1 << 20, 64):
            got = S.repeated_starts(t, h, n, buffer)
            assert set(np.flatnonzero(got).tolist()) == brute_starts(data, n)


def test_order_and_prefixes(monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 32)
    rng = random.Random(9)
    for _ in range(20):
        data = bytes(rng.choices(b"abc", k=rng.randrange(1, 300)))
        t, h = hasher(data)
        up, down = [], []
        S.sort_suffixes(t, h, 50, lambda at, lcp, d: (down if d else up).append((at.copy(), lcp.copy())))
        want = sorted(range(len(data)), key=lambda i: data[i:])
        small = S.Text(t).small
        ups = [int(i) for at, lcp in up for i in at if not small[i]]
        ups = list(dict.fromkeys(ups))
        assert ups == [i for i in want if not small[i]]
        assert [int(i) for at, _ in down for i in at] == [i for i in reversed(want) if small[i]]

        def common(i, j):
            k = 0
            while max(i, j) + k < len(data) and data[i + k] == data[j + k]:
                k += 1
            return min(k, 50)

        flat = [(int(i), int(v)) for at, lcp in down for i, v in zip(at, lcp)]
        for (i, _), (j, v) in zip(flat, flat[1:]):
            assert v == (common(i, j) if data[i] == data[j] else 0)
