"""HyperMinHash near copies against all pairs of sets, and what its registers promise."""

import collections
import random

import numpy as np
import pyarrow as pa
import pytest

from riskloom.llm import registers

SCHEMA = "doc_id long, text string, bucket string, n long, class int, label string, a long, row long"


def make_rows():
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(400)]
    line = lambda n: [rng.choice(words) for _ in range(n)]
    texts = [" ".join(line(rng.randint(1, 90))) for _ in range(60)]
    for _ in range(6):  # chains: each text differs a little from the one before
        own = line(60)
        for _ in range(12):
            own = list(own)
            own[rng.randrange(60)] = rng.choice(words)
            texts.append(" ".join(own))
    star = line(50)
    for _ in range(40):  # copies with one to eight changes: some link with the first, some only with others
        own = list(star)
        for _ in range(rng.randint(1, 8)):
            own[rng.randrange(50)] = rng.choice(words)
        texts.append("  ".join(own))
    for size in range(1, 12):  # small sets at the edge of the similarity
        own = line(size)
        texts += [" ".join(own), " ".join(own + ["tail"]), " ".join(own + ["tail", "end"]), " ".join(own).upper()]
    texts += [None, "", " \t\n", "one", "ONE", "a a a a", "a a", "x" * 40_000, " ".join(line(20_000)), "é È", "É è", "b c d", "\x1cq r"]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    rows += [rows[3], rows[3], (None, rows[5][1]), (None, "nobody else has this"), (None, None)]
    return [(i, t, "k", 1, 2, "l", 3, 4) for i, t in rows]


def word_set(text, width):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def brute(rows, width, percent):
    sets = [word_set(r[1], width) for r in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    least = {}
    for a, r in enumerate(rows):
        if r[0] is not None:
            least[find(a)] = min(r[0], least.get(find(a), r[0]))
    out = collections.Counter()
    for a, r in enumerate(rows):
        component = least.get(find(a)) if sets[a] else r[0]
        out[r[0], len(sets[a]), component, r[0] == component] += 1
    return out


@pytest.mark.parametrize(("width", "percent"), [(2, 80), (1, 60)])
def test_near_copies(spark, width, percent):
    rows = make_rows()
    got = registers.near_copies(spark.createDataFrame(rows, SCHEMA), width=width, percent=percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert collections.Counter(tuple(r) for r in got.collect()) == brute(rows, width, percent)


@pytest.mark.parametrize(("first", "centres"), [(1, 0)])
def test_turns(spark, monkeypatch, first, centres):
    """However much is left to the rarest shingles, the components are the same."""
    monkeypatch.setattr(registers, "FIRST_BANDS", first)
    monkeypatch.setattr(registers, "CENTRES", centres)
    monkeypatch.setattr(registers, "BROADCAST_ROWS", 0)
    rows = make_rows()
    got = registers.near_copies(spark.createDataFrame(rows, SCHEMA), width=2)
    assert collections.Counter(tuple(r) for r in got.collect()) == brute(rows, 2, 80)


def test_empty_table(spark):
    assert registers.near_copies(spark.createDataFrame([], SCHEMA)).collect() == []


def test_shingle_sets():
    texts = [r[1] or "" for r in make_rows()]
    for width in (1, 2, 5):
        for part in (pa.array(texts), pa.array(["x y", *texts]).slice(1), pa.array([""]), pa.array([" a b ", "c", "", "A b"])):
            bounds, hashes = registers.shingle_sets(part, width)
            want = [word_set(t, width) for t in part.to_pylist()]
            assert np.diff(bounds).tolist() == [len(s) for s in want]
            known = {}
            for a, b, s in zip(bounds, bounds[1:], want, strict=False):
                known.setdefault(s, set()).add(hashes[a:b].tobytes())
            assert all(len(v) == 1 for v in known.values()) and len({next(iter(v)) for v in known.values()}) == len(known)


def test_registers_estimate_similarity():
    """Estimates stay within the margin, for small and for large sets, and wanted pairs share a band."""
    rng = np.random.default_rng(1)
    rows = registers.band_rows(80)
    met = total = 0
    for size in (5, 9, 40, 150, 1000):
        for _ in range(60):
            pool = rng.integers(0, 1 << 63, size + size // 4, dtype=np.uint64) * np.uint64(2)
            a, b = np.sort(pool[: size + size // 4]), np.sort(pool[:size])
            s = registers.signatures(np.array([0, len(a), len(a) + len(b)]), np.concatenate([a, b]))
            wanted = len(b) / len(a)
            assert abs(float(registers.estimate(s[:1], s[1:])[0]) - wanted) < registers.MARGIN
            bands = (s[0].reshape(-1, rows) == s[1].reshape(-1, rows)).all(1)
            met, total = met + bands.any(), total + 1
    assert met == total
    assert (1 - 0.8**rows) ** (registers.REGISTERS // rows) <= registers.MISS


def test_unlike_sets_have_unlike_registers():
    rng = np.random.default_rng(3)
    hashes = np.sort(rng.integers(0, 1 << 63, (200, 300), dtype=np.uint64) * np.uint64(2), axis=1)
    s = registers.signatures(np.arange(0, 60_001, 300), hashes.ravel())
    assert abs(registers.estimate(s[::2], s[1::2]).mean()) < 2e-3
