"""Removal of passages that also start in a document with a smaller id, by hash-compared suffix sorting.

A text is treated as UTF-8 bytes; a byte goes if a window of `length` bytes over it also starts in a document
with a smaller id. Windows are grouped by the smallest hash of the 16-byte strings inside them, so equal
windows share a group, and runs of neighbouring windows of one group travel as one snippet.

1. Documents are dealt into buckets. Each bucket sends the group hashes it has, once each, to their owners,
   which answer which ones occur in several documents, and which in very many.
2. For those, each bucket sends its distinct snippets with their smallest id to the groups' owners, so copies
   count once in a bucket however many there are.
3. Owners unite equal snippets and sort the windows of different ones that share a group as suffixes: by their
   words of eight bytes, one after the other, in runs that still tie. A run whose windows have one polynomial hash
   needs no further words. Neighbours that seem equal, and the order itself, are verified on the bytes. Equal
   windows take their smallest id. A group of very many documents is not gathered: its windows are dealt singly,
   by their own hash.
4. The buckets read off, for every window of every document, whether that id is smaller than its own.

What one side sends to the other in a step is one row: hashes in order as differences, numbers by byte planes,
snippets end to end, all compressed, as hashes and short snippets would not shrink row by row.

Defined results: a null text counts as empty; rows with one id do not affect each other; a null id counts as
larger than all others; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import mixed, signed, text_of

LENGTH = 50
GRAM = 16
#: Text bytes in a bucket, about; and windows in a snippet, at most.
BUCKET_BYTES = 8 << 20
RUN = 64
#: Documents of one group beyond which its windows are dealt singly.
HOT_SNIPPETS = 20_000
SLICE = 2 << 20
LARGEST = (1 << 63) - 1
#: Bits of a group's hash that are not sent; groups that then coincide are settled together.
SPARED = np.uint64(8)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _squeezed(data: bytes) -> bytes:
    return pa.Codec("zstd", compression_level=3).compress(data, asbytes=True)


def _restored(data: bytes, size: int) -> bytes:
    return pa.decompress(data, size, "zstd", asbytes=True)


def _pack(values: np.ndarray, ordered: bool = False) -> bytes:
    """Numbers by byte planes, compressed; differences of those in order."""
    if not len(values):
        return b""
    values = np.ascontiguousarray(np.diff(values, prepend=values.dtype.type(0)) if ordered else values)
    return _squeezed(values.view(np.uint8).reshape(len(values), -1).T.tobytes())


def _unpack(packed: bytes, n: int, kind: type, ordered: bool = False) -> np.ndarray:
    if not n:
        return np.zeros(0, kind)
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(_restored(packed, n * width), np.uint8).reshape(width, n)
    values = np.ascontiguousarray(planes.T).view(kind).ravel()
    return np.cumsum(values, dtype=kind) if ordered else values


def _columns(table: pa.Table, *names: str) -> Iterator[tuple]:
    return zip(*(table.column(c).to_pylist() for c in names), strict=True)


def _table(rows: list[tuple], schema: str) -> pa.Table:
    """A table of rows; `schema` as Spark has it."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.table([pa.array([r[k] for r in rows], kinds[kind]) for k, (_, kind) in enumerate(fields)], names=[name for name, _ in fields])


def _runs_of(*keys: np.ndarray) -> list[tuple[int, int]]:
    """Where rows with the same keys begin and end."""
    n = len(keys[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    start = np.flatnonzero(new)
    return list(zip(start.tolist(), np.append(start[1:], n).tolist(), strict=False))


def _gram_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hashes of all strings of `width` bytes, a power of two."""
    h, base, n = data.astype(np.uint64) + np.uint64(1), _BASE, 1
    while n < width:
        h = h[:-n] * base + h[n:]
        base = np.uint64(int(base) * int(base) & 0xFFFFFFFFFFFFFFFF)
        n *= 2
    return mixed(h)


def _smallest(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum over every `width` neighbours."""
    m, n = h, 1
    while 2 * n <= width:
        m = np.minimum(m[:-n], m[n:])
        n *= 2
    return m if n == width else np.minimum(m[: len(h) - width + 1], m[width - n :])


def runs(texts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the texts set end to end: the bytes, and for each run of windows its start, windows, group and text."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return data, empty, empty, empty.astype(np.uint64), empty
    ends = np.cumsum(sizes)
    group = _smallest(_gram_hashes(data, GRAM), length - GRAM + 1)
    owner = np.repeat(np.arange(len(texts)), sizes)
    at = np.flatnonzero(np.arange(len(group)) + length <= ends[owner[: len(group)]])
    if not len(at):
        return data, empty, empty, empty.astype(np.uint64), empty
    value = group[at] >> SPARED
    cut = np.append(True, (value[1:] != value[:-1]) | (at[1:] != at[:-1] + 1))
    first = np.flatnonzero(cut)
    along = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
    first = np.flatnonzero(along % RUN == 0)
    return data, at[first], np.diff(np.append(first, len(at))), value[first], owner[at[first]]


def _slices(table: pa.Table) -> Iterator[tuple[list, list[bytes]]]:
    ids, texts, size = [], [], 0
    for i, t in zip(table.column("id").to_pylist(), table.column("text").to_pylist(), strict=True):
        if ids and size + len(t) > SLICE:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(i)
        texts.append(t)
        size += len(t)
    if ids:
        yield ids, texts


def _order(ids: list) -> np.ndarray:
    return np.array([LARGEST if i is None else i for i in ids], np.int64)


ANNOUNCED = "bucket int, part int, n long, hashes binary, docs binary"
ANSWERED = "bucket int, n long, hashes binary, n_hot long, hot binary"
FOUND = "bucket int, owner int, n long, grp binary, home binary, sizes binary, bytes long, snippets binary, lo binary, above binary"
SETTLED = "bucket int, n long, grp binary, home binary, name binary, counts binary, ids long, least binary"


def _announce(parts: int, length: int):
    """Group hashes of a bucket with the number of its documents that have them, by owner."""

    def announce(table: pa.Table) -> pa.Table:
        found = []
        for ids, texts in _slices(table):
            _, _, _, group, text = runs(texts, length)
            found.append((group, _order(ids)[text]))
        group, owner = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((owner, group))
        group, owner = group[order], owner[order]
        new = np.append(True, group[1:] != group[:-1])[: len(group)]
        another = new | np.append(True, owner[1:] != owner[:-1])[: len(group)]
        first = np.flatnonzero(new)
        docs = np.minimum(np.add.reduceat(another.astype(np.int64), first), 65535).astype(np.uint16) if len(first) else np.zeros(0, np.uint16)
        group = group[first]
        part = (group % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        part, group, docs = part[order], group[order], docs[order]
        bucket = table.column("bucket")[0].as_py()
        return _table([(bucket, int(part[a]), b - a, _pack(group[a:b], True), _pack(docs[a:b])) for a, b in _runs_of(part)], ANNOUNCED)

    return announce


def _answer(limit: int):
    """To each bucket, which of its hashes occur in several documents, and which in very many."""

    def answer(table: pa.Table) -> pa.Table:
        hashes = [_unpack(packed, n, np.uint64, True) for n, packed in _columns(table, "n", "hashes")]
        docs = np.concatenate([_unpack(packed, n, np.uint16) for n, packed in _columns(table, "n", "docs")])
        values, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.bincount(inverse, docs, len(values))
        shared, hot = values[total > 1], values[total > limit]
        kept = [(h[_among(h, shared)], h[_among(h, hot)]) for h in hashes]
        return _table([(b, len(s), _pack(s, True), len(h), _pack(h, True)) for b, (s, h) in zip(table.column("bucket").to_pylist(), kept, strict=True)], ANSWERED)

    return answer


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of the values occur in `known`, which is in order."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _shared_runs(ids: list, texts: list[bytes], shared: np.ndarray, length: int):
    data, start, windows, group, text = runs(texts, length)
    keep = np.flatnonzero(_among(group, shared))
    raw = data.tobytes()
    for s, n, g, t in zip(start[keep].tolist(), windows[keep].tolist(), group[keep].view(np.int64).tolist(), text[keep].tolist(), strict=True):
        yield s, n, g, t, raw[s : s + n + length - 1]


def _joined(answers: pa.Table, size: str, packed: str) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint64), *(_unpack(p, n, np.uint64, True) for n, p in _columns(answers, size, packed))])


def _name(snippet: bytes) -> int:
    """A snippet's name within its group; a window dealt singly has its name as its group."""
    return signed(xxhash.xxh3_64_intdigest(snippet))


def _snippets(length: int, owners: int):
    """Of a bucket's distinct snippets, for each owner: group, the group's hash where it differs, snippet, smallest and largest id."""

    def collect(table: pa.Table, answers: pa.Table) -> pa.Table:
        shared, met = np.sort(_joined(answers, "n", "hashes")), {}
        hot = set(_joined(answers, "n_hot", "hot").view(np.int64).tolist())
        for ids, texts in _slices(table):
            order = _order(ids)
            for _, n, g, t, snippet in _shared_runs(ids, texts, shared, length):
                i = int(order[t])
                for part in [snippet[j : j + length] for j in range(n)] if g in hot else [snippet]:
                    lo, hi = met.get((g, part), (i, i))
                    met[g, part] = (min(lo, i), max(hi, i))
        bucket = table.column("bucket")[0].as_py() if table.num_rows else 0
        home = np.fromiter((g for g, _ in met), np.int64, len(met))
        grp = np.fromiter((_name(part) if g in hot else g for g, part in met), np.int64, len(met))
        parts = [part for _, part in met]
        lo, hi = np.array(list(met.values()), np.int64).reshape(-1, 2).T
        owner = (grp.view(np.uint64) % np.uint64(owners)).astype(np.int64)
        order = np.lexsort((grp.view(np.uint64), owner))
        rows = []
        for a, b in _runs_of(owner[order]):
            own = order[a:b]
            snippets = [parts[i] for i in own.tolist()]
            text = b"".join(snippets)
            sizes = np.array([len(s) for s in snippets], np.uint32)
            rows.append((bucket, int(owner[own[0]]), b - a, _pack(grp[own].view(np.uint64), True), _homes(home[own], grp[own]), _pack(sizes), len(text), _squeezed(text), _pack(lo[own]), _pack(hi[own] - lo[own])))
        return _table(rows, FOUND)

    return collect


def _homes(home: np.ndarray, grp: np.ndarray) -> bytes:
    return b"" if (home == grp).all() else _pack(home)


def _groups(grp: bytes, home: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    groups = _unpack(grp, n, np.uint64, True).view(np.int64)
    return groups, _unpack(home, n, np.int64) if home else groups


class Suffixes:
    """Suffixes of a byte string, in groups, ordered by their first `length` bytes (eight at least)."""

    def __init__(self, data: np.ndarray, at: np.ndarray, length: int, group: np.ndarray | None = None):
        self.data, self.at, self.length = data, at, length
        self.group = np.zeros(len(at), np.int64) if group is None else group
        self.words = np.ndarray((max(0, len(data) - 7),), ">u8", data, strides=(1,))  # at every byte
        self.offsets = [*range(0, length - 8, 8), length - 8]

    def hashes(self) -> np.ndarray:
        """Polynomial hashes of the first `length` bytes, from sums over all bytes before."""
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        powers = np.cumprod(np.append(np.uint64(1), np.full(len(self.data), _BASE)), dtype=np.uint64)
        sums = np.append(np.uint64(0), np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * powers[:-1], dtype=np.uint64))
        del powers
        back = np.cumprod(np.append(np.uint64(1), np.full(len(self.data), inverse)), dtype=np.uint64)
        return (sums[self.at + self.length] - sums[self.at]) * back[self.at]

    def word(self, which: np.ndarray, offset: int) -> np.ndarray:
        return self.words[self.at[which] + offset].astype(np.uint64)

    def sorted(self) -> np.ndarray:
        """By group, then by one word after the other, where a run of ties has several hashes."""
        whole = self.hashes()
        order = np.argsort(self.group, kind="stable")
        open_, run = np.arange(len(order)), self.group[order]
        for offset in self.offsets:
            # of the open places, which are in runs with several hashes
            first = np.flatnonzero(np.append(True, run[1:] != run[:-1])[: len(run)])
            sizes = np.diff(np.append(first, len(run)))
            own = whole[order[open_]]
            unlike = np.logical_or.reduceat(own != np.repeat(own[first], sizes), first) if len(first) else np.zeros(0, bool)
            stay = np.repeat(unlike, sizes)
            open_, run = open_[stay], np.repeat(np.arange(len(first)), sizes)[stay]
            if not len(open_):
                break
            which = order[open_]
            word = self.word(which, offset)
            by_word = np.lexsort((word, run))
            order[open_], run, word = which[by_word], run[by_word], word[by_word]
            run = np.cumsum(np.append(True, (run[1:] != run[:-1]) | (word[1:] != word[:-1])))
        return order

    def classes(self) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes in order, and where a different one begins; verified on the bytes."""
        order = self.sorted()
        new, good = [np.ones(min(1, len(order)), bool)], True
        for i in range(1, len(order), 1 << 18):
            part = order[i - 1 : i + (1 << 18)]
            group = self.group[part]
            apart, less = group[1:] != group[:-1], group[1:] > group[:-1]
            for offset in self.offsets:
                word = self.word(part, offset)
                less |= ~apart & (word[1:] > word[:-1])
                apart |= word[1:] != word[:-1]
            new.append(apart)
            good &= bool((less | ~apart).all())
        if not good:  # a collision misled the order
            keys = [(g, self.data[a : a + self.length].tobytes()) for g, a in zip(self.group.tolist(), self.at.tolist(), strict=True)]
            order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
            return order, np.array([True] + [keys[a] != keys[b] for a, b in zip(order[:-1].tolist(), order[1:].tolist(), strict=True)])
        return order, np.concatenate(new)


def _settle(length: int):
    """To each bucket, for its snippets, the smallest id of each window (one number if it is the same for all)."""

    def settle(table: pa.Table) -> pa.Table:
        keys: list[tuple[int, bytes]] = []
        united: dict[tuple[int, bytes], int] = {}
        homes, largest = [], []
        for n, grp, home, sizes, size, snippets, lo, above in _columns(table, "n", "grp", "home", "sizes", "bytes", "snippets", "lo", "above"):
            groups, own_homes = _groups(grp, home, n)
            lows = _unpack(lo, n, np.int64)
            text, ends = _restored(snippets, size), np.cumsum(_unpack(sizes, n, np.uint32), dtype=np.int64).tolist()
            homes.append(own_homes)
            largest.append(lows + _unpack(above, n, np.int64))
            for g, a, b, least in zip(groups.tolist(), [0, *ends], ends, lows.tolist(), strict=False):
                key = (g, text[a:b])
                keys.append(key)
                united[key] = min(least, united.get(key, least))
        met = Counter(g for g, _ in united)
        several: dict[tuple[int, bytes], list[int]] = {}  # of snippets whose windows have different ids
        mixed_keys = [key for key in united if met[key[0]] > 1]
        if mixed_keys:
            n = np.array([len(s) - length + 1 for _, s in mixed_keys], np.int64)
            sizes = n + length - 1
            at = np.repeat(np.cumsum(sizes) - sizes, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            _, group = np.unique(np.array([g for g, _ in mixed_keys], np.int64), return_inverse=True)
            suffixes = Suffixes(np.frombuffer(b"".join(s for _, s in mixed_keys), np.uint8), at, length, np.repeat(group, n))
            order, new = suffixes.classes()
            own = np.repeat(np.array([united[key] for key in mixed_keys], np.int64), n)[order]
            out = np.empty(len(order), np.int64)
            out[order] = np.minimum.reduceat(own, np.flatnonzero(new))[np.cumsum(new) - 1]
            first = np.cumsum(n) - n
            lowest, most = np.minimum.reduceat(out, first), np.maximum.reduceat(out, first)
            united.update(zip(mixed_keys, lowest.tolist(), strict=True))
            for i in np.flatnonzero(lowest != most).tolist():
                several[mixed_keys[i]] = out[first[i] : first[i] + n[i]].tolist()
        rows, at = [], 0
        for bucket, own_homes, most in zip(table.column("bucket").to_pylist(), homes, largest, strict=True):
            mine = keys[at : at + len(most)]
            at += len(most)
            told = [i for i, (key, hi) in enumerate(zip(mine, most.tolist(), strict=True)) if united[key] < hi]
            if not told:
                continue
            least = [several.get(mine[i]) or [united[mine[i]]] for i in told]
            groups, names = (np.array(x, np.int64) for x in ([mine[i][0] for i in told], [_name(mine[i][1]) for i in told]))
            flat = np.array([x for ids in least for x in ids], np.int64)
            rows.append((bucket, len(told), _pack(groups.view(np.uint64), True), _homes(own_homes[told], groups), _pack(names), _pack(np.array([len(ids) for ids in least], np.uint32)), len(flat), _pack(flat)))
        return _table(rows, SETTLED)

    return settle


def _remove(length: int):
    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        known: dict[tuple[int, int], list[int]] = {}
        homes, hot = [np.zeros(0, np.int64)], set()
        for n, grp, home, name, counts, ids, least in _columns(answers, "n", "grp", "home", "name", "counts", "ids", "least"):
            groups, own_homes = _groups(grp, home, n)
            homes.append(own_homes)
            hot.update(own_homes[own_homes != groups].tolist())
            flat, ends = _unpack(least, ids, np.int64).tolist(), np.cumsum(_unpack(counts, n, np.uint32), dtype=np.int64).tolist()
            names = _unpack(name, n, np.int64).tolist()
            known.update(((g, x), flat[a:b]) for g, x, a, b in zip(groups.tolist(), names, [0, *ends], ends, strict=False))
        shared = np.unique(np.concatenate(homes).view(np.uint64))
        rows = []
        for ids, texts in _slices(table):
            order, sizes = _order(ids).tolist(), [len(t) for t in texts]
            starts = np.cumsum(sizes) - sizes
            begin, end = [], []  # of what goes
            for s, n, g, t, snippet in _shared_runs(ids, texts, shared, length):
                if g in hot:
                    least = [known.get((x, x), [LARGEST])[0] for x in (_name(snippet[j : j + length]) for j in range(n))]
                else:
                    least = known.get((g, _name(snippet)), ())
                if len(least) == 1:  # one id for all windows
                    hit = [(s, n)] if least[0] < order[t] else []
                else:
                    hit = [(s + j, 1) for j, x in enumerate(least) if x < order[t]]
                begin += [a for a, _ in hit]
                end += [a + m - 1 + length for a, m in hit]
            cover = np.bincount(np.array(begin, np.int64), minlength=sum(sizes) + 1) - np.bincount(np.array(end, np.int64), minlength=sum(sizes) + 1)
            gone = np.cumsum(cover)[:-1] > 0
            for i, text, start, size in zip(ids, texts, starts, sizes, strict=True):
                mask = gone[start : start + size]
                kept = np.frombuffer(text, np.uint8)[~mask].tobytes()
                spans = int(mask[:1].sum() + (mask[1:] & ~mask[:-1]).sum())
                rows.append((i, size, int(mask.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        return pa.table([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return remove


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """For every row: bytes, bytes and runs removed, and the bytes that stay, with their digest."""
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.encode(text_of(text_col), "UTF-8").alias("text"))
    total = docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`").cast("string")))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // bucket_bytes))
    dealt = texts.withColumn("bucket", F.pmod(F.xxhash64("id", F.crc32("text")), F.lit(buckets)).cast("int")).repartition(buckets, "bucket")
    by_bucket = dealt.groupBy("bucket")

    # one plan, so that the texts are exchanged once for all three
    announced = by_bucket.applyInArrow(_announce(min(buckets, 1024), length), ANNOUNCED)
    answers = announced.groupBy("part").applyInArrow(_answer(HOT_SNIPPETS), ANSWERED)
    found = by_bucket.cogroup(answers.groupBy("bucket")).applyInArrow(_snippets(length, buckets), FOUND)
    back = found.groupBy("owner").applyInArrow(_settle(length), SETTLED)
    return by_bucket.cogroup(back.groupBy("bucket")).applyInArrow(_remove(length), "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary").withColumnRenamed("id", id_col)
