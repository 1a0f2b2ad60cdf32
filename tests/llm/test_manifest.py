"""The Merkle manifest against a plain recursive one."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from riskloom.llm import manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, pos int, node string, total long, path string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes):
    """The node that is left, and for each given node its (before, after) siblings level by level."""
    paths = [[] for _ in nodes]
    owners = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, up_owners = [], []
        for s in range(0, len(nodes), 3):
            run = nodes[s : s + 3]
            for k in range(len(run)):
                for i in owners[s + k]:
                    paths[i].append((run[:k], run[k + 1 :]))
            up.append(h(*run))
            up_owners.append(sum(owners[s : s + 3], []))
        nodes, owners = up, up_owners
    return nodes[0], paths


def brute(rows):
    full = []
    for i, t, lang, source, n, *_ in rows:
        own = leaf([i, source, lang, n, t])
        bad = i is not None and zlib.crc32(str(i).encode()) % 2 == 0
        full.append((source, i, own, leaf([i, source, lang, n, t.replace("\n", "") if bad and t is not None else t])))
    sources = sorted({r[0] for r in full}, key=lambda s: (s is not None, (s or "").encode()))
    groups = [sorted((r for r in full if r[0] == s), key=lambda r: (r[1] is not None, r[1] or 0, r[2])) for s in sources]
    trees = [tree([r[2] for r in g]) for g in groups]
    root, above = tree([t[0] for t in trees])
    out = []
    for g, (subroot, paths), top in zip(groups, trees, above, strict=True):
        for (_, i, own, claimed), path in zip(g, paths, strict=True):
            folded = claimed
            for before, after in path + top:
                folded = h(*before, folded, *after)
            proof = h(*[x for before, after in path + top for x in before + after])
            out.append((i, own, subroot, root, proof, folded, folded == root))
    return sorted(out, key=repr)


def make_rows():
    rng = random.Random(5)
    rows = []
    for i in range(150):
        source = rng.choice(["hot", "hot", "hot", "b", "é", "Z", None, ""])
        text = rng.choice(["line\nline", "one", "", None, "x" * rng.randint(1, 50_000), "é\n\ny"])
        rows.append((i, text, rng.choice(["en", None]), source, rng.choice([None, len(text or "")])))
    rows += [rows[3], rows[3], (None, "a\nb", None, "hot", 3), (None, None, None, None, None), (None, "a\nb", None, "hot", 3), (7, "alone", "en", "single", 5)]
    return [(*r, "k", 1, "n", 2, "p") for r in rows]


def even(c="doc_id"):
    return F.crc32(F.col(c).cast("string")) % 2 == 0


@pytest.mark.parametrize("depth", [1, 2, 6])
def test_manifest(spark, depth):
    rows = make_rows()
    got = manifest.build(spark.createDataFrame(rows, SCHEMA), even(), depth=depth)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted([tuple(r) for r in got.collect()], key=repr) == brute(rows)


def test_manifest_of_few_rows(spark):
    one = make_rows()[:1]
    got = manifest.build(spark.createDataFrame(one, SCHEMA), F.lit(False)).collect()
    assert len(got) == 1 and got[0].leaf == got[0].subroot == got[0].root and got[0].proof_sha256 == h() and got[0].verified
    assert manifest.build(spark.createDataFrame([], SCHEMA), even()).collect() == []


def test_changes_are_found(spark):
    """Exactly the rows whose claimed text differs fail, and any change of a row changes the root."""
    rows = make_rows()
    got = manifest.build(spark.createDataFrame(rows, SCHEMA), even()).collect()
    changed = {r[0] for r in rows if r[0] is not None and "\n" in (r[1] or "") and zlib.crc32(str(r[0]).encode()) % 2 == 0}
    assert changed and {r.doc_id for r in got if not r.verified} == changed
    other = [(*rows[0][:4], 99, *rows[0][5:]), *rows[1:]]
    assert manifest.build(spark.createDataFrame(other, SCHEMA), even()).first().root != got[0].root
