"""Corpus operators against brute force, on a small corpus with nulls, copies, ties and clashing columns."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from riskloom.llm import exact, fingerprints, jaccard, lm, mixing, packing, pii, quality, queries, sharding, suffix
from riskloom.llm.common import staged
from riskloom.llm.components import components

SCHEMA = "doc_id long, text string, lang string, key string, bucket int, n long, first string"


def corpus_rows():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(300)]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = line(40)
    texts = [line(rng.randint(1, 120)) for _ in range(40)]
    base = line(90)
    texts += [base, base, base.replace(" ", "  "), base + " tail", "start " + base, base.upper()]
    texts += [line(30) + "\n" + passage + "\n" + line(30) for _ in range(5)]
    texts += [None, "", " \t\n", "a", "a a a a a a a a", "x" * 30_000, line(4000), "é" * 200]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(3, texts[3]), (3, texts[3]), (None, texts[5]), (None, None)]  # repeated rows and null ids
    return [(i, t, None, "k", 1, None, "f") for i, t in rows]


@pytest.fixture(scope="module")
def rows():
    return corpus_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(text):
    return (text or "").encode().translate(None, b" \t\n\x0b\x0c\r")


def test_exact_copies(docs, rows):
    got = exact.find_copies(docs, bucket_bytes=2000).collect()
    groups = collections.defaultdict(list)
    for i, t, *_ in rows:
        groups[plain(t)].append((-len(t or ""), i is None, i or 0, i))
    want = collections.Counter()
    for body, members in groups.items():
        keep = min(members, key=lambda m: m[:3])[3]
        for m in members:
            want[m[3], keep, len(members), hashlib.sha256(body).hexdigest()] += 1
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)


def test_exact_copies_in_pages(docs, rows):
    """A bucket that cannot be split is dealt over pages; the result is the same."""
    whole = exact.drop_copies(docs)
    assert whole.columns == docs.columns
    assert collections.Counter(plain(r.text) for r in whole.collect()) == dict.fromkeys({plain(t) for _, t, *_ in rows}, 1)


def test_split_buckets_doubles_only_overfull():
    sizes = {0: 10, 1: 10, 1 << 15: 5}
    found = exact.split_buckets(sizes, 12)
    assert {e for e, _, _ in found} == set(sizes)
    assert len({b for _, b, _ in found}) == 3
    assert all(p == 1 for _, _, p in found)
    assert exact.split_buckets({7: 100}, 12) == [(7, 7, 9)]


def word_set(text, width=4):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def test_jaccard_components(docs, rows):
    got = jaccard.join_similar(docs, width=4, percent=85).collect()
    sets = [word_set(t) for _, t, *_ in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    least = {}
    for a, (i, *_) in enumerate(rows):
        if i is not None:
            least[find(a)] = min(i, least.get(find(a), i))
    want = collections.Counter((i, len(sets[a]), least.get(find(a)) if sets[a] else i) for a, (i, *_) in enumerate(rows))
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want


def test_jaccard_remaining_pairs(docs, monkeypatch):
    """Without rounds of leaders all pairs of open lists are formed, with the same result."""
    usual = sorted(map(repr, jaccard.join_similar(docs, 4, 85).collect()))
    monkeypatch.setattr(jaccard, "ROUNDS", 0)
    assert sorted(map(repr, jaccard.join_similar(docs, 4, 85).collect())) == usual


def test_sets_are_read_for_pairs_only(spark, monkeypatch):
    """Texts that share a rare shingle but cannot link are listed; only texts of possible pairs are read again."""
    seen = {"pairs": [], "bodies": []}

    def note(df, label):
        table = staged(df, label)
        seen.get(label, []).append(table)
        return table

    monkeypatch.setattr(jaccard, "staged", note)
    words = lambda i: [f"w{i}x{j}" for j in range(15)]
    apart = [(i, " ".join(words(i // 5) + words(10 + i % 5))) for i in range(20)]  # each half is met in several texts
    near = [(100 + i, " ".join(words(50) + words(51) + [f"end{i}"])) for i in range(3)]
    got = jaccard.join_similar(spark.createDataFrame(apart + near, "doc_id long, text string"), 4, 85).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: min(i, 100) for i, _ in apart + near}
    pairs = {c for p in seen["pairs"] for r in p.collect() for c in (r.a, r.b)}
    assert sorted(r["class"] for b in seen["bodies"] for r in b.collect()) == sorted(pairs)
    assert len(pairs) < 10


def test_components(spark):
    links = [(i, i + 1) for i in range(20)] + [(50, 40), (41, 50), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 21)}, 50: 40, 41: 40}


@pytest.mark.parametrize("hot", [20_000, 1])
def test_repeats_are_removed(docs, rows, hot, monkeypatch):
    monkeypatch.setattr(suffix, "HOT_SNIPPETS", hot)
    monkeypatch.setattr(suffix, "SLICE", 500)
    got = suffix.remove_repeats(docs).collect()
    order = lambda i: suffix.LARGEST if i is None else i
    first = {}
    for i, t, *_ in rows:
        b = (t or "").encode()
        for p in range(len(b) - 49):
            first[b[p : p + 50]] = min(order(i), first.get(b[p : p + 50], order(i)))
    want = collections.Counter()
    for i, t, *_ in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < order(i):
                gone[p : p + 50] = True
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1]))
        want[i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want


def test_snippets_travel_packed():
    """What a bucket sends to the owners is one row each, and smaller than the snippets in it."""
    rng = random.Random(3)
    words = ["".join(rng.choice("etaoinsr") for _ in range(rng.randint(2, 7))) for _ in range(60)]
    body = " ".join(rng.choice(words) for _ in range(4000)).encode()
    table = pa.table({"bucket": pa.array([3, 3], pa.int32()), "id": [5, None], "text": [body, body[:9000]]})
    told = suffix._announce(2, 50)(table)
    hashes = sum(told.column("n").to_pylist())
    assert told.num_rows <= 2 and told.nbytes < 8 * hashes
    found = suffix._snippets(50, 4)(table, suffix._answer(20_000)(told))
    assert 0 < found.num_rows <= 4 and found.nbytes < 0.6 * sum(found.column("bytes").to_pylist())
    for values in (np.array([7, 7, 1 << 63], np.uint64), np.zeros(0, np.uint64)):
        assert (suffix._unpack(suffix._pack(values, True), len(values), np.uint64, True) == values).all()


def test_suffix_order_is_that_of_the_bytes():
    data = np.frombuffer(b"abracadabra-abracadabra-banana" * 9, np.uint8)
    at = np.arange(len(data) - 12)
    order, new = suffix.Suffixes(data, at, 12).classes()
    keys = [data[at[i] : at[i] + 12].tobytes() for i in order]
    assert keys == sorted(keys)
    assert list(new) == [True] + [a != b for a, b in zip(keys, keys[1:], strict=False)]


def test_suffixes_need_few_words(monkeypatch):
    """Copies tie on all their words, but are not compared on them; a misleading hash changes no result."""
    rng = np.random.default_rng(5)
    block = rng.integers(97, 101, 3000).astype(np.uint8)
    data = np.concatenate([block, rng.integers(97, 101, 500).astype(np.uint8), block])
    at = np.arange(len(data) - 50)
    keys = [data[a : a + 50].tobytes() for a in at.tolist()]
    read, word = [], suffix.Suffixes.word
    monkeypatch.setattr(suffix.Suffixes, "word", lambda self, which, offset: read.append(len(which)) or word(self, which, offset))
    order = suffix.Suffixes(data, at, 50).sorted()
    assert sum(read) < 3 * len(at)
    assert [keys[i] for i in order] == sorted(keys)
    monkeypatch.setattr(suffix.Suffixes, "hashes", lambda self: np.zeros(len(self.at), np.uint64))
    group = at % 3
    order, new = suffix.Suffixes(data, at, 50, group).classes()
    pairs = [(group[i], keys[i]) for i in order]
    assert pairs == sorted(pairs)
    assert list(new) == [True] + [a != b for a, b in zip(pairs, pairs[1:], strict=False)]


def test_packing_places(docs, rows):
    files = queries.vocabulary_files()
    got = packing.pack(docs, *files).collect()
    exact_ids = packing._encoders(*files)[1]
    want = collections.Counter()
    for i, t, *_ in rows:
        ids = [*exact_ids.encode(t or "", add_special_tokens=False).ids, 2]
        for k, (start, length) in enumerate(packing.cut(len(ids))):
            want[i, k, start, length, zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 1024
    assert len(sequences) <= -(-sum(r.length for r in got) // 1024) + 1


def test_fullest_combination():
    counts = {7: 2, 5: 3, 4: 1}
    for room in range(1, 30):
        best = max(7 * a + 5 * b + 4 * c for a in range(3) for b in range(4) for c in range(2) if 7 * a + 5 * b + 4 * c <= room)
        chosen = packing.fullest(counts, room)
        assert sum(chosen) == best and all(chosen.count(x) <= counts[x] for x in chosen)


def test_special_token_and_odd_spaces():
    files = queries.vocabulary_files()
    exact_ids = packing._encoders(*files)[1]
    for t in ("a <|endoftext|> b", " \n x  y\u0085 z", "", "it's 12345 ok"):
        assert list(packing.encode(t, *files)) == exact_ids.encode(t, add_special_tokens=False).ids


def test_fingerprints(docs, rows, spark):
    alone = spark.createDataFrame([r for r in rows if r[0] is not None][:-2], SCHEMA)
    data = sorted(((r.doc_id, r.text or "") for r in alone.collect()), reverse=True)
    got = {r.doc_id: r for r in fingerprints.compare_edits(alone).collect()}
    for (i, t), (_, follows) in zip(data, data[1:] + data[:1], strict=True):
        half = len(t) // 2
        edited = t[: len(t) - half] + follows[:half]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (got[i].fingerprint == got[i].edited_fingerprint) == (edited == t)
        assert 0 <= got[i].near_next <= 1
    assert got[40].fingerprint == got[41].fingerprint != got[42].fingerprint
    assert fingerprints.compare_edits(docs).count() == len(rows)


@pytest.mark.parametrize("shards", [3, 40])
def test_shards(docs, rows, shards):
    size = lambda t: len((t or "").encode()) + 16
    digest = sharding.text_digest(docs)
    got = sharding.shard_by_bytes(digest, digest["size"], digest["hash"], shards=shards).collect()
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == collections.Counter((i, size(t), zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    ordered = sorted(got, key=lambda r: (r.hash, r.doc_id is not None, r.doc_id or 0))
    total, below, slots = sum(r.size for r in got), 0, collections.Counter()
    for r in ordered:
        assert r.shard == below * shards // total
        below += r.size
    for r in sorted(got, key=lambda r: (r.shard, r.slot)):
        assert r.slot == slots[r.shard]
        slots[r.shard] += 1


def test_quality_learns_the_label(spark, docs, rows, empty):
    rng = random.Random(5)
    good = [(1000 + i, " ".join(rng.choice(["plain", "words", "of", "a", "text", f"w{rng.randint(0, 50)}"]) for _ in range(40))) for i in range(80)]
    bad = [(2000 + i, " ".join(rng.choice(["BUY", "NOW!!", "cheap$$$", f"w{rng.randint(0, 50)}"]) for _ in range(40))) for i in range(40)]
    table = spark.createDataFrame(good + bad + [(1, None), (1, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i, _ in good[:60]] + [(i, 0) for i, _ in bad[:30]] + [(5000, None), (1000, 1)], "doc_id long, quality int")
    model = quality.train(table, labels)
    scores = {r.doc_id: r.score for r in quality.with_scores(table, model).collect()}
    assert min(scores[i] for i, _ in good[60:]) >= quality.THRESHOLD > max(scores[i] for i, _ in bad[30:])
    assert quality.with_scores(docs, model).count() == len(rows)
    none = quality.train(table, labels.limit(0))
    assert all(abs(r.score - 0.5) < 1e-9 for r in quality.with_scores(table, none).collect())
    assert quality.with_scores(empty, none).count() == 0


def test_mixing_meets_targets(spark):
    rng = random.Random(8)
    word = {"x": ["idiot", "scum"], "y": ["calm", "kind"]}
    rows = [(i, " ".join([rng.choice(word["x" if i % 3 else "y"])] + [f"w{rng.randint(0, 30)}" for _ in range(rng.randint(5, 40))]), 1, "e") for i in range(300)]
    docs = spark.createDataFrame([*rows, (900, None, 1, "e"), (901, "", 1, "e")], "doc_id long, text string, rate int, __none string")
    labelled = spark.createDataFrame([(i, "x" if i % 3 else "y") for i in range(0, 300, 2)] + [(7000, "x")], "doc_id long, domain string")
    classifier = mixing.fit_domains(docs, labelled)
    got = mixing.fit_rates(docs, classifier, {"x": 0.5, "y": 0.5}).collect()
    assert len(got) == 302
    tokens = [sum(r.rate * r.n_tokens * r.posteriors[k] for r in got) for k in range(2)]
    assert abs(tokens[0] - tokens[1]) <= 0.01 * sum(tokens)
    assert all(r.rate >= 0 for r in got) and {r.doc_id: r.n_tokens for r in got}[900] == 0
    kept = mixing.drawn(mixing.fit_rates(docs, classifier, {"x": 0.1, "y": 0.9}, most=1.0, anchor="y", names=("__a", "__b", "__c")), names=("__a", "__b", "__c"))
    assert kept.columns == docs.columns and kept.where("doc_id < 300 AND doc_id % 3 = 0").count() == 100


def test_every_telling_feature_counts(spark, monkeypatch):
    """More telling words than fit a short list: each rare one is all that tells its documents' domain."""
    some = lambda kind, i, n: " ".join(f"{kind}{(i + j) % n}" for j in range(5))
    rows = [(i, some("junk", i, 200), "junk") for i in range(4000)] + [(5000 + i, some("scorn", i, 40), "toxic") for i in range(800)] + [(6000 + i, f"plain{i}", "plain") for i in range(4000)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labelled = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, domain string")
    for limit in (mixing.BROADCAST_ROWS, 0):
        monkeypatch.setattr(mixing, "BROADCAST_ROWS", limit)
        classifier = mixing.fit_domains(docs, labelled)
        got = mixing.fit_rates(docs, classifier, {"plain": 1.0}).select("doc_id", "posteriors").collect()
        best = {r.doc_id: classifier.domains[int(np.argmax(r.posteriors))] for r in got}
        assert best == {r[0]: r[2] for r in rows}


def test_luck_tells_no_domain(spark):
    """Words dealt by chance tell a domain no oftener than the bound says, however rare the word and small the domain; what only its documents hold does."""
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{rng.randrange(10**rng.randint(1, 4))}" for _ in range(40)) + " pills" * (i < 12)) for i in range(3000)]
    labelled = spark.createDataFrame([(i, "junk" if i < 12 else "plain") for i, _ in rows], "doc_id long, domain string")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    classifier = mixing.fit_domains(docs, labelled)
    words = {r.feature for r in classifier.weights.collect()}
    tried = len({w for _, text in rows for w in text.split()})
    assert "pills" in words and len(words) <= 1 + 2 * tried * np.exp(-(mixing.CHANCE**2) / 2)
    got = mixing.fit_rates(docs, classifier, {"plain": 1.0}).select("doc_id", "posteriors").collect()
    assert min(r.posteriors[0] for r in got if r.doc_id < 12) > max(r.posteriors[0] for r in got if r.doc_id >= 12)
    bare = docs.selectExpr("doc_id", "' ' AS text")
    assert mixing.fit_domains(bare, labelled).weights.count() == 0


def test_pseudonyms_round_trip(spark, docs, rows, empty):
    text = "card 4111 1111 1111 1111, not 4111 1111 1111 1112; ssn 123-45-6789 on 2020-02-29 or 31.12.1999, never 30.02.1999; ab.c9@mail.com +1 (555) 010-9999 10.0.255.3"
    table = spark.createDataFrame([(1, text, "x"), (2, text, "y"), (3, None, None), (4, "", None), (5, "plain words", "")], "doc_id long, text string, n_values string")
    hidden = pii.pseudonymise(table, "key", count="n_values")
    got = {r.doc_id: r for r in hidden.collect()}
    assert got[1].text == got[2].text != text and got[1].n_values == 7
    for value in ("4111 1111 1111 1111,", "123-45-6789", "2020-02-29", "31.12.1999", "ab.c9@", "(555) 010-9999", "10.0.255.3"):
        assert value not in got[1].text
    assert "4111 1111 1111 1112" in got[1].text and "30.02.1999" in got[1].text
    assert (got[3].text, got[4].text, got[5].text) == (None, "", "plain words")
    digits = [int(c) for c in got[1].text[5:24] if c.isdigit()]
    assert sum(d if i % 2 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits)) % 10 == 0
    assert {r.doc_id: r.text for r in pii.pseudonymise(hidden, "key", restore=True).collect()}[1] == text
    assert {r.doc_id: r.text for r in pii.pseudonymise(table, "other").collect()}[1] != got[1].text
    assert sorted(map(repr, pii.pseudonymise(docs, "key").collect())) == sorted(map(repr, docs.collect()))
    assert pii.pseudonymise(empty, "key").count() == 0


def test_pseudonyms_of_all_telephone_forms(spark):
    """Any area, with and without brackets; and texts without two digits side by side."""
    values = ["+1 (017) 555-7713", "(132) 555-1352", "415-555-2671", "415.555.2671", "+1 000 555 2671", "+14155552671", "8.8.8.8", "4-1-1-1-1-1-1-1-1-1-1-1-1-1-1-1"]
    table = spark.createDataFrame([(i, f"at {v} now") for i, v in enumerate(values)], "doc_id long, text string")
    hidden = pii.pseudonymise(table, "key", count="n")
    got = {r.doc_id: r for r in hidden.collect()}
    for i, v in enumerate(values):
        assert v not in got[i].text and got[i].n == 1
    back = {r.doc_id: r.text for r in pii.pseudonymise(hidden, "key", restore=True).collect()}
    assert [back[i] for i in range(len(values))] == [f"at {v} now" for v in values]


def test_cards_beside_other_digits(spark):
    """Groups before, after or on both sides; forms with and without gaps; numbers that are no cards stay."""
    around = [("12 ", ""), ("", " 12"), ("7-", ""), ("1 ", " 2"), ("", "-123")]
    cards = ["4111 1111 1111 1111", "4111-1111-1111-1111", "5500005555555559", "3782 822463 10005"]
    texts = [f"{a}{c}{b}" for c in cards for a, b in around]
    table = spark.createDataFrame([(i, f"no. {t}, paid") for i, t in enumerate([*texts, "12 4111 1111 1111 1112"])], "doc_id long, text string")
    hidden = pii.pseudonymise(table, "key", count="n")
    got = {r.doc_id: r for r in hidden.collect()}
    for i, t in enumerate(texts):
        assert cards[i // len(around)] not in got[i].text and got[i].n == 1 and len(got[i].text) == len(t) + 10
    assert (got[len(texts)].text, got[len(texts)].n) == ("no. 12 4111 1111 1111 1112, paid", 0)
    fresh = {cards[k]: [got[k * len(around) + j].text[4 + len(a) :][: len(cards[k])] for j, (a, _) in enumerate(around)] for k in range(len(cards))}
    assert all(collections.Counter(v).most_common(1)[0][1] >= 3 for v in fresh.values())


def test_language_model(docs, rows):
    language, counts = lm.fit(docs, head=20, known=50)
    got = lm.score_texts(docs, language, counts).collect()
    seen = collections.Counter(t for _, text, *_ in rows for t in lm.tokens((text or "").encode()))
    n, v = sum(seen.values()), len(seen)
    want = collections.Counter()
    for i, text, *_ in rows:
        own = lm.tokens((text or "").encode())
        want[i, len(own), len(own), n, round(sum(np.log10((seen[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own), 6)] += 1
    assert collections.Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    lengths = np.array([1])
    total = sum(10 ** language.class_log10(np.array([k]), lengths)[0] for k in range(language.classes))
    assert abs(total - 1) < 1e-3
    assert sum(r.score for r in got) > sum(r.base_score for r in got) * 1.05


def test_training_reads_classes_once(docs, rows, monkeypatch):
    """A text is split once for all rounds, which read its tokens' classes from a table."""
    seen = []

    def note(df, label):
        seen.append((label, staged(df, label)))
        return seen[-1][1]

    monkeypatch.setattr(lm, "staged", note)
    language, _ = lm.fit(docs, head=20, known=50, rounds=2)
    kinds = [table for label, table in seen if label == "kinds"]
    assert len(kinds) == 1
    want = collections.Counter(tuple(language.read(lm.tokens((t or "").encode()))[1].tolist()) for _, t, *_ in rows)
    assert collections.Counter(tuple(np.frombuffer(r.kinds, language.kind_type).tolist()) for r in kinds[0].collect()) == want


def test_empty_tables(empty):
    assert exact.find_copies(empty).count() == 0
    assert jaccard.join_similar(empty).count() == 0
    assert suffix.remove_repeats(empty).count() == 0
    assert packing.pack(empty, *queries.vocabulary_files()).count() == 0
    assert fingerprints.compare_edits(empty).count() == 0
    digest = sharding.text_digest(empty)
    assert sharding.shard_by_bytes(digest, digest["size"], digest["hash"]).count() == 0
    language, counts = lm.fit(empty)
    assert lm.score_texts(empty, language, counts).count() == 0
    labelled = empty.select("doc_id", empty["lang"].alias("domain"))
    assert mixing.fit_rates(empty, mixing.fit_domains(empty, labelled), {}).count() == 0
