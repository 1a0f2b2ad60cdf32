"""The stages of the corpus pipeline against brute force, with null and repeated ids and clashing columns."""

import collections
import random

import pyarrow as pa
import pytest

import corpus_pipeline
from riskloom.llm import exact, jaccard, packing, quality
from riskloom.llm.queries import vocabulary_files

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, carried string, text_hash string"


def corpus():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(300)]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n))
    good = [(i, "the plain report of the day " + line(60)) for i in range(30)]
    junk = [(100 + i, "buy now cheap pills click here " * 8 + line(3)) for i in range(20)]
    base, other = line(80), line(80)
    near = [(200, base), (201, base + " tail"), (None, base + " end"), (None, other), (None, other + " tail"), (202, base.upper())]
    # one id for a near copy and for a text of its own; the same row twice; nothing at all
    near += [(203, base + " last"), (203, line(70)), (204, line(50)), (204, None), (205, ""), (None, None), (206, " \n")]
    rows = good + junk + near + [near[8]] * 2 + [good[3]] * 2
    return [(i, t, "x", "s", len(t or ""), "c", "h") for i, t in rows]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(corpus(), SCHEMA).write.parquet(f"{path}/documents.parquet")
    marks = [(i, 1, 0) for i in range(30)] + [(100 + i, 0, 0) for i in range(20)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def counted(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_near_copies_by_row(spark):
    rows = corpus()
    kept = jaccard.drop_similar(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == [c.split()[0] for c in SCHEMA.split(", ")]

    def shingles(text):
        w = (text or "").lower().split()
        return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])

    sets = [shingles(r[1]) for r in rows]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                label = [label[b] if x == label[a] else x for x in label]
    groups = collections.defaultdict(list)
    for r, s, x in zip(rows, sets, label, strict=True):
        groups[x if s else ("empty", len(groups))].append(r)
    got = counted(kept)
    assert sum(got.values()) == len(groups)
    for members in groups.values():
        least = min((r[0] for r in members if r[0] is not None), default=None)
        assert any(got[r] for r in members if r[0] == least)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    good = corpus_pipeline.keep_good(spark, docs, folder)
    model = quality.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    scored = quality.with_scores(docs, model, score="__s").collect()
    assert counted(good) == collections.Counter(tuple(r)[:-1] for r in scored if r["__s"] >= quality.THRESHOLD)
    ids = {r.doc_id for r in good.collect()}
    assert ids >= set(range(30)) and not ids & set(range(100, 120))

    single = corpus_pipeline.drop_copies(spark, docs, folder)
    body = lambda t: "".join((t or "").split())
    want = {}
    for r in docs.collect():
        rank = (-len(r.text or ""), r.doc_id is None, r.doc_id or 0)
        want[body(r.text)] = min(want.get(body(r.text), (rank, r.doc_id)), (rank, r.doc_id), key=lambda x: x[0])
    assert sorted((body(r.text), r.doc_id) for r in single.select("text", "doc_id").collect()) == sorted((k, v[1]) for k, v in want.items())

    result = corpus_pipeline.run(spark, folder)
    pieces = collections.defaultdict(int)
    for r in result.collect():
        pieces[r.sequence_id] += r.length
    assert pieces and max(pieces.values()) <= 1024
    assert set(range(30)) <= {r.doc_id for r in result.select("doc_id").collect()}
    packed = packing.pack(docs.limit(0), *vocabulary_files())
    assert packed.count() == 0


@pytest.mark.parametrize("marked", [False, True])
def test_empty_tables(spark, folder, tmp_path, marked):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    marks = spark.read.parquet(f"{folder}/labels.parquet")
    (marks if marked else marks.limit(0)).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_copies_leave_only_their_marks(spark, tmp_path, monkeypatch):
    """Tables on the way are deleted before the result is read, and no second set of Python workers is started."""
    monkeypatch.setattr("riskloom.session.shared_folder", lambda _: str(tmp_path))
    monkeypatch.setattr(type(spark.sparkContext), "parallelize", lambda *a, **k: pytest.fail("a frame from a list"))
    docs = spark.createDataFrame(pa.table({"doc_id": range(4), "text": ["a b c d e f g h i j k l", "a b c d e f g h i j k l m", "x y", ""]}))
    kept = jaccard.drop_similar(docs)
    assert [p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()] == ["llm-marks"]
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 3]
    single = exact.drop_copies(docs)
    assert single.count() == 4


def test_exact_copies_read_each_text_once(spark):
    """Beside the directory's, one pass over the texts for their keys."""
    docs = spark.createDataFrame([(1, "a"), (2, "a ")], "doc_id long, text string")
    plan = exact.build_index(docs, docs.columns)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_idle_workers_keep_no_encoders_and_no_words(spark):
    """Python workers outlive their tasks, beside the later stages of their executor."""
    docs = spark.createDataFrame(pa.table({"doc_id": list(range(40)), "text": [f"some words {i} and others <|endoftext|>"[: 20 + i] for i in range(40)]})).repartition(8)
    model = quality.QualityModel(quality.np.ones(quality.PLACES), 1.0, 0.0)
    assert quality.with_scores(docs, model).where("score >= 0").count() == 40
    assert packing.pack(docs, *vocabulary_files()).count() == 40

    def left(batches):
        import gc

        from riskloom.llm import quality

        yield from ()
        for _ in batches:
            kept = sum(type(o).__name__ in ("Encoding", "Tokenizer") and type(o).__module__.split(".")[0] in ("tiktoken", "tokenizers") for o in gc.get_objects())
            yield pa.RecordBatch.from_pydict({"encoders": [kept], "words": [len(quality._words.places)]}, schema=pa.schema([("encoders", pa.int64()), ("words", pa.int64())]))

    rows = spark.range(0, 64, 1, 8).mapInArrow(left, "encoders long, words long").collect()
    assert {(r.encoders, r.words) for r in rows} == {(0, 0)}
