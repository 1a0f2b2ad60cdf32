"""Mixing to target weights when documents belong to domains in part.

A classifier fitted on a table of labelled documents gives every document a probability for each domain: the
features are its distinct words, and the signs between them. All whose presence tells a domain from the rest beyond chance
enter a naive Bayes model of what is present; chance is judged by a bound on the binomial tail, which also holds for rare features
and small domains. Its base scores are set so that the labelled documents' expected numbers by
domain are the real ones. Absence is not counted: a text without most of many rare words tells nothing. The features form a table, which the
features of every document are joined to; what they add is summed within the document's task. Texts are split once to fit
and once to score, where the same pass counts their tokens; rates come back to the rows by a join that Spark plans by size. With n tokens and posteriors p, a
document taken at rate r adds r n p[k] expected tokens to domain k. Rates within bounds are found by
projected gradient steps on the squared gaps between expected and wanted tokens of the domains, each gap
measured against the domain's present tokens; with that measure a step of one never overshoots. Each step
needs one sum over the documents: only the domains' totals reach the driver, and a rate is a function of the
document's posteriors and the steps so far, so nothing is kept for it.

Defined results: a null text counts as empty, has no tokens and no features; labels of documents that are not there are left out, an id with several
labels takes the smallest name; a domain without documents keeps a gap nobody can close; an empty table gives
an empty result. Added columns replace input columns of the same name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import SPACES, staged, text_of
from riskloom.llm.quality import BROADCAST_ROWS

#: Standard errors, at least, by which a feature must tell a domain from the rest, or evidence as strong where counts are small.
CHANCE = 4.0
#: How many times as frequent it must be there.
RATIO = 4.0
#: Documents with the domains' usual shares that are counted with a feature's own, so that rare features weigh little.
SMOOTH = 40.0
#: Corrections of the domains' base scores, at most, and the one that ends them.
ROUNDS, CLOSE = 20, 0.01
STEPS = 40
NAMES = ("n_tokens", "posteriors", "rate")
#: Fixed value: what separates words.
GAP = "[\\x20\\x09-\\x0D]+"


def words_of(text: Column) -> Column:
    """The words of a text in lower case; an empty one alone where there are none."""
    return F.split(F.lower(F.btrim(text, F.lit(SPACES.decode()))), GAP)


def signs_of(text: Column) -> Column:
    """What stands between small letters, digits and white space; a run of capitals is one sign."""
    signs = F.array_distinct(F.regexp_extract_all(text, F.lit("[^\\p{Ll}\\p{N}\\s]+"), F.lit(0)))
    return F.transform(signs, lambda s: F.regexp_replace(s, "\\p{Lu}+", "A"))


def _bound(value: Column, use) -> Column:
    """`use` of a value that is worked out once for a row; an array of one element binds it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _read(rows: DataFrame, *keys: str) -> DataFrame:
    """Each text split once: beside the keys its number of words, and its distinct words and signs (met)."""
    words = rows.select(*keys, words_of(F.col("text")).alias("words"), signs_of(F.col("text")).alias("signs"))
    met = [F.struct(F.lit(k).alias("kind"), F.array_distinct(f"{k}s").alias("features")) for k in ("word", "sign")]
    return words.select(*keys, (F.size("words") - (F.element_at("words", 1) == "").cast("int")).cast("long").alias("n"), F.array(*met).alias("met"))


def _features(read: DataFrame, *keys: str) -> DataFrame:
    """A row for each feature that was met, beside the keys.

    Only an outer explode is planned without a test of its array's size, which would split every text again.
    """
    return read.select(*keys, F.explode_outer("met").alias("m")).select(*keys, "m.kind", F.explode_outer("m.features").alias("feature")).where("feature <> ''")


def _small(table: DataFrame) -> DataFrame:
    """The table, sent to every executor unless it is large, so that the other side stays where it is."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def _evidence(here: Column, whole: Column, share: float) -> Column:
    """Minus the log of a bound (Chernoff's) on the chance that so many of a feature's documents fall to a domain with this share of all."""
    part = lambda n, q: F.coalesce(n * (F.log(n / whole) - F.lit(math.log(q))), F.lit(0.0)) if q > 0 else F.lit(0.0)
    return part(here, share) + part(whole - here, 1 - share)


@dataclass
class DomainClassifier:
    """By domain its score for a text without features, and the table of what each feature adds (w0, w1 ...)."""

    domains: list[str]
    base: list[float]
    weights: DataFrame | None

    def sums(self, read: DataFrame) -> DataFrame:
        """For every row of what was read: row, n, and what its features add by domain."""
        own = read.withColumn("met", F.array_append("met", F.struct(F.lit("none").alias("kind"), F.array(F.lit("none")).alias("features"))))
        one = self.weights.sparkSession.range(1)
        nothing = one.select(F.lit("none").alias("kind"), F.lit("none").alias("feature"), *[F.lit(0.0).alias(f"w{i}") for i in range(len(self.domains))])
        sums = [F.sum(f"w{i}").alias(f"w{i}") for i in range(len(self.domains))]
        return _features(own, "row", "n").join(_small(self.weights.unionByName(nothing)), ["kind", "feature"]).groupBy("row", "n").agg(*sums)

    def posteriors(self) -> Column:
        """An array of probabilities by domain, from sums."""
        return self.odds([F.lit(float(b)) + F.col(f"w{i}") for i, b in enumerate(self.base)])

    @staticmethod
    def odds(scores: list[Column]) -> Column:
        odds = _bound(F.array(*scores), lambda s: F.transform(s, lambda x: F.exp(x - F.array_max(s))))
        return _bound(odds, lambda o: F.transform(o, lambda x: x / F.aggregate(o, F.lit(0.0), lambda a, b: a + b)))


def fit_domains(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", domain_col: str = "domain") -> DomainClassifier:
    """The classifier of the labelled table; every labelled document counts."""
    marks = labelled.where(F.col(f"`{domain_col}`").isNotNull()).groupBy(F.col(f"`{id_col}`").alias("id")).agg(F.min(F.col(f"`{domain_col}`").cast("string")).alias("domain"))
    marks = _small(staged(marks, "marks"))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text")).join(marks, "id")
    sizes = {r.domain: r.n for r in rows.groupBy("domain").agg(F.count("*").alias("n")).collect()}  # a row for each domain
    domains = sorted(sizes)
    if not domains:
        return DomainClassifier([], [], None)
    total = sum(sizes.values())
    read = staged(_read(rows, "domain").withColumn("row", F.monotonically_increasing_id()), "read")
    counts = _features(read, "domain").groupBy("kind", "feature").agg(*[F.count(F.when(F.col("domain") == d, 1)).alias(f"n{i}") for i, d in enumerate(domains)])
    whole, tells = sum((F.col(f"n{i}") for i in range(len(domains))), F.lit(0)), []
    for i, d in enumerate(domains):
        here, rest = F.col(f"n{i}") / F.lit(float(sizes[d])), (whole - F.col(f"n{i}")) / F.lit(max(1.0, float(total - sizes[d])))
        tells.append(F.when(here >= RATIO * rest, _evidence(F.col(f"n{i}"), whole, sizes[d] / total)))
    adds = [F.log((F.col(f"n{i}") + F.lit(SMOOTH * sizes[d] / total)) / F.lit(sizes[d] + SMOOTH)).alias(f"w{i}") for i, d in enumerate(domains)]
    weights = staged(counts.where(F.array_max(F.array(*tells)) >= CHANCE**2 / 2).select("kind", "feature", *adds), "features")
    classifier = DomainClassifier(domains, [math.log(sizes[d] / total) for d in domains], weights)
    sums = staged(classifier.sums(read).drop("row", "n"), "sums")
    for _ in range(ROUNDS):
        p = classifier.posteriors()
        met = sums.agg(*[F.coalesce(F.sum(F.element_at(p, i + 1)), F.lit(0.0)) for i in range(len(domains))]).first()
        shift = [math.log(sizes[d] / m) for d, m in zip(domains, met, strict=True)]
        classifier.base = [b + x for b, x in zip(classifier.base, shift, strict=True)]
        if max(map(abs, shift)) < CLOSE:
            break
    return classifier


def _moved(rate: Column, p: list[Column], steps: list[list[float]], least: float, most: float) -> Column:
    for g in steps:
        slope = sum((c * F.lit(float(x)) for c, x in zip(p, g, strict=True)), F.lit(0.0))
        rate = F.greatest(F.lit(least), F.least(F.lit(most), rate - slope))
    return rate


def fit_rates(
    docs: DataFrame, classifier: DomainClassifier, weights: dict[str, float], text_col: str = "text", total: float | None = None, least: float = 0.0, most: float = 4.0, tolerance: float = 1e-3, steps: int = STEPS, anchor: str | None = None, names: tuple[str, str, str] = NAMES
) -> DataFrame:
    """The rows with their tokens, posteriors and rate, in columns of the given names.

    The weights are the wanted shares of the domains in `total` expected tokens: by default as many as now,
    or, with `anchor`, as many as leave that domain its present tokens.
    """
    k = len(classifier.domains)
    outer = [c for c in docs.columns if c not in names]
    inner = [f"c{i}" for i in range(len(outer))]  # names that cannot clash with ours
    text = text_of(inner[outer.index(text_col)])
    texts = docs.select(*[F.col(f"`{c}`").alias(i) for c, i in zip(outer, inner, strict=True)])
    texts = staged(texts.withColumn("row", F.monotonically_increasing_id()), "texts")
    if k:
        scored = classifier.sums(_read(texts.select("row", text.alias("text")), "row")).select("row", "n", classifier.posteriors().alias("p"))
    else:
        scored = _read(texts.select("row", text.alias("text")), "row").select("row", "n", F.array().cast("array<double>").alias("p"))
    scored = staged(scored, "mixing")
    rows = scored.select(F.col("n").alias(names[0]), F.col("p").alias(names[1]))
    p = [F.element_at(F.col(names[1]), i + 1) for i in range(k)]

    def totals(rate: Column) -> list[float]:
        r = rows.agg(*[F.coalesce(F.sum(rate * F.col(names[0]) * c), F.lit(0.0)).alias(f"t{i}") for i, c in enumerate(p)]).first()
        return list(r)

    # the first rate is the same for all, so that the first step starts within the bounds
    start = min(max(1.0, least), most)
    moves: list[list[float]] = []
    if k:
        now = totals(F.lit(1.0))
        wanted = [weights.get(d, 0.0) for d in classifier.domains]
        scale = now[classifier.domains.index(anchor)] / weights[anchor] if anchor in classifier.domains else (sum(now) if total is None else total) / max(sum(wanted), 1e-12)
        target = [w * scale for w in wanted]
        have, last = [t * start for t in now], math.inf
        for _ in range(steps):
            gaps = [(h - t) / n if n > 0 else 0.0 for h, t, n in zip(have, target, now, strict=True)]
            size = sum(g * g * n for g, n in zip(gaps, now, strict=True))
            if max(map(abs, gaps)) <= tolerance or size > last * (1 - 1e-6):
                break
            moves.append(gaps)
            last = size
            have = totals(_moved(F.lit(start), p, moves, least, most))
    rated = scored.select("row", F.col("n").alias(names[0]), F.col("p").alias(names[1])).withColumn(names[2], _moved(F.lit(start), p, moves, least, most))
    return texts.join(rated, "row").select(*[F.col(i).alias(c) for i, c in zip(inner, outer, strict=True)], *names)


def drawn(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", names: tuple[str, str, str] = NAMES) -> DataFrame:
    """Each row as often as its rate says: the whole part, and once more by a coin from a hash of the row."""
    coin = (F.xxhash64(F.col(f"`{id_col}`"), text_of(text_col)).bitwiseAND(F.lit((1 << 52) - 1))) / F.lit(float(1 << 52))
    copies = F.floor(F.col(names[2]) + coin).cast("int")
    many = rows.withColumn("__copy", F.explode(F.when(copies > 0, F.sequence(F.lit(1), F.greatest(copies, F.lit(1)))).otherwise(F.array().cast("array<int>"))))
    return many.drop("__copy", *names)
