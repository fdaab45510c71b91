"""Toxicity by weak supervision.

Many weak voters look at a document: words of a lexicon, patterns, and words or word beginnings mined from a bounded sample
of labelled documents outside fold 0. A generative label model estimates by EM how often each voter fires on either class
(the label itself is one more voter of estimated accuracy), and from the residuals how voters correlate; a voter's evidence
is divided by the correlated votes around it. Its posteriors are the labels of a linear classifier over the same kind of
features, which scores every whole text.

Bounds: SAMPLE labelled documents with the smallest hashes, FEATURES features, VOTERS mined voters; each is constant.
Without a labelled document of either class the label model works on the lexicon and patterns with default accuracies.

Defined cases: null and empty texts have no features and get the score of the bias; a document with several labels
counts as toxic if one says so; null labels are left out; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import forget, held_out, in_chunks, release, shape, table
from tidemark.session import materialize

SAMPLE = 8_000
FEATURES = 4_096
VOTERS = 256
#: Share of toxic documents among those with a mined voter, and such documents.
MINED_PRECISION, MINED_DOCUMENTS = 0.7, 3
#: Words whose weights a task keeps; features that a task counts before it passes the counts on.
CACHED, COUNTED = 60_000, 100_000
#: Lexicon voters.
LEXICON = (
    "idiot idiots moron morons imbecile fool fools stupid dumb clown loser losers jerk dimwit halfwit coward liar scum vermin "
    "filth trash garbage worthless pathetic disgusting despicable repulsive vile hate hateful hater bastard bitch asshole "
    "bullshit crap damn fuck fucking shit slut whore retard retarded freak parasite subhuman "
    "dummkopf abschaum drecksack arschloch idioten connard salaud ordure imbecile estupido imbecil basura cabron").split()
#: Pattern voters.
PATTERNS = tuple(re.compile(p, re.I) for p in (
    r"\b(?:you|u|you're|youre)\b[^.!?\n]{0,20}\b(?:idiot|moron|stupid|dumb|loser|clown|pathetic|worthless|disgusting)",
    r"\bshut (?:the \w+ )?up\b|\bgo to hell\b|\bkill yourself\b|\bget lost\b",
    r"[!?]{3,}",
    r"\b\w{1,3}[*#@$]{2,}\w{0,4}\b",
))
LETTERS = re.compile(r"[^\W\d_]+")
#: Log evidence of a voter that nothing was learned about.
DEFAULT_FIRE = (0.3, 0.01)
DEFAULT_PRIOR = 0.1


def words(text: str | None) -> set[str]:
    return set(LETTERS.findall(text.lower())) if text else set()


def features(word: str) -> tuple[str, ...]:
    """A word and its beginnings."""
    return (word, *(f"{word[:n]}~" for n in (4, 5) if len(word) > n))


def patterns(text: str | None) -> list[bool]:
    return [bool(p.search(text)) for p in PATTERNS] if text else [False] * len(PATTERNS)


@dataclass
class Model:
    weight: dict[str, float]
    pattern: list[float]
    bias: float

    def scorer(self):
        """A function from a text to its score; keeps what words add up to."""
        weight, cache = self.weight, {}
        shared = {f for f in weight if f.endswith("~")}

        def score(text: str | None) -> float:
            seen: set[str] = set()
            z = self.bias
            if text:
                for w in words(text):
                    known = cache.get(w)
                    if known is None:
                        own = [f for f in features(w) if f in weight]
                        known = (sum(weight[f] for f in own if f not in shared), tuple(f for f in own if f in shared))
                        if len(cache) >= CACHED:
                            cache.clear()
                        cache[w] = known
                    z += known[0]
                    if known[1]:
                        seen.update(known[1])
                z += sum(weight[f] for f in sorted(seen)) + sum(w for w, hit in zip(self.pattern, patterns(text)) if hit)
            return float(1.0 / (1.0 + np.exp(-min(50.0, max(-50.0, z)))))

        return score


def label_model(fires: np.ndarray, gold: np.ndarray, rounds: int = 8) -> np.ndarray:
    """Posterior of the toxic class from votes (documents by voters) and labels."""
    n, m = fires.shape
    x = fires.astype(np.float64)
    q = gold.astype(np.float64)
    for _ in range(rounds):
        toxic = q.sum()
        # The second factor keeps a voter that fires on nothing of a class from deciding alone.
        fire1 = (q @ x + 0.5) / (toxic + 1.0)
        fire0 = ((1 - q) @ x + 0.5) / (n - toxic + 1.0)
        if_fires = np.log(fire1 / fire0)
        if_not = np.log((1 - fire1) / (1 - fire0))
        # Correlation that is left within the classes.
        rest = x - np.outer(q, fire1) - np.outer(1 - q, fire0)
        spread = np.sqrt((rest ** 2).mean(axis=0)) + 1e-9
        near = np.abs((rest.T @ rest) / n / np.outer(spread, spread))
        np.fill_diagonal(near, 0.0)
        near[near < 0.1] = 0.0
        part = 1.0 / (1.0 + near.sum(axis=1))
        right1 = (q @ gold + 1.0) / (toxic + 2.0)
        right0 = ((1 - q) @ (1 - gold) + 1.0) / (n - toxic + 2.0)
        own = np.where(gold == 1, np.log(right1 / (1 - right0)), np.log((1 - right1) / right0))
        prior = np.log((toxic + 1.0) / (n - toxic + 1.0))
        z = prior + x @ (part * if_fires) + (1 - x) @ (part * if_not) + own
        q = 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))
    return q


def classifier(rows: list[np.ndarray], q: np.ndarray, width: int, rounds: int = 250, ridge: float = 2e-4) -> np.ndarray:
    """Weights and, last, the bias of a logistic regression on soft labels, over documents as lists of feature numbers."""
    sizes = np.array([len(r) for r in rows])
    cols = np.concatenate(rows) if len(rows) else np.zeros(0, dtype=np.int64)
    docs = np.repeat(np.arange(len(rows)), sizes)
    w = np.zeros(width + 1)
    w[-1] = np.log((q.sum() + 1) / (len(q) - q.sum() + 1))
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        z = np.bincount(docs, weights=w[cols], minlength=len(rows)) + w[-1]
        error = 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))) - q
        grad = np.append(np.bincount(cols, weights=error[docs], minlength=width)[:width] / len(rows) + ridge * w[:-1], error.mean())
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad ** 2
        w -= 0.05 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return w


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fits on the bounded sample of labelled documents outside fold 0."""
    chosen = (
        labels.where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("_toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).withColumnRenamed("doc_id", "_id"))
    # `sample` rows of two numbers: the bound of the broadcast.
    rows = docs.select("doc_id", docs["text"].alias("_text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_chunks(batches, "_text"):
            texts = batch.column("_text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id").cast(pa.int64()), batch.column("_toxic"), pa.array([sorted(words(t)) for t in texts], pa.list_(pa.string())),
                 pa.array([patterns(t) for t in texts], pa.list_(pa.bool_()))], ["id", "toxic", "words", "patterns"])

    taken = materialize(rows.select("_id", "_toxic", "_text").mapInArrow(
        take, "id long, toxic int, words array<string>, patterns array<boolean>"), "toxic-sample")
    n, toxic = taken.agg(F.count("*"), F.sum("toxic")).first()
    toxic = toxic or 0
    if not toxic or toxic == n:
        gain = float(np.log(DEFAULT_FIRE[0] / DEFAULT_FIRE[1]))
        return Model(dict.fromkeys(LEXICON, gain), [gain, gain, 0.0, gain], float(np.log(DEFAULT_PRIOR / (1 - DEFAULT_PRIOR))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        hit: Counter = Counter()

        def out() -> pa.RecordBatch:
            names = list(seen)
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([seen[f] for f in names], pa.int64()), pa.array([hit[f] for f in names], pa.int64())],
                ["f", "n", "t"])

        forget()
        for part in (batch.slice(a, 256) for batch in batches for a in range(0, len(batch), 256)):
            for t, own in zip(part.column("toxic").to_pylist(), part.column("words").to_pylist()):
                all_of = {f for w in own for f in features(w)}
                seen.update(all_of)
                if t:
                    hit.update(all_of)
            if len(seen) >= COUNTED:
                yield out()
                seen.clear()
                hit.clear()
        yield out()

    stats = taken.select("toxic", "words").mapInArrow(count, "f string, n long, t long").groupBy("f").agg(
        F.sum("n").alias("n"), F.sum("t").alias("t")).where("n >= 3")
    clean = F.col("n") - F.col("t")
    odds = F.log((F.col("t") + 0.5) * (n - toxic + 1.0) / ((clean + 0.5) * (toxic + 1.0)))
    best = stats.withColumn("z", odds / F.sqrt(1 / (F.col("t") + 0.5) + 1 / (clean + 0.5))).orderBy(
        F.abs("z").desc(), "f").limit(FEATURES).collect()
    names = list(dict.fromkeys([*LEXICON, *(r["f"] for r in best)]))
    number = {f: i for i, f in enumerate(names)}
    mined = [r["f"] for r in sorted(best, key=lambda r: (-r["z"], r["f"]))
             if r["z"] > 0 and r["t"] >= MINED_DOCUMENTS and r["t"] >= MINED_PRECISION * r["n"]][:VOTERS]

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [sorted({number[f] for w in ws for f in features(w) if f in number}) for ws in batch.column("words").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("toxic"), pa.array(own, pa.list_(pa.int32())), batch.column("patterns")],
                ["id", "toxic", "own", "patterns"])

    got = taken.mapInArrow(vectors, "id long, toxic int, own array<int>, patterns array<boolean>").toPandas()
    got = got.assign(size=got["own"].map(len)).sort_values(["id", "size"], kind="stable")
    gold = got["toxic"].to_numpy()
    pats = np.array(got["patterns"].tolist(), dtype=bool).reshape(len(got), len(PATTERNS))
    voters = list(dict.fromkeys([*LEXICON, *mined]))
    place = np.full(len(names), -1)
    place[[number[v] for v in voters]] = np.arange(len(voters))
    fires = np.zeros((len(got), len(voters) + len(PATTERNS) + 1), dtype=bool)
    for i, own in enumerate(got["own"]):
        at = place[np.asarray(own, dtype=np.int64)]
        fires[i, at[at >= 0]] = True
    fires[:, len(voters):-1] = pats
    fires[:, -1] = ~fires[:, :-1].any(axis=1)  # the voter for clean texts
    q = label_model(fires, gold)
    base = len(names)
    rows = [np.concatenate([np.asarray(own, dtype=np.int64), base + np.flatnonzero(p)]) for own, p in zip(got["own"], pats)]
    w = classifier(rows, q, base + len(PATTERNS))
    return Model({f: float(w[i]) for f, i in number.items() if w[i]}, w[base:base + len(PATTERNS)].tolist(), float(w[-1]))


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns of every row of docs with held_out, score and predicted."""
    data = docs.select(*keep, docs["text"].alias("_text"), held_out(docs["doc_id"]).alias("_held"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        own = model.scorer()
        try:
            for batch in in_chunks(batches, "_text"):
                scores = np.array([own(t) for t in batch.column("_text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in keep), batch.column("_held"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                    [*keep, "held_out", "score", "predicted"])
        finally:
            del own  # with the words it kept
            release()

    return data.mapInArrow(run, shape(data.schema.fields[:-2], "held_out boolean, score double, predicted int"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, learn(docs, table(spark, sf_dir, "labels")))
