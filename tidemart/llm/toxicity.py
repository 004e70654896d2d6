"""Toxicity by a learned lexicon, matched with misspellings and weighed by context (operator 9).

Terms are learned from labelled documents: words, and beginnings of longer words, that toxic documents use
far more often than others. They form a trie; a Levenshtein automaton runs along it, and the product is one
deterministic automaton that reads a word letter by letter and says which term it is, or almost is. Each hit
is weighed by a window of words around it: a quoted or reported term counts little, terms close together
count more. A logistic regression on the sums gives the score.
"""

from __future__ import annotations

from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import id_and_text, resident, steps, unused, utf8, written
from tidemart.llm.shingles import mix, shingle_sets

#: Labelled documents learned from at most, by the order of a hash of their ids: toxic ones and others.
MAX_TOXIC, MAX_CLEAN = 4000, 8000
#: Terms kept at most, the most telling ones.
MAX_TERMS = 400
#: A term is in this many toxic documents or more; its weight, a cautious estimate of the log odds, is at least this.
MIN_DOCS, MIN_WEIGHT = 4, 0.8
#: A beginning goes if a longer term is in nearly all the toxic documents that it is in.
COVERED = 0.9
#: Sampled documents that agree on one of so many hash minima of their word triples count as copies: one is kept.
COPY_MINIMA = 3
#: Letters of a beginning that stands for all longer words.
STEMS = range(4, 9)
#: Terms of so many letters may be one edit off, but only if words one edit off are rare in clean documents.
FUZZY_LETTERS, FUZZY_CLEAN_SHARE = 5, 0.002
#: Words either side of a hit that are its context.
CONTEXT = 12
#: What a quoted or reported hit, and one that is one edit off, count against a plain one.
QUOTED, MISSPELLED = 0.25, 0.8

#: Quotation marks, and words that report what others said.
QUOTES = "\"“”„«»‘’"
REPORTS = frozenset(
    "said says called wrote quote quoted quoting word term sagte schrieb nannte zitat wort dit écrit cite mot dijo escribió cita palabra".split()
)

#: Letter classes: 0 between words, 1 any letter or digit that no term has, then the terms' own letters.
BETWEEN, OTHER = 0, 1


def _alphanumeric() -> np.ndarray:
    table = np.zeros(0x110000, dtype=np.uint8)
    table[[c for c in range(0x110000) if chr(c).isalnum() or 0x300 <= c < 0x370]] = OTHER
    return table


@dataclass(frozen=True)
class Term:
    """``text`` as a word, or the beginning of a longer word if ``stem``; ``fuzzy`` allows one edit."""

    text: str
    stem: bool
    fuzzy: bool


@dataclass
class Automaton:
    """Reads words by class; ``word[state]`` and ``near[state]`` are the terms a word that ends there is, or is one edit from."""

    terms: list[Term]
    classes: np.ndarray = field(init=False)
    moves: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        letters = sorted({c for t in self.terms for c in t.text})
        self.classes = _alphanumeric()
        for i, c in enumerate(letters):
            self.classes[ord(c)] = i + 2
        number = {c: i + 2 for i, c in enumerate(letters)}
        self._trie([[number[c] for c in t.text] for t in self.terms], len(letters) + 2)

    def _trie(self, spelled: list[list[int]], width: int) -> None:
        children: list[dict[int, int]] = [{}]
        ends: list[int] = [-1]  # the word that ends at a node
        fuzzy: list[bool] = [False]  # whether a fuzzy word is at the node or below
        stems: list[int] = [-1]
        for i, (term, word) in enumerate(zip(self.terms, spelled, strict=True)):
            node = 0
            fuzzy[0] |= term.fuzzy
            for c in word:
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                    ends.append(-1)
                    stems.append(-1)
                    fuzzy.append(False)
                node = children[node][c]
                fuzzy[node] |= term.fuzzy
            if term.stem:
                stems[node] = i
            else:
                ends[node] = i

        def closed(places: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
            """Adds what a left-out letter reaches: a place is a trie node and the edits spent."""
            grown = set(places)
            for node, spent in places:
                if not spent:
                    grown.update((n, 1) for n in children[node].values() if fuzzy[n])
            return frozenset((n, e) for n, e in grown if not (e and (n, 0) in grown))

        def step(places: frozenset[tuple[int, int]], c: int) -> frozenset[tuple[int, int]]:
            after: set[tuple[int, int]] = set()
            for node, spent in places:
                if c in children[node]:
                    after.add((children[node][c], spent))
                if not spent:
                    if fuzzy[node]:
                        after.add((node, 1))  # a letter too many
                    after.update((n, 1) for k, n in children[node].items() if k != c and fuzzy[n])  # another letter
            return closed({(n, e) for n, e in after if not e or fuzzy[n]})

        start = closed({(0, 0)})
        # A state is the places reached and the longest beginning passed; state 0 is dead.
        states: dict[tuple, int] = {(frozenset(), -1): 0, (start, -1): 1}
        queue = deque([(start, -1)])
        moves = [[0] * width, [0] * width]
        while queue:
            places, stem = queue.popleft()
            here = next((stems[n] for n, e in places if not e and stems[n] >= 0), stem)
            for c in range(1, width):
                key = (step(places, c), here)
                if key not in states:
                    states[key] = len(states)
                    moves.append([0] * width)
                    queue.append(key)
                moves[states[places, stem]][c] = states[key]
        for (places, stem), state in states.items():  # a beginning without any other place stays as it is
            if not places and stem >= 0:
                moves[state] = [0] + [state] * (width - 1)
        self.moves = np.array(moves, dtype=np.int32)
        self.exact = np.full(len(states), -1, dtype=np.int32)
        self.near = np.full(len(states), -1, dtype=np.int32)
        for (places, stem), state in states.items():
            self.exact[state] = max((ends[n] for n, e in places if not e), default=-1)
            if self.exact[state] < 0:
                self.exact[state] = stem
            self.near[state] = max((ends[n] for n, e in places if e and ends[n] >= 0 and self.terms[ends[n]].fuzzy), default=-1)

    def match(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """Words as (their text, start, end), and for each the term it is and the one it is an edit from, -1 for none."""
        lowered = [t.lower() for t in texts]
        joined = "\n".join(lowered) + "\n"
        data = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        kinds = self.classes[np.minimum(data, 0x10FFFF)]
        edge = np.diff(np.concatenate([[0], kinds > 0, [0]]).astype(np.int8))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        bounds = np.cumsum([0, *(len(t) + 1 for t in lowered)])
        state = np.ones(len(starts), dtype=np.int32)
        alive, at = np.arange(len(starts)), 0
        while len(alive):
            ongoing = starts[alive] + at < ends[alive]
            alive = alive[ongoing]
            state[alive] = self.moves[state[alive], kinds[starts[alive] + at]]
            at += 1
            now = state[alive]
            # Dead words are done, and so are words that can only keep their beginning.
            alive = alive[(now > 0) & (self.moves[now, OTHER] != now)]
        return bounds, np.searchsorted(bounds, starts, side="right") - 1, starts, ends, self.exact[state], self.near[state], joined


#: Names of the sums over a document's hits that the regression sees.
FEATURES = ("weight", "density", "cluster", "quoted", "words")


def features(automaton: Automaton, weights: np.ndarray, texts: list[str]) -> np.ndarray:
    """One row per text: how much its hits weigh, per word, in their densest context, and how much was quoted."""
    bounds, owner, starts, ends, exact, near, joined = automaton.match(texts)
    n_words = np.bincount(owner, minlength=len(texts)).astype(np.float64)
    term = np.where(exact >= 0, exact, near)
    hits = np.flatnonzero(term >= 0)
    base = weights[term[hits]] * np.where(exact[hits] >= 0, 1.0, MISSPELLED) if len(hits) else np.zeros(0)
    quoted = np.array([_is_quoted(joined, starts, ends, owner, int(h)) for h in hits], dtype=bool)
    value = np.where(quoted, QUOTED * base, base)
    docs = owner[hits]
    total = np.bincount(docs, weights=value, minlength=len(texts))
    in_quotes = np.bincount(docs, weights=base * quoted, minlength=len(texts))
    cluster = np.zeros(len(texts))
    sums = np.concatenate([[0.0], np.cumsum(value)])
    # Hits of one document within a context of the hit, both sides.
    place = hits + owner[hits] * np.int64(4 * CONTEXT)
    low = np.searchsorted(place, place - CONTEXT, side="left")
    high = np.searchsorted(place, place + CONTEXT, side="right")
    np.maximum.at(cluster, docs, sums[high] - sums[low])
    density = 100 * total / np.maximum(n_words, 1)
    return np.log1p(np.stack([total, density, cluster, in_quotes, n_words], axis=1))


def _is_quoted(joined: str, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray, hit: int) -> bool:
    """Whether the hit's context has quotation marks on both sides of it, or a word that reports speech before it."""
    first, last = max(hit - CONTEXT, 0), min(hit + CONTEXT, len(starts) - 1)
    while owner[first] != owner[hit]:
        first += 1
    while owner[last] != owner[hit]:
        last -= 1
    before = joined[max(int(starts[first]) - 1, 0) : int(starts[hit])]
    after = joined[int(ends[hit]) : int(ends[last]) + 1]
    if any(q in before for q in QUOTES) and any(q in after for q in QUOTES):
        return True
    return any(joined[starts[i] : ends[i]] in REPORTS for i in range(max(first, hit - 3), hit))


def fit_regression(x: np.ndarray, y: np.ndarray, ridge: float = 0.3) -> np.ndarray:
    """Weights of a logistic regression with an intercept first, by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    share = np.full(len(x), 1 / max(len(x), 1))
    beta = np.zeros(x.shape[1])
    penalty = ridge / max(len(x), 1) * np.eye(x.shape[1])
    penalty[0, 0] = 0
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (share * (p - y)) + penalty @ beta
        curve = (x * (share * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + penalty
        step = np.linalg.solve(curve + 1e-9 * np.eye(len(beta)), gradient)
        beta = beta - step
        if np.abs(step).max() < 1e-6:
            break
    return beta


@dataclass(frozen=True)
class Model:
    """Terms with their weights, and the regression; without labels of both kinds, no terms and score 0."""

    terms: tuple[Term, ...]
    weights: tuple[float, ...]
    beta: tuple[float, ...]


def _automaton(model: Model) -> Automaton:
    return resident(("terms", model.terms), lambda: Automaton(list(model.terms)))


def score_texts(model: Model, texts: list[str]) -> np.ndarray:
    if not model.beta:
        return np.zeros(len(texts))
    x = features(_automaton(model), np.array(model.weights), texts)
    return 1 / (1 + np.exp(-np.clip(model.beta[0] + x @ np.array(model.beta[1:]), -30, 30)))


def held_out(doc_id):
    """Rows that nothing is learned from: crc32 of the id as text leaves 1 on division by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """(doc_id, text, toxic) of a bounded sample of labelled documents that are not held out.

    A document labelled twice is toxic if any label says so. The sampled ids, MAX_TOXIC + MAX_CLEAN at
    most, are broadcast; the documents are not shuffled.
    """
    own = labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("toxic"))
    own = own.filter("doc_id is not null and toxic is not null").filter(~held_out(F.col("doc_id")))
    own = own.groupBy("doc_id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic"))
    order = F.xxhash64("doc_id")
    some = [own.filter(F.col("toxic") == k).orderBy(order, "doc_id").limit(n) for k, n in ((1, MAX_TOXIC), (0, MAX_CLEAN))]
    return docs.join(F.broadcast(some[0].unionByName(some[1])), "doc_id").select("doc_id", "text", "toxic")


def without_copies(rows: DataFrame) -> DataFrame:
    """One of each group of copies among the sampled rows, so that copies do not make their words look like terms.

    The driver sees COPY_MINIMA numbers for each row of the sample.
    """

    def minima(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        resident("copies")
        salts = mix(np.arange(1, COPY_MINIMA + 1, dtype=np.uint64))
        for batch in steps(batches):
            sets = shingle_sets(utf8(batch), 3)
            least = [[int(mix(s ^ salt).min()) >> 1 if len(s) else 0 for salt in salts] for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(least, pa.list_(pa.int64()))], ["doc_id", "least"])

    seen: set[tuple[int, int]] = set()
    kept = set()
    for row in sorted(rows.mapInArrow(minima, "doc_id long, least array<long>").collect(), key=lambda r: r.doc_id):
        own = set(enumerate(row.least))
        if not own & seen:
            kept.add(row.doc_id)
        seen |= own
    ids = rows.sparkSession.createDataFrame([(i,) for i in sorted(kept)], "doc_id long")
    return rows.join(F.broadcast(ids), "doc_id")


def _term_counts(rows: DataFrame) -> DataFrame:
    """(term, stem, toxic, clean): documents of each kind that have a word, or a longer word with a beginning."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = resident("words alone", lambda: Automaton([Term("a", False, False)]))
        for batch in steps(batches):
            toxic = batch.column("toxic").to_pylist()
            _, owner, starts, ends, _, _, joined = split.match(batch.column("text").to_pylist())
            found = [set() for _ in toxic]
            for o, s, e in zip(owner.tolist(), starts.tolist(), ends.tolist(), strict=True):
                found[o].add(joined[s:e])
            seen = (Counter(), Counter())
            for kind, words in zip(toxic, found, strict=True):
                long = {w[:k] for w in words for k in STEMS if len(w) > k}
                seen[kind].update((w, False) for w in words if 2 < len(w) <= 32)
                seen[kind].update((w, True) for w in long)
            terms = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_pydict(
                {
                    "term": pa.array([t for t, _ in terms], pa.string()),
                    "stem": pa.array([s for _, s in terms], pa.bool_()),
                    "toxic": pa.array([seen[1][t] for t in terms], pa.int64()),
                    "clean": pa.array([seen[0][t] for t in terms], pa.int64()),
                }
            )

    counted = rows.select("text", "toxic").mapInArrow(count, "term string, stem boolean, toxic long, clean long")
    return counted.groupBy("term", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learns a Model from the labelled rows that are not held out; at most a bounded sample of them.

    Terms come from two thirds of the sample without copies, the regression from the other third, whose
    words the terms have not seen.
    """
    spark = docs.sparkSession
    sample = written(spark, training_rows(id_and_text(docs, id_col, text_col), labels, id_col, label_col), "toxic-sample")
    rows = written(spark, without_copies(sample), "toxic-train")
    third = F.pmod(F.xxhash64("doc_id", F.lit("third")), F.lit(3))
    for_terms, for_fit = rows.filter(third > 0), rows.filter(third == 0)
    sizes = {r.toxic: r["count"] for r in for_terms.groupBy("toxic").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return Model((), (), ())
    t, c = F.col("toxic") + 0.5, F.col("clean") + 0.5
    weight = F.log(t / (n_toxic + 1)) - F.log(c / (n_clean + 1)) - F.sqrt(1 / t + 1 / c)
    counts = _term_counts(for_terms).filter(F.col("toxic") >= MIN_DOCS).withColumn("weight", weight)
    telling = F.col("toxic") * F.col("weight")
    best = counts.filter(F.col("weight") >= MIN_WEIGHT).orderBy(telling.desc(), "term", "stem").limit(4 * MAX_TERMS).collect()
    best = [r for r in best if not r.stem or not any(_covers(x, r) for x in best)][:MAX_TERMS]
    weights = tuple(float(r.weight) for r in best)
    able = [not r.stem and len(r.term) >= FUZZY_LETTERS for r in best]
    clean = for_terms.filter("toxic = 0")
    rare = _rarely_misspelled([Term(r.term, r.stem, a) for r, a in zip(best, able, strict=True)], clean, n_clean)
    terms = tuple(Term(r.term, r.stem, a and i in rare) for i, (r, a) in enumerate(zip(best, able, strict=True)))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(list(terms))
        for batch in steps(batches):
            x = features(automaton, np.array(weights), batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), *(pa.array(f) for f in x.T)], ["toxic", *FEATURES])

    schema = "toxic int, " + ", ".join(f"{f} double" for f in FEATURES)
    measured = for_fit.mapInArrow(measure, schema).toPandas()
    beta = fit_regression(measured[list(FEATURES)].to_numpy(), measured["toxic"].to_numpy(dtype=np.float64))
    return Model(terms, weights, tuple(beta.tolist()))


def _covers(longer, beginning) -> bool:
    """Whether a longer term is in nearly all the toxic documents that a beginning is in."""
    if not longer.term.startswith(beginning.term) or len(longer.term) + longer.stem <= len(beginning.term) + 1:
        return False
    return longer.toxic >= COVERED * beginning.toxic


def _rarely_misspelled(terms: list[Term], clean: DataFrame, n_clean: int) -> set[int]:
    """Terms that few clean documents have a word one edit from."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(terms)
        for batch in steps(batches):
            _, owner, _, _, exact, almost, _ = automaton.match(batch.column("text").to_pylist())
            hit = np.flatnonzero((almost >= 0) & (exact < 0))
            pairs = np.unique(np.stack([owner[hit], almost[hit]], axis=1), axis=0)
            yield pa.RecordBatch.from_pydict({"term": pa.array(pairs[:, 1].astype(np.int32))})

    counts = {r.term: r["count"] for r in clean.select("text").mapInArrow(near, "term int").groupBy("term").count().collect()}
    return {i for i in range(len(terms)) if counts.get(i, 0) <= FUZZY_CLEAN_SHARE * n_clean}


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 if the score is ``threshold`` or more).

    No row meets another. A null or empty text has no hits and gets the score of that; equal rows get equal
    scores; a row without an id is not held out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            score = score_texts(shared.value, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    scored = id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows whose score is below ``threshold``, with all their columns, in one pass without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    flag, text = unused(docs, "is_clean"), text_col

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, flag):
            texts = batch.column(flag).to_pylist()
            yield batch.filter(pa.array(score_texts(shared.value, texts) < threshold)).drop_columns([flag])

    with_text = docs.withColumn(flag, F.coalesce(F.col(f"`{text}`"), F.lit("")))
    return with_text.mapInArrow(run, docs.schema)
