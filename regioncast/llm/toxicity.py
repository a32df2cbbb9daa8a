"""Toxicity by a lexicon, misspellings and context.

Lexicon.  Whole words and word stems are learned from labelled training rows: terms whose share of toxic texts is a multiple of that of clean
ones (smoothed, less its own uncertainty; a text that only quotes a term counts as `QUOTED` of one), or that no clean text holds.  They are chosen
greedily so that each explains toxic texts that the earlier ones don't (words that merely share a text with a toxic term are so left out).
A term that clean texts hold too weighs less, the less so the rarer it is in them.  A short list of plain insults is offered as well; one stays
unless the training rows speak against it.

Matching.  The lexicon is a trie.  Levenshtein automata of its terms run over it together: a state is a set of (trie node, edits),
and states are made as they are first reached, so a word costs one table step a character and dies early.  Two neighbouring letters in the
other order are one edit: the state then also holds the node beyond both, with the letter it waits for.  Words that clean training texts hold
are never taken for misspellings.

Context.  Each hit looks at the words around it.  Inside quotation marks, or after a word that reports speech, it counts as quotation, with a small
weight.  The evidence of a text is the sum of its hits' weights, and a logistic curve fitted on training rows turns it into a score.

Learning reads a bounded sample: the labelled training rows that are first by a hash of their id, at most `TRAIN_TOXIC` and `TRAIN_CLEAN`.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regioncast.llm.common import crc_of_id, narrowed, slices, small_batches, stored, whole_row

TRAIN_TOXIC, TRAIN_CLEAN = 8_000, 16_000
#: Insults that are offered to the lexicon beside the learned terms.
SEEDS = ("idiot", "stupid", "moron", "loser", "pathetic", "scum", "worthless", "clown", "trash", "disgusting", "dumb", "imbecile")
#: Words before a hit that report speech.
REPORTING = frozenset("said says say called calls quote quoted quotes word term cited citing sagte nannte zitat dit appelle citation dijo llama cita".split())
QUOTES = "\"“”„«»‹›"
#: Words before a hit that are looked at.
CONTEXT = 6
#: Weights of a hit: plain, quoted or reported, and of each edit against an exact one.
PLAIN, QUOTED, MISSPELLED = 1.0, 0.25, 0.7
#: Lengths of stems; toxic texts that a term, and different words that a stem, must have.
STEM_LENGTHS, STEM_WORDS = range(4, 9), 3
#: A term's rate in toxic texts over that in clean ones: the least, after so many standard deviations are taken off, and that of full weight.
RATIO, DEVIATIONS, FULL_RATIO = 4.0, 2.0, 50.0
#: Words whose verdict a worker keeps.
CACHE = 200_000

_WORD = re.compile(r"\w+")


def allowed_edits(term: str, stem: bool) -> int:
    """Edits that still count as the term: none in short terms and stems, one from five (stems: seven) letters, two from eight (stems: never)."""
    if stem:
        return 1 if len(term) >= 7 else 0
    return 2 if len(term) >= 8 else 1 if len(term) >= 5 else 0


class LexiconAutomaton:
    """Trie of terms run together with their Levenshtein automata, made deterministic as states are reached."""

    def __init__(self, words: list[str], stems: list[str], weights: dict[str, float] | None = None):
        self.children: list[dict[str, int]] = [{}]
        self.words: list[int] = [-1]  # edits that the whole word ending in a node allows
        self.stems: list[int] = [-1]
        self.budget: list[int] = [0]  # most edits that any term through a node allows
        self.word_weight, self.stem_weight = {}, {}  # of the term ending in a node
        for term, stem in [(w, False) for w in words] + [(s, True) for s in stems]:
            node, edits = 0, allowed_edits(term, stem)
            self.budget[0] = max(self.budget[0], edits)
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    for row, value in ((self.children, {}), (self.words, -1), (self.stems, -1), (self.budget, 0)):
                        row.append(value)
                node = self.children[node][c]
                self.budget[node] = max(self.budget[node], edits)
            ends = self.stems if stem else self.words
            ends[node] = max(ends[node], edits)
            (self.stem_weight if stem else self.word_weight)[node] = (weights or {}).get("^" + term if stem else term, 1.0)
        self.states: dict[tuple[frozenset, frozenset], int] = {}
        self.sets: list[dict[int, int]] = []
        self.swaps: list[dict[tuple[int, str], int]] = []  # least edits by node and the letter waited for
        self.steps: list[dict[str, int]] = []
        self.start = self._state({0: 0}, {})
        self.verdicts: dict[str, tuple[int, float]] = {}

    def _state(self, reached: dict[int, int], swaps: dict[tuple[int, str], int]) -> int:
        """Number of the state with these nodes (least edits each), after skipping letters of the terms, and half-read swaps."""
        todo = list(reached)
        while todo:
            node = todo.pop()
            edits = reached[node] + 1
            for child in self.children[node].values():
                if edits <= self.budget[child] and edits < reached.get(child, 99):
                    reached[child] = edits
                    todo.append(child)
        key = frozenset(reached.items()), frozenset(swaps.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(reached)
            self.swaps.append(swaps)
            self.steps.append({})
        return self.states[key]

    def _step(self, state: int, c: str) -> int:
        out: dict[int, int] = {}
        swaps: dict[tuple[int, str], int] = {}

        def reach(node, edits):
            if edits <= self.budget[node] and edits < out.get(node, 99):
                out[node] = edits

        for node, edits in self.sets[state].items():
            reach(node, edits + 1)  # c was inserted
            for letter, child in self.children[node].items():
                reach(child, edits + (letter != c))
                beyond = self.children[child].get(c)
                if beyond is not None and letter != c and edits < self.budget[beyond]:
                    swaps[beyond, letter] = min(edits + 1, swaps.get((beyond, letter), 99))
        for (node, letter), edits in self.swaps[state].items():
            if letter == c:
                reach(node, edits)
        got = self._state(out, swaps)
        self.steps[state][c] = got
        return got

    def match(self, word: str) -> tuple[int, float]:
        """Fewest edits from a term or a stem's beginning to the word, and the largest weight of such a term; (-1, 0) if none is near enough."""
        state, best = self.start, (99, 0.0)
        for c in word:
            nxt = self.steps[state].get(c)
            state = self._step(state, c) if nxt is None else nxt
            reached = self.sets[state]
            if not reached and not self.swaps[state]:
                break
            for node, e in reached.items():
                if e <= self.stems[node]:
                    best = min(best, (e, -self.stem_weight[node]))
        else:
            for node, e in self.sets[state].items():
                if e <= self.words[node]:
                    best = min(best, (e, -self.word_weight[node]))
        return (-1, 0.0) if best[0] == 99 else (best[0], -best[1])

    def edits(self, word: str) -> int:
        return self.match(word)[0]

    def verdict(self, word: str) -> tuple[int, float]:
        got = self.verdicts.get(word)
        if got is None:
            if len(self.verdicts) >= CACHE:
                self.verdicts.clear()
            got = self.verdicts[word] = self.match(word)
        return got


@dataclass
class ToxicityModel:
    words: list[str]
    stems: list[str]
    blocked: frozenset = frozenset()
    slope: float = 8.0
    offset: float = -3.0
    weights: dict[str, float] = field(default_factory=dict)  # of terms, stems with a ^ before them; 1 if not named
    automaton: LexiconAutomaton | None = field(default=None, compare=False)

    def _ready(self) -> LexiconAutomaton:
        if self.automaton is None:
            self.automaton = LexiconAutomaton(self.words, self.stems, self.weights)
        return self.automaton

    def hits(self, text: str) -> list[tuple[int, int, int, float]]:
        """(start, end, edits, the term's weight) of each hit in a lower-case text."""
        automaton = self._ready()
        verdict, near = automaton.verdicts.get, {}
        for w in set(_WORD.findall(text)):
            got = verdict(w)
            e, weight = automaton.verdict(w) if got is None else got
            if e >= 0 and not (e and w in self.blocked):
                near[w] = e, weight
        if not near:
            return []
        return [(m.start(), m.end(), *near[m[0]]) for m in _WORD.finditer(text) if m[0] in near]

    def evidence(self, text: str | None) -> float:
        """Sum of the hits' weights."""
        text = (text or "").lower()
        total = 0.0
        for start, end, edits, weight in self.hits(text):
            weight *= QUOTED if is_quoted(text, start, end) else PLAIN
            total += weight * MISSPELLED**edits
        return total

    def score(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * math.log1p(evidence) + self.offset))))


def is_quoted(text: str, start: int, end: int) -> bool:
    """Whether the hit stands between quotation marks of its line's neighbourhood, or after a reporting word."""
    before = text[max(0, start - 12 * CONTEXT):start].rsplit("\n", 1)[-1]
    after = text[end:end + 12 * CONTEXT].split("\n", 1)[0]
    if sum(before.count(q) for q in QUOTES) % 2 and any(q in after for q in QUOTES):
        return True
    return any(w in REPORTING for w in _WORD.findall(before)[-CONTEXT:])


def choose_terms(pairs: list[tuple[int, str]], least: int, weights: dict[str, float] | None = None) -> list[str]:
    """Greedy cover: terms in order of the toxic texts that they alone explain, times their weight, while these texts are ``least`` or more.

    Each term explains ``least`` texts of its own, so there are at most texts / ``least`` of them.
    """
    weights = weights or {}
    by_term: dict[str, set[int]] = {}
    for doc, term in pairs:
        by_term.setdefault(term, set()).add(doc)
    chosen: list[str] = []
    covered: set[int] = set()
    # Of terms with the same texts the longest: a stem should not be cut shorter than it is.
    order = sorted(by_term, key=lambda t: (-len(by_term[t]), -len(t), t))
    while order:
        best, gain = None, 0.0
        for t in order:
            if len(by_term[t]) <= gain or len(by_term[t]) < least:
                break
            new = len(by_term[t] - covered)
            if new >= least and new * weights.get(t, 1.0) > gain:
                best, gain = t, new * weights.get(t, 1.0)
        if best is None:
            break
        chosen.append(best)
        covered |= by_term[best]
        order.remove(best)
    return chosen


def _sample(docs: DataFrame, labels: DataFrame, folds: int, held_fold: int) -> DataFrame:
    """(text_id, toxic, text): the bounded training sample, a row for each different text."""
    open_ = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        F.col("toxic").isin(0, 1) & (F.pmod(crc_of_id(F.col("doc_id")), F.lit(folds)) != held_fold))
    own = docs.where("doc_id is not null").select("doc_id", "text")
    part = lambda toxic, n: open_.where(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    ids = stored(part(1, TRAIN_TOXIC).union(part(0, TRAIN_CLEAN)), "ids")
    # At most TRAIN_TOXIC + TRAIN_CLEAN ids: small enough for every worker, whatever the corpus.  An id may have many rows, so as
    # many different texts are taken of all of them.
    texts = own.join(F.broadcast(ids.distinct()), "doc_id").select(F.xxhash64("text").alias("text_id"), "toxic", "text")
    keys = texts.select("toxic", "text_id").distinct()
    some = lambda toxic, n: keys.where(F.col("toxic") == toxic).orderBy(F.xxhash64("text_id"), "text_id").limit(n)
    chosen = stored(some(1, TRAIN_TOXIC).union(some(0, TRAIN_CLEAN)), "texts")
    texts = texts.join(F.broadcast(chosen), ["toxic", "text_id"]).select("text_id", "toxic", "text")
    return stored(texts.dropDuplicates(["text_id", "toxic"]), "sample")


def _rate_ratio(t: F.Column, c: F.Column, toxic: int, clean: int) -> tuple[F.Column, F.Column]:
    """Log of the rate in toxic texts over that in clean ones, smoothed, and its standard deviation."""
    t, c = t + 0.5, c + 0.5
    return F.log(t / (toxic + 1)) - F.log(c / (clean + 1)), F.sqrt(1 / t + 1 / c)


def _in_context(sample: DataFrame, terms: list[str]) -> DataFrame:
    """(term, t, c): toxic and clean texts of each term, `QUOTED` of one where a text only quotes it."""
    sent = sample.sparkSession.sparkContext.broadcast(frozenset(terms))

    def count(batches):
        known, of_word = sent.value, {}
        for batch in slices(batches, "text"):
            sums: dict[str, list[float]] = {}
            for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
                text = (text or "").lower()
                weight: dict[str, float] = {}
                for m in _WORD.finditer(text):
                    own = of_word.get(m[0])
                    if own is None:
                        if len(of_word) >= CACHE:
                            of_word.clear()
                        own = of_word[m[0]] = [x for x in (m[0], *("^" + m[0][:n] for n in STEM_LENGTHS if len(m[0]) >= n)) if x in known]
                    if own and any(weight.get(x) != PLAIN for x in own):
                        w = QUOTED if is_quoted(text, m.start(), m.end()) else PLAIN
                        for x in own:
                            weight[x] = max(w, weight.get(x, 0.0))
                for x, w in weight.items():
                    sums.setdefault(x, [0.0, 0.0])[0 if toxic else 1] += w
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), type=pa.string()), *(pa.array([v[k] for v in sums.values()], type=pa.float64()) for k in (0, 1))], names=["term", "t", "c"])

    return sample.select("toxic", "text").mapInArrow(count, "term string, t double, c double").groupBy("term").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))


def learn(docs: DataFrame, labels: DataFrame, folds: int, held_fold: int) -> ToxicityModel:
    """Lexicon, blocked words and score curve of the training rows."""
    sample = _sample(docs, labels, folds, held_fold)
    counts = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic, clean = counts.get(1, 0), counts.get(0, 0)
    least = max(3, toxic // 400)
    words = sample.select("text_id", "toxic", F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}_]+"))).alias("word")).where("word <> ''")
    words = stored(words, "words")
    stems = words.select("text_id", "toxic", "word", F.explode(F.array(*(F.lit(n) for n in STEM_LENGTHS))).alias("n")).where("length(word) >= n")
    stems = stems.select("text_id", "toxic", "word", F.expr("left(word, n)").alias("stem"))
    counted = [F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")]
    t, c, seed = F.col("t"), F.col("c"), F.col("term").isin(*SEEDS)
    whole = words.groupBy(F.col("word").alias("term")).agg(*counted).where((t >= least) | seed)
    heads = stems.groupBy(F.concat(F.lit("^"), F.col("stem")).alias("term")).agg(*counted, F.approx_count_distinct("word").alias("kinds"))
    terms = stored(whole.unionByName(heads.where((t >= least) & (F.col("kinds") >= STEM_WORDS)).drop("kinds")), "terms")
    # Candidates: in enough toxic texts, and in no clean one or at a far lower rate.  The context of those that clean texts hold is looked at if it can decide.
    hopeful = (c > 0) & (seed | (_rate_ratio(t, c * QUOTED, toxic, clean)[0] >= math.log(RATIO)))
    weighed = stored(_in_context(sample, [r.term for r in terms.where(hopeful).select("term").collect()]), "weighed")
    ratio, deviation = _rate_ratio(t, c, toxic, clean)
    rated = weighed.select("term", ratio.alias("ratio"), (F.lit(DEVIATIONS) * deviation).alias("unsure"), seed.alias("seed"))
    weight = lambda x: F.least(F.lit(1.0), x / F.lit(math.log(FULL_RATIO)))
    likely = rated.where(F.col("ratio") - F.col("unsure") >= math.log(RATIO)).select("term", weight(F.col("ratio")).alias("weight"))
    likely = likely.join(terms.where(t >= least).select("term"), "term")
    admitted = stored(likely.unionByName(terms.where((t >= least) & (c == 0)).select("term", F.lit(1.0).alias("weight"))), "admitted")
    weights = {r.term: r.weight for r in admitted.collect()}
    head_pairs = stems.where("toxic = 1").select("text_id", F.concat(F.lit("^"), F.col("stem")).alias("term"))
    word_pairs = words.where("toxic = 1").select("text_id", F.col("word").alias("term"))
    pairs = [(r.text_id, r.term) for r in word_pairs.union(head_pairs).join(admitted.select("term"), "term").select("text_id", "term").distinct().collect()]
    chosen = choose_terms(pairs, least, weights)
    # A built-in insult stays unless its rates in the training rows speak against it.
    upper = F.col("ratio") + F.col("unsure")
    held = {r.term: r.weight for r in rated.where("seed").select("term", F.when(upper >= math.log(RATIO), weight(upper)).otherwise(0.0).alias("weight")).collect()}
    seeds = {s: held.get(s, 1.0) for s in SEEDS if s not in set(chosen) and held.get(s, 1.0) > 0}
    model = ToxicityModel([t for t in chosen if t[0] != "^"] + list(seeds), [t[1:] for t in chosen if t[0] == "^"], weights=seeds | {t: weights[t] for t in chosen})

    def near_words(batches):
        for batch in batches:
            got = [w for w in batch.column("word").to_pylist() if model._ready().verdict(w)[0] > 0]
            yield pa.RecordBatch.from_arrays([pa.array(got, type=pa.string())], names=["word"])

    clean_words = words.where("toxic = 0").select("word").distinct()
    model.blocked = frozenset(r.word for r in clean_words.mapInArrow(near_words, "word string").collect())
    model.automaton = None

    def weigh(batches):
        for batch in slices(batches, "text"):
            x = [round(model.evidence(t), 2) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(x, type=pa.float64())], names=["toxic", "x"])

    table = sample.select("toxic", "text").mapInArrow(weigh, "toxic int, x double").groupBy("toxic", "x").count().collect()
    if toxic and clean:
        model.slope, model.offset = fit_curve([(r.toxic, r.x, r["count"]) for r in table])
    model.automaton = None
    return model


def fit_curve(rows: list[tuple[int, float, int]]) -> tuple[float, float]:
    """Slope and offset of a logistic curve over log(1 + evidence), with a light ridge, by Newton steps."""
    y = np.array([r[0] for r in rows], dtype=float)
    x = np.column_stack([np.log1p([r[1] for r in rows]), np.ones(len(rows))])
    n = np.array([r[2] for r in rows], dtype=float)
    ridge = np.diag([0.02, 1e-3])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        grad = x.T @ (n * (p - y)) + ridge @ w
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + ridge, grad)
        w -= step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return float(max(w[0], 0.0)), float(w[1])


def toxicity_scores(docs: DataFrame, labels: DataFrame, folds: int = 3, held_fold: int = 1, threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    ``labels`` (doc_id, toxic): only rows whose crc32(doc_id as text) mod ``folds`` is not ``held_fold`` are learned from.  Null, empty and wordless
    texts have no evidence; a null doc_id is not held out and has no label; rows that share an id are judged one by one; extra
    columns are ignored; without labels the built-in words and curve are used; no rows give no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    own = narrowed(docs, doc_id="long", text="string")
    sent = spark.sparkContext.broadcast(learn(own, labels, folds, held_fold))
    held = F.coalesce(F.pmod(crc_of_id(F.col("doc_id")), F.lit(folds)) == held_fold, F.lit(False))

    def apply(batches):
        model = sent.value
        for batch in slices(batches, "text"):
            score = np.array([model.score(model.evidence(t)) for t in batch.column("text").to_pylist()], dtype=float)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    return own.select("doc_id", held.alias("held_out"), "text").mapInArrow(apply, "doc_id long, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, labels: DataFrame, folds: int = 3, held_fold: int = 1, threshold: float = 0.7) -> DataFrame:
    """All columns of the documents whose score is under the threshold; rows are scored one by one, as by `toxicity_scores`.

    Null, empty and wordless texts stay; of repeated rows all stay or go; without labels the built-in words decide; columns may have any
    names; no rows give no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(learn(narrowed(docs, doc_id="long", text="string"), labels, folds, held_fold))

    def keep(batches):
        model = sent.value
        for batch in slices(batches, "text"):
            good = [model.score(model.evidence(t)) < threshold for t in batch.column("text").to_pylist()]
            yield batch.select(["row"]).filter(pa.array(good, type=pa.bool_()))

    both = docs.select(whole_row(docs), docs["text"].cast("string").alias("text"))
    return both.mapInArrow(keep, T.StructType([T.StructField("row", docs.schema)])).select("row.*")
