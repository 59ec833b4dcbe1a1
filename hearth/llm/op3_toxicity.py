"""Toxicity: a learned lexicon, matched by Levenshtein automata over its trie, weighed by context windows.

Learning: from a bounded, documented sample of labelled rows (``SAMPLE`` of each class, chosen by a hash
of the id, never from the held-out third) terms are taken whose use in toxic rows stands out: whole words
and word stems, each with a log-odds weight. A term's support counts different neighbourhoods (the words
around it), so copies of one text count once. A logistic regression over five features of a text is
fitted on the same sample.

Scoring: the words of the whole text are run through the automaton of the lexicon trie; it accepts a term
with up to 0, 1 or 2 edits by its length, and any word that starts with a stem. Each hit is weighed by its
window of ``WINDOW`` words: quotation marks around it or a word of reporting lower the weight, address in
the second person or another hit raises it. The features are the weighted sums of exact and misspelled
hits, quoted and not, and their density.

Defined results: a null or empty text has no hits and gets the score of a text without hits; a null id is
never held out and never learned from; null labels are not learned from; repeated rows are scored each;
without labelled rows of both classes the lexicon is empty and every score is the share of toxic labels
(0 if there are no labels). Other columns are ignored. Labels, lang, source and doc_id are not inputs of a
score.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free, written

SAMPLE = 2000  # labelled rows of each class that are learned from, at most
SUPPORT = 3  # different neighbourhoods that a term needs in toxic rows
LOG_ODDS = 3.0  # least weight of a term
STEM = (4, 6)  # lengths of word stems
STEM_WORDS = 3  # different words that a stem needs
WINDOW = 6  # words before and after a hit
THRESHOLD = 0.7
MEMO = 150_000  # words whose match a task remembers

# --- fixed values: words of reporting and of address, quotation marks
REPORTING = frozenset(
    "said says called calls wrote writes quoted quote quotes word words term terms sagte sagt nannte schrieb zitat wort "
    "dijo dice llamó escribió cita palabra dit disait écrit appelé mot citation".split())
ADDRESS = frozenset("you your yours youre du dich dir dein deine ihr euch tu te tus usted vosotros eres toi vous votre".split())
QUOTES = re.compile("[\"“”„«»‹›]")

WORD = re.compile(r"[^\W_]+")


class LexiconAutomaton:
    """Levenshtein automata of all terms at once: a lazily built DFA over (trie node, edits) sets.

    A word matches a term within the term's edits, or a stem that it starts with. Characters outside the
    lexicon are one symbol; the number of states kept is bounded.
    """

    STATES = 200_000

    def __init__(self, words: dict[str, float], stems: dict[str, float]):
        self.child: list[dict[str, int]] = [{}]
        self.word: list[str | None] = [None]
        self.stem: list[str | None] = [None]
        for term in sorted(words):
            self.word[self._add(term)] = term
        for term in sorted(stems):
            self.stem[self._add(term)] = term
        self.limit = [0] * len(self.child)  # edits that some term below a node allows
        for term in words:
            at, most = 0, self.edits(term)
            self.limit[0] = max(self.limit[0], most)
            for c in term:
                at = self.child[at][c]
                self.limit[at] = max(self.limit[at], most)
        self.alphabet = frozenset(c for node in self.child for c in node)
        self._reset()

    @staticmethod
    def edits(term: str) -> int:
        return 0 if len(term) < 5 else 1 if len(term) < 9 else 2

    def _add(self, term: str) -> int:
        at = 0
        for c in term:
            if c not in self.child[at]:
                self.child[at][c] = len(self.child)
                self.child.append({})
                self.word.append(None)
                self.stem.append(None)
            at = self.child[at][c]
        return at

    def _closed(self, pairs) -> frozenset:
        """With the nodes reached by leaving out characters of the term; the fewest edits of each node."""
        best: dict[int, int] = {}
        todo = list(pairs)
        while todo:
            n, e = todo.pop()
            if e > self.limit[n] and e or best.get(n, 99) <= e:
                continue
            best[n] = e
            todo += [(c, e + 1) for c in self.child[n].values() if e < self.limit[c]]
        return frozenset(best.items())

    def _reset(self) -> None:
        self.start = self._closed([(0, 0)])
        self.steps: dict[frozenset, dict[str, frozenset]] = {self.start: {}}

    def _step(self, state: frozenset, c: str) -> frozenset:
        after = []
        for n, e in state:
            if c in self.child[n]:
                after.append((self.child[n][c], e))
            if e < self.limit[n]:
                after.append((n, e + 1))
                after += [(x, e + 1) for x in self.child[n].values()]
        if len(self.steps) > self.STATES:
            self._reset()
        out = self._closed(after)
        self.steps.setdefault(state, {})[c] = out
        self.steps.setdefault(out, {})
        return out

    def match(self, word: str) -> tuple[str, int] | None:
        """(term, edits) of the best match: a stem first, then the fewest edits, then the first term."""
        state, at = self.start, 0
        for c in word:
            if at is not None:
                at = self.child[at].get(c)
                if at is not None and self.stem[at] is not None:
                    return self.stem[at], 0
            c = c if c in self.alphabet else "\0"
            known = self.steps.get(state)
            nxt = known.get(c) if known is not None else None
            state = nxt if nxt is not None else self._step(state, c)
            if not state and at is None:
                return None
        found = [(e, self.word[n]) for n, e in state if self.word[n] is not None and e <= self.edits(self.word[n])]
        return min(found)[::-1] if found else None


@dataclass
class ToxicityModel:
    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    weights: tuple[float, ...] = (0.0,) * 5
    bias: float = -20.0

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-(features @ np.asarray(self.weights) + self.bias)))


class _Memo(dict):
    def __init__(self, automaton: LexiconAutomaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: str):
        if len(self) > MEMO:
            self.clear()
        found = self[word] = self.automaton.match(word)
        return found


def text_features(text: str, memo: _Memo, weight: dict[str, float]) -> tuple[float, ...]:
    """log(1 + weighted hits): exact, misspelled, exact quoted, misspelled quoted; and weight per word."""
    low = text.lower()
    words = WORD.findall(low)
    hits = [(i, m) for i, w in enumerate(words) if (m := memo[w])]
    if not hits:
        return (0.0,) * 5
    at = {i for i, _ in hits}
    marks = [m.start() for m in QUOTES.finditer(low)]
    spans = [m.span() for m in WORD.finditer(low)] if marks else []
    sums = [0.0] * 4
    for i, (term, edits) in hits:
        near = words[max(0, i - WINDOW):i] + words[i + 1:i + 1 + WINDOW]
        quoted = not REPORTING.isdisjoint(near)
        if not quoted and marks:
            a, b = spans[max(0, i - WINDOW)][0], spans[min(len(spans) - 1, i + WINDOW)][1]
            # a mark in the window before the hit and one in the window after it
            before, after = bisect_left(marks, a), bisect_left(marks, spans[i][1])
            quoted = before < len(marks) and marks[before] < spans[i][0] and after < len(marks) and marks[after] <= b
        aimed = not ADDRESS.isdisjoint(near) or any(j in at for j in range(i - WINDOW, i + WINDOW + 1) if j != i)
        sums[(edits > 0) + 2 * quoted] += weight[term] * (1.5 if aimed else 1.0)
    return (*(math.log1p(x) for x in sums), sum(sums) / len(words))


def _keys_of(word: str) -> list[str]:
    return [word, *(word[:k] + "*" for k in range(STEM[0], min(STEM[1], len(word) - 1) + 1))]


def _place(words: list[str], i: int) -> int:
    """A 64-bit name of a word's neighbourhood."""
    near = f"{words[i - 1] if i else ''} {words[i + 1] if i + 1 < len(words) else ''}"
    return xxhash.xxh64_intdigest(near.encode("utf-8", "surrogatepass")) - (1 << 63)


def term_rows(rows: Iterable[tuple[str, int]]) -> Iterator[tuple]:
    """Of some (text, toxic) rows, per term and class: (key, toxic, rows that have it, 0, neighbourhoods, a stem's words), the
    last two of toxic rows and no more than the tests ask for; with the key "" a class's rows and, in the fourth, words."""
    n, total = [0, 0], [0, 0]
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    places: dict[str, set] = defaultdict(set)
    stem_words: dict[str, set] = defaultdict(set)
    for text, toxic in rows:
        words = WORD.findall(text.lower())
        n[toxic] += 1
        total[toxic] += len(words)
        keys = {w: _keys_of(w) for w in set(words) if len(w) >= STEM[0]}
        seen[toxic].update({k for ks in keys.values() for k in ks})
        if not toxic:
            continue
        for i, w in enumerate(words):
            for k in keys.get(w, ()):
                if len(places[k]) < SUPPORT:
                    places[k].add(_place(words, i))
        for w, ks in keys.items():
            for k in ks:
                if k[-1] == "*" and len(stem_words[k]) < STEM_WORDS:
                    stem_words[k].add(w)
    for toxic in (0, 1):
        yield "", toxic, n[toxic], total[toxic], [], []
        for k, c in seen[toxic].items():
            yield k, toxic, c, 0, sorted(places[k]) if toxic else [], sorted(stem_words.get(k, ())) if toxic else []


def place_rows(rows: Iterable[tuple[str, int]], terms: frozenset) -> set[tuple[str, int, int]]:
    """(key, toxic, neighbourhood) of the given terms' uses in some (text, toxic) rows."""
    out = set()
    for text, toxic in rows:
        words = WORD.findall(text.lower())
        for i, w in enumerate(words):
            if len(w) >= STEM[0] and (ks := [k for k in _keys_of(w) if k in terms]):
                place = _place(words, i)
                out.update((k, toxic, place) for k in ks)
    return out


def chosen_terms(uses: dict[str, tuple[int, int]], weights: dict[str, float], tested: int,
                 total: list[int]) -> tuple[dict[str, float], dict[str, float]]:
    """Words and stems with their weights: of ``weights`` the terms whose uses (neighbourhoods in other and toxic rows)
    differ by more than chance among ``tested`` terms; ``total``: words by class."""
    surprise = 2 * math.log(max(2, tested))  # what chance reaches in so many tests

    def gain(key: str) -> float:
        """Likelihood ratio of the term's uses in toxic and other rows against equal use."""
        k0, k1 = uses.get(key, (0, 0))
        e1 = (k1 + k0) * total[1] / (total[0] + total[1])
        return 2 * (k1 * math.log(k1 / e1) + (k0 * math.log(k0 / (k1 + k0 - e1)) if k0 else 0.0)) if k1 > e1 else 0.0

    kept = {k: x for k, x in weights.items() if gain(k) > surprise}
    stems = {k[:-1]: x for k, x in kept.items() if k[-1] == "*"}
    # a stem goes where a longer stem or word is purer, else the shortest stands for the longer ones
    purer: dict[str, float] = defaultdict(float)
    for k, x in kept.items():
        for j in range(STEM[0], len(k) + 1):
            purer[k[:j]] = max(purer[k[:j]], x)
    stems = {s: x for s, x in stems.items() if purer[s] <= x + 0.5}
    stems = {s: x for s, x in stems.items() if not any(s[:k] in stems for k in range(STEM[0], len(s)))}
    words = {k: x for k, x in kept.items() if k[-1] != "*" and not any(k[:j] in stems for j in range(STEM[0], STEM[1] + 1))}
    return words, stems


def _weight(seen: tuple[int, int], n: list[int]) -> float:
    return math.log((seen[1] + 0.5) / (n[1] + 1)) - math.log((seen[0] + 0.5) / (n[0] + 1))


def learn_lexicon(rows: list[tuple[str, int]]) -> tuple[dict[str, float], dict[str, float]]:
    """Words and stems with their log-odds weights from (text, toxic) rows."""
    n, total, seen, passed = [0, 0], [0, 0], defaultdict(lambda: [0, 0]), set()
    for k, toxic, c, words, places, kinds in term_rows(rows):
        if not k:
            n[toxic], total[toxic] = c, words
            continue
        seen[k][toxic] = c
        if toxic and c >= SUPPORT and len(places) >= SUPPORT and (k[-1] != "*" or len(kinds) >= STEM_WORDS):
            passed.add(k)
    if not min(n):
        return {}, {}
    weights = {k: x for k in passed if (x := _weight(seen[k], n)) >= LOG_ODDS}
    uses: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    for k, toxic, _ in place_rows(rows, frozenset(weights)):
        uses[k][toxic] += 1
    return chosen_terms(uses, weights, len(passed), total)


def _pairs(b) -> Iterator[tuple[str, int]]:
    """(text, toxic) of a batch, a row at a time."""
    return ((t.as_py(), c.as_py()) for t, c in zip(b.column("text"), b.column("toxic"), strict=True))


def lexicon_of(sample: DataFrame) -> tuple[dict[str, float], dict[str, float], list[int]]:
    """As ``learn_lexicon`` from a table (text, toxic), and the rows by class: terms are counted by Spark, the driver gets
    those whose weight suffices."""
    def terms(batches: Iterator) -> Iterator:
        for b in batches:
            got = list(zip(*term_rows(_pairs(b)), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(got, kinds, strict=True)], names=names)

    names = ["key", "toxic", "rows", "words", "places", "kinds"]
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string())]
    many = lambda c: F.size(F.array_distinct(F.flatten(F.collect_list(c))))  # noqa: E731 - a task gives at most SUPPORT or STEM_WORDS
    of = lambda c, toxic: F.sum(F.when(F.col("toxic") == toxic, F.col(c)).otherwise(0))
    counts = written(sample.mapInArrow(terms, "key string, toxic int, rows long, words long, places array<long>, kinds array<string>")
                     .groupBy("key").agg(of("rows", 0).alias("n0"), of("rows", 1).alias("n1"), of("words", 0).alias("w0"),
                                         of("words", 1).alias("w1"), many("places").alias("places"), many("kinds").alias("kinds")),
                     "terms", few=True)
    whole = counts.where("key = ''").first()
    n, total = ([whole["n0"], whole["n1"]], [whole["w0"], whole["w1"]]) if whole else ([0, 0], [0, 0])
    if not min(n):
        free(counts)
        return {}, {}, n
    passed = counts.where((F.col("key") != "") & (F.col("n1") >= SUPPORT) & (F.col("places") >= SUPPORT)
                          & (~F.col("key").endswith("*") | (F.col("kinds") >= STEM_WORDS)))
    tested = passed.count()
    odds = F.log((F.col("n1") + 0.5) / (n[1] + 1)) - F.log((F.col("n0") + 0.5) / (n[0] + 1))
    weights = {r["key"]: x for r in passed.where(odds >= LOG_ODDS - 1e-6).select("key", "n0", "n1").orderBy("key").collect()
               if (x := _weight((r["n0"], r["n1"]), n)) >= LOG_ODDS}
    free(counts)
    known = frozenset(weights)

    def places(batches: Iterator) -> Iterator:
        for b in batches:
            got = list(zip(*place_rows(_pairs(b), known), strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(got, (pa.string(), pa.int32(), pa.int64()), strict=True)],
                                             names=["key", "toxic", "place"])

    uses: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    for r in (sample.mapInArrow(places, "key string, toxic int, place long").distinct().groupBy("key", "toxic").count().collect()):
        uses[r["key"]][r["toxic"]] = r["count"]
    return *chosen_terms(uses, weights, tested, total), n


def fit_rows(rows: list[tuple[str, int]], rounds: int = 400, ridge: float = 0.01) -> ToxicityModel:
    """The model from (text, toxic) rows: lexicon, then a logistic regression with classes weighed alike."""
    y = np.array([t for _, t in rows], dtype=float)
    if not len(y) or y.min() == y.max():
        return share_model(float(y.mean()) if len(y) else 0.0)
    words, stems = learn_lexicon(rows)
    memo = _Memo(LexiconAutomaton(words, stems))
    return fit_features(words, stems, np.array([text_features(t, memo, words | stems) for t, _ in rows]), y, rounds, ridge)


def share_model(share: float) -> ToxicityModel:
    """Every score is the share of toxic labels."""
    p = min(max(share, 1e-9), 1 - 1e-9)
    return ToxicityModel(bias=math.log(p / (1 - p)))


def fit_features(words: dict[str, float], stems: dict[str, float], x: np.ndarray, y: np.ndarray, rounds: int = 400,
                 ridge: float = 0.01) -> ToxicityModel:
    """The logistic regression over the rows' features."""
    # weights are kept non-negative: more hits never lower a score; a quoted hit never counts more than a plain one
    w, b = np.zeros(5), -1.0
    c = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(x @ w + b)))
        g = c * (p - y)
        h = c * p * (1 - p)
        full = np.hstack([x, np.ones((len(y), 1))])
        hess = (full * h[:, None]).T @ full + np.diag([ridge] * 5 + [1e-6])
        step = np.linalg.solve(hess, full.T @ g + np.append(ridge * w, 0.0))
        step *= min(1.0, 2.0 / max(1e-12, float(np.abs(step).max())))
        w, b = np.maximum(w - step[:5], 0.0), b - float(step[5])
        if float(np.abs(step).max()) < 1e-6:
            break
    w[2], w[3] = min(max(w[2], w[0] / 2), w[0]), min(max(w[3], w[1] / 2), w[1])
    return ToxicityModel(words, stems, tuple(float(v) for v in w), float(b))


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text modulo 3 is 1; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ToxicityModel:
    """Learn from at most ``sample`` labelled rows of each class that are not held out."""
    use = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    use = use.select("doc_id", (F.col("toxic") > 0).cast("int").alias("toxic")).distinct()
    order = (F.xxhash64("doc_id"), "doc_id")
    picked = None
    for c in (0, 1):
        ids = use.where(F.col("toxic") == c).orderBy(*order).limit(sample)
        picked = ids if picked is None else picked.unionByName(ids)
    # at most 2 * sample ids: broadcast, so the texts are read without a shuffle
    got = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
           .join(F.broadcast(picked), "doc_id").orderBy("doc_id", "toxic", "text").limit(2 * sample)
           .select(F.monotonically_increasing_id().alias("at"), "text", "toxic"))
    # the driver gets no texts: terms are counted and features computed by tasks
    rows = written(got.repartition(2 * docs.sparkSession.sparkContext.defaultParallelism, "at"), "sample")
    words, stems, n = lexicon_of(rows)
    if not min(n):
        free(rows)
        return share_model(n[1] / sum(n) if sum(n) else 0.0)

    def features(batches: Iterator) -> Iterator:
        memo = _Memo(LexiconAutomaton(words, stems))
        for b in batches:
            x = [text_features(t.as_py(), memo, words | stems) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("at"), b.column("toxic"), pa.array(x, pa.list_(pa.float64()))],
                                             names=["at", "toxic", "x"])

    found = rows.mapInArrow(features, "at long, toxic int, x array<double>").orderBy("at").collect()
    free(rows)
    return fit_features(words, stems, np.array([r["x"] for r in found]), np.array([r["toxic"] for r in found], dtype=float))


def score_texts(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` and then ``toxicity`` (0 to 1) and ``toxic_predicted`` (0 or 1), in one pass."""
    names = [c for c in docs.columns if c not in ("toxicity", "toxic_predicted")]
    docs = docs.select(*[F.col(f"`{c}`") for c in names])
    schema = T.StructType([*docs.schema.fields, T.StructField("toxicity", T.DoubleType()),
                           T.StructField("toxic_predicted", T.IntegerType())])

    def run(batches: Iterator) -> Iterator:
        memo = _Memo(LexiconAutomaton(model.words, model.stems))
        weight = model.words | model.stems
        for b in batches:
            x = np.array([text_features(t or "", memo, weight) for t in b.column("text").to_pylist()]).reshape(-1, 5)
            p = model.score(x)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(p, pa.float64()), pa.array((p >= threshold).astype("int32"), pa.int32())],
                names=[*b.schema.names, "toxicity", "toxic_predicted"])

    return docs.mapInArrow(run, schema)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    model = fit_toxicity(docs, labels)
    out = score_texts(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                      F.col("toxicity").alias("score"), F.col("toxic_predicted").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows predicted toxic; all columns stay."""
    return score_texts(docs, fit_toxicity(docs, labels)).where("toxic_predicted = 0").select(*docs.columns)
