"""Toxicity: terms found by Levenshtein automata intersected with a lexicon trie, weighed by their context."""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farsight.llm.common import broadcast_if_small, saved

#: Stems considered: whole words, and beginnings of so many letters.
SHORTEST_STEM, LONGEST_STEM = 4, 9
#: A term of the lexicon is in at least this share of the toxic texts, in LEAST_TEXTS of them, and so many times likelier there.
LEAST_SHARE, LEAST_TEXTS, LEAST_ODDS = 0.004, 3, 20.0
#: Words to either side of a hit that tell quotation from abuse.
WINDOW = 8
REMEMBERED = 400_000
#: Labelled rows learned from at most, drawn by a hash of the id; enough to settle the weights of some hundred terms.
MOST_LABELLED = 400_000

# Signs of quotation, words that report speech, and words that address someone.
OPENING, CLOSING = "\"“„«‘'", "\"”“»’'"
REPORTING = frozenset("said says called wrote word term quote quoted slur dit appelle mot sagte nannte wort dijo palabra".split())
ADDRESSING = frozenset("you your you're u du dich dein ihr sie tu te vous votre tú usted eres sois es".split())
DISGUISES = str.maketrans("@013457$!|", "aoieastsii")


@dataclass(frozen=True)
class Term:
    """A lexicon entry; an open one stands for all words that begin with it."""

    stem: str
    open: bool
    weight: float

    @property
    def edits(self) -> int:
        """Edits allowed: none in short stems, and none in short open ones, which other words are near to."""
        size = len(self.stem) - 2 * self.open
        return 0 if size < 5 else 1 if size < 9 else 2


class LexiconMatcher:
    """The best lexicon term for a word, within each term's number of edits (the first letter is never edited).

    A state is a set of (trie node, edits so far), that is, of a Levenshtein automaton run along the whole trie at
    once. States and steps are made when first met and then kept, so that most words end after a few lookups.
    """

    def __init__(self, terms: tuple[Term, ...]):
        self.terms = terms
        self._children: list[dict[str, int]] = [{}]
        self._ends: list[list[int]] = [[]]
        self._reach = [0]  # most edits allowed by any term below a node
        for at, term in enumerate(terms):
            node = 0
            for sign in term.stem:
                self._reach[node] = max(self._reach[node], term.edits)
                if sign not in self._children[node]:
                    self._children[node][sign] = len(self._children)
                    self._children.append({})
                    self._ends.append([])
                    self._reach.append(0)
                node = self._children[node][sign]
            self._reach[node] = max(self._reach[node], term.edits)
            self._ends[node].append(at)
        self._state: dict[frozenset, int] = {}
        self._sets: list[frozenset] = []
        self._steps: list[dict[str, int]] = []
        self._begins: list[tuple | None] = []  # best open term met in a state
        self._whole: list[tuple | None] = []  # best term that a word ending there is
        self._start = self._number(frozenset({(0, 0)}))
        self._known: dict[str, tuple | None] = {}

    def _number(self, members: frozenset) -> int:
        found = self._state.get(members)
        if found is None:
            found = self._state[members] = len(self._sets)
            self._sets.append(members)
            self._steps.append({})
            hits = [
                (self.terms[at].weight / (1 + edits), -edits, at)
                for node, edits in members
                for at in self._ends[node]
                if edits <= self.terms[at].edits
            ]
            self._begins.append(max((h for h in hits if self.terms[h[2]].open), default=None))
            self._whole.append(max(hits, default=None))
        return found

    def _step(self, state: int, sign: str) -> int:
        out: set[tuple[int, int]] = set()
        for node, edits in self._sets[state]:
            exact = self._children[node].get(sign)
            if exact is not None:
                out.add((exact, edits))
            if node and edits < self._reach[node]:
                out.add((node, edits + 1))
                out.update((child, edits + 1) for child in self._children[node].values())
        todo = list(out)
        while todo:  # letters of the term that the word leaves out
            node, edits = todo.pop()
            if edits < self._reach[node]:
                for child in self._children[node].values():
                    if (child, edits + 1) not in out:
                        out.add((child, edits + 1))
                        todo.append((child, edits + 1))
        least: dict[int, int] = {}
        for node, edits in out:
            if edits <= self._reach[node]:
                least[node] = min(edits, least.get(node, edits))
        found = self._steps[state][sign] = self._number(frozenset(least.items()))
        return found

    def match(self, word: str) -> tuple[int, int] | None:
        """(term, edits) of the best term for a word in lower case, or None."""
        state, best = self._start, None
        for sign in word:
            following = self._steps[state].get(sign)
            state = self._step(state, sign) if following is None else following
            if self._begins[state] is not None:
                best = max(best or (0.0, 0, 0), self._begins[state])
            if not self._sets[state]:
                break
        else:
            if self._whole[state] is not None:
                best = max(best or (0.0, 0, 0), self._whole[state])
        return None if best is None else (best[2], -best[1])

    def match_token(self, token: str) -> tuple[int, int] | None:
        """The same for a token between white space: signs around it are cut off, disguised letters undone."""
        if token in self._known:
            return self._known[token]
        word = token.strip("\"“”„«»‘’'.,;:!?()[]{}*#%&$|…-_")
        found = self.match(word)
        if found is None and not word.isalpha():
            inner = "".join(filter(str.isalpha, token.translate(DISGUISES)))
            found = self.match(inner)
        if len(self._known) > REMEMBERED:
            self._known.clear()
        self._known[token] = found
        return found


# Common insults that every lexicon holds, whatever the labels show.
INSULTS = (
    "idiot moron imbecile stupid dumb loser scum trash pathetic worthless disgusting clown bastard asshole bitch "
    "dumbass jackass retard degenerate subhuman vermin idiota imbécil estúpido pendejo basura crétin connard salaud "
    "ordure trottel vollidiot abschaum arschloch schwachkopf"
).split()
INSULT_WEIGHT = 4.0

FEATURES = ("direct", "quoted", "misspelled", "addressed", "weight", "density")


def text_features(matcher: LexiconMatcher, text: str) -> list[float]:
    """The numbers a text is judged by: hits outside and inside quotation, misspelled ones, hits near words that
    address someone, the largest weight met outside quotation, and hits a hundred words."""
    tokens = text.lower().split()
    hits = [(at, found) for at, found in enumerate(map(matcher.match_token, tokens)) if found]
    if not hits:
        return [0.0] * len(FEATURES)
    direct = quoted = misspelled = addressed = 0
    weight = 0.0
    for at, (term, edits) in hits:
        before, after = tokens[max(0, at - WINDOW) : at], tokens[at + 1 : at + 1 + WINDOW]
        opened = any(t[0] in OPENING for t in (*before, tokens[at]))
        closed = any(t.rstrip(".,;:!?")[-1:] in CLOSING for t in (tokens[at], *after) if t.rstrip(".,;:!?"))
        if opened and closed or not REPORTING.isdisjoint(before[-3:]):
            quoted += 1
            continue
        direct += edits == 0
        misspelled += edits > 0
        addressed += not ADDRESSING.isdisjoint((*before, *after))
        weight = max(weight, matcher.terms[term].weight / (1 + edits))
    return [
        math.log1p(direct),
        math.log1p(quoted),
        math.log1p(misspelled),
        math.log1p(addressed),
        weight,
        math.log1p(100 * (direct + misspelled) / len(tokens)),
    ]


_words_of = regex.compile(r"\p{L}{3,}").findall


def _terms(text: str) -> set[str]:
    """A text's words, each with "$" after it, and their beginnings."""
    words = set(_words_of(text.lower()))
    beginnings = {word[:n] for word in words for n in range(SHORTEST_STEM, min(LONGEST_STEM, len(word)) + 1)}
    return beginnings.union(word + "$" for word in words)


def _term_counts(texts: DataFrame, wanted: frozenset[str] | None) -> DataFrame:
    """(term, n): how many texts hold each term (of `wanted` only, if given); summed within tasks, then by Spark."""
    shared = texts.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0):
                found = _terms(text.as_py())
                counts.update(found if shared.value is None else found & shared.value)
                if len(counts) > REMEMBERED:
                    yield _counted(counts)
                    counts.clear()
        yield _counted(counts)

    parts = texts.select("text").mapInArrow(run, "term string, n long")
    return parts.groupBy("term").agg(F.sum("n").alias("n"))


def _counted(counts: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"term": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())}
    )


def labelled_texts(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MOST_LABELLED
) -> DataFrame:
    """(text, toxic) of the documents that `labels` (id, toxic) has, about `most` of them, written once.

    With no more labels than that their ids always fit a broadcast, so that no text is shuffled. Labels of null ids are
    for no row.
    """
    usable = labels.select(F.col(id_col).alias("id"), "toxic").filter("id IS NOT NULL AND toxic IN (0, 1)")
    share = most / max(most, usable.count())
    drawn = F.pmod(F.xxhash64(F.lit("labels"), "id"), F.lit(1 << 20)) < int(share * (1 << 20))
    chosen = broadcast_if_small(saved(usable.filter(drawn), "labels"), 16)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return saved(texts.join(chosen, "id").select("text", "toxic"), "labelled-texts")


def learn_lexicon(labelled: DataFrame) -> tuple[Term, ...]:
    """Terms that tell toxic texts from others, of `labelled` (text, toxic: 0, 1 or null).

    Counts the labelled texts that hold each word, and each beginning of a word. Only terms in at least a LEAST_SHARE of the
    toxic texts are counted in the others and can reach the driver: at most the mean number of terms in a text
    divided by that share. Of nested terms with nearly equal counts the longest stays, then the shortest of what is left.
    """
    texts = labelled.filter("toxic IN (0, 1) AND text IS NOT NULL")
    totals = dict(texts.groupBy("toxic").count().collect())
    toxic, other = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not other:
        return tuple(Term(w, False, INSULT_WEIGHT) for w in INSULTS)
    least = max(LEAST_TEXTS, math.ceil(LEAST_SHARE * toxic))
    inside = _term_counts(texts.filter("toxic = 1"), None).withColumnRenamed("n", "inside")
    frequent = saved(inside.filter(F.col("inside") >= least), "terms")
    known = frozenset(row[0] for row in frequent.select("term").toLocalIterator())
    outside = _term_counts(texts.filter("toxic = 0"), known).withColumnRenamed("n", "outside")
    odds = (F.col("inside") + 0.5) / (F.coalesce("outside", F.lit(0)) + 0.5) * (other / toxic)
    rows = frequent.join(outside, "term", "left").filter(odds >= LEAST_ODDS)
    found = {row["term"]: (row["inside"], math.log(row["odds"])) for row in rows.select("term", "inside", odds.alias("odds")).collect()}

    def parent(term: str) -> str:
        return term[: min(len(term) - 1, LONGEST_STEM)]

    narrow = {t for t, (n, _) in found.items() if (p := parent(t)) in found and n >= 0.9 * found[p][0]}
    widened = {parent(t) for t in narrow}  # a longer term says nearly the same
    kept = [t for t in found if t not in widened]
    chosen = [
        t for t in kept if not any(t.rstrip("$") != p and t.startswith(p) for p in kept if not p.endswith("$"))
    ]
    learned = {t.rstrip("$"): Term(t.rstrip("$"), not t.endswith("$"), round(found[t][1], 6)) for t in sorted(chosen)}
    return (*learned.values(), *(Term(w, False, INSULT_WEIGHT) for w in INSULTS if w not in learned))


@functools.lru_cache(maxsize=2)
def _matcher(terms: tuple[Term, ...]) -> LexiconMatcher:
    return LexiconMatcher(terms)


def _with_features(df: DataFrame, columns: list[str], terms: tuple[Term, ...]) -> DataFrame:
    """`columns` of df and the features of its `text`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(terms)
        for batch in batches:
            rows = [text_features(matcher, text.as_py() or "") for text in batch.column(len(columns))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(columns)], pa.array(rows, pa.list_(pa.float64()))], names=[*columns, "features"]
            )

    kinds = dict(df.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in columns) + ", features array<double>"
    return df.select(*[F.col(f"`{c}`") for c in columns], "text").mapInArrow(run, schema)


@dataclass(frozen=True)
class ToxicityModel:
    terms: tuple[Term, ...]
    weights: tuple[float, ...]
    intercept: float


def fit_toxicity(labelled: DataFrame) -> ToxicityModel:
    """Lexicon and weights from `labelled` (text, toxic). Rows whose label is neither 0 nor 1 teach nothing; without rows
    of both labels the score is the share of toxic rows (0 for none) everywhere."""
    usable = labelled.filter("toxic IN (0, 1)").select(F.col("text"), F.col("toxic").cast("double").alias("toxic"))
    terms = learn_lexicon(usable)
    rows = saved(_with_features(usable, ["toxic"], terms), "toxicity-features")
    share = rows.agg(F.avg("toxic")).first()[0]
    if not terms or share in (None, 0.0, 1.0):
        prior = min(max(share or 0.0, 1e-6), 1 - 1e-6)
        return ToxicityModel((), (0.0,) * len(FEATURES), math.log(prior / (1 - prior)))
    fit = LogisticRegression(labelCol="toxic", featuresCol="vector", regParam=1e-3, maxIter=40).fit(
        rows.select("toxic", array_to_vector("features").alias("vector"))
    )
    return ToxicityModel(terms, tuple(float(w) for w in fit.coefficients), float(fit.intercept))


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: id, score (0..1, higher: likelier toxic), features (in the order of FEATURES).

    Whole texts are read; null counts as empty, which has no hit and gets the score of texts without any. Rows may
    repeat, ids may be null, other columns are neither read nor returned, an empty table gives no rows. No shuffle.
    """
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = _with_features(named, ["id"], model.terms)
    total = F.lit(model.intercept)
    for at, weight in enumerate(model.weights):
        total = total + F.lit(weight) * F.col("features")[at]
    return found.select(F.col("id").alias(id_col), (1 / (1 + F.exp(-total))).alias("score"), "features")
