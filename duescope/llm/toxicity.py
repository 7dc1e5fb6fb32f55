"""Toxicity from a learned lexicon, matched by Levenshtein automata over its trie.

Lexicon: words and word beginnings whose documents are labelled toxic far more often than
chance; some beginnings only count where a text has two such words. Words are runs of letters,
marks and digits, so typographic quotes, dashes and dots part them like ASCII ones. Beginnings match
any ending; whole words also match misspelled: one edit from five letters on, two from eight. The automaton of "within so many edits of a term" is intersected
with the trie of all terms at once and made deterministic on demand, so a word is read letter
by letter and most words end in the dead state after a few. Misspellings that training texts
use in harmless documents are exceptions.

A hit weighs by where it stands: hits in a quotation (between quotation marks, on a line that
starts with ">", or near a word of reported speech) are one feature, hits in the author's own
words another; a logistic regression over the labelled rows gives their weights.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import regex
import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duescope.llm.common import letter_words, pieces, utf8
from duescope.llm.labelled import FIT_ROWS, fit_rows
from duescope.storage import stored

BEGINNINGS = (3, 4, 5, 6, 7, 8)  # lengths of word beginnings that may be terms
SURE = 3.5  # standard errors: keeps chance associations out of the lexicon
LIKELY = 0.35  # the least share of toxic documents at that confidence
COUNTED, REMEMBERED = 200_000, 200_000  # terms a task counts before it hands them on; words whose matches it keeps
PIECE = 1 << 20  # bytes of texts that are looked at together
COPY_SHINGLE = 5  # words of the shingles that copies are known by
WINDOW = 5  # words on each side of a hit that are searched for reported speech
FEATURES = 5
# Words of reported speech
REPORTED = frozenset(
    "said says wrote writes called calls quote quoted quotes quoting reported according "
    "sagte schrieb nannte zitat zitiert dit écrit appelé citation dijo escribió llamó cita".split())
_WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")
_MARKS = re.compile("[\"“”„«»]|^[ \t]*>", re.M)


class Spoken(dict):
    """Word between spaces and ASCII marks (bytes) -> the lower-cased words in it, remembered: marks
    beyond ASCII, such as typographic quotes, dashes and dots, part words too."""

    def __missing__(self, word: bytes) -> tuple[str, ...]:
        if len(self) > REMEMBERED:
            self.clear()
        w = word.decode("utf-8", "replace").lower()
        found = self[word] = (w,) if word.isascii() else tuple(_WORD.findall(w))
        return found

    def words(self, text: bytes | None) -> list[str]:
        return [w for part in map(self.__getitem__, letter_words(text)) for w in part]


@dataclass
class Lexicon:
    """terms: edits allowed (None: a beginning); weights; terms that must occur twice in a text;
    words that a beginning covers, with that beginning: misspelled they count as hits of it."""

    terms: dict[str, int | None]
    weights: dict[str, float]
    twice: set[str]
    covered: dict[str, str] = field(default_factory=dict)


def edits(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 8 else 2


class Automaton:
    """Trie of terms intersected with their Levenshtein automata, determinised on demand.

    A state is a set of (trie node, edits so far). `terms` maps a term to its edits; a term with
    None matches as the exact beginning of a word. `covered` maps further words to the terms that
    they are hits of; they have the edits of their own lengths.
    """

    def __init__(self, terms: dict[str, int | None], covered: dict[str, str] | None = None) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.budget: list[int] = [0]  # most edits of any term below
        self.ends: list[tuple[str, int] | None] = [None]
        self.opens: list[str | None] = [None]
        for term, k, name in [*((t, k, t) for t, k in terms.items()), *((w, edits(w), t) for w, t in (covered or {}).items())]:
            node = 0
            self.budget[0] = max(self.budget[0], k or 0)
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.budget.append(0)
                    self.ends.append(None)
                    self.opens.append(None)
                node = self.children[node][c]
                self.budget[node] = max(self.budget[node], k or 0)
            if k is None:
                self.opens[node] = name
            else:
                self.ends[node] = (name, k)
        self.start = self._closed({(0, 0)})
        self.steps: dict[tuple[frozenset, str], frozenset] = {}
        self.accepts: dict[frozenset, tuple[str, int] | None] = {}

    def _closed(self, states: set[tuple[int, int]]) -> frozenset:
        """With letters of the term left out; fewer edits at the same node win."""
        best: dict[int, int] = {}
        todo = sorted(states, key=lambda s: s[1])
        while todo:
            node, e = todo.pop()
            if e > self.budget[node] and e or best.get(node, 99) <= e:
                continue
            best[node] = e
            todo += [(child, e + 1) for child in self.children[node].values()]
        return frozenset(best.items())

    def _step(self, states: frozenset, c: str) -> frozenset:
        after: set[tuple[int, int]] = set()
        for node, e in states:
            after.add((node, e + 1))
            for letter, child in self.children[node].items():
                after.add((child, e if letter == c else e + 1))
        return self._closed(after)

    def _accepted(self, states: frozenset) -> tuple[str, int] | None:
        found = [(e, end[0]) for node, e in states if (end := self.ends[node]) and e <= end[1]]
        return (min(found)[1], min(found)[0]) if found else None

    def match(self, word: str) -> tuple[str, int] | None:
        """(term, edits) of the nearest term, or None."""
        states = self.start
        for c in word:
            key = (states, c)
            if key not in self.steps:
                self.steps[key] = self._step(states, c)
            states = self.steps[key]
            if not states:
                return None
            for node, e in states:
                if e == 0 and self.opens[node]:
                    return self.opens[node], 0
        if states not in self.accepts:
            self.accepts[states] = self._accepted(states)
        return self.accepts[states]


class Matches(dict):
    """What stands between spaces and ASCII marks (bytes) -> the hits (term, edits) in it, remembered."""

    def __init__(self, automaton: Automaton, harmless: frozenset[str]) -> None:
        super().__init__()
        self.automaton, self.harmless, self.spoken = automaton, harmless, Spoken()

    def __missing__(self, part: bytes) -> tuple[tuple[str, int], ...]:
        if len(self) > REMEMBERED:
            self.clear()
        found = ((w, self.automaton.match(w)) for w in self.spoken[part])
        hits = self[part] = tuple(m for w, m in found if m and not (m[1] and w in self.harmless))
        return hits


def _quoted(text: str) -> list[tuple[bool, str]]:
    """(stands in a quotation, word) of each word: an odd number of quotation marks before it
    on its line, a line that starts with ">", or reported speech within WINDOW words."""
    out: list[tuple[bool, str]] = []
    for line in text.split("\n"):
        marks = [m.start() for m in _MARKS.finditer(line)]
        cited = line.lstrip().startswith(">")
        k = 0
        for m in _WORD.finditer(line):
            while k < len(marks) and marks[k] < m.start():
                k += 1
            out.append((cited or k % 2 == 1 and len(marks) > 1, m[0].lower()))
    reported = [i for i, (_, w) in enumerate(out) if w in REPORTED]
    for i in reported:
        for j in range(max(0, i - WINDOW), min(len(out), i + WINDOW + 1)):
            out[j] = (True, out[j][1])
    return out


def features(text: bytes | None, matches: Matches, lex: Lexicon) -> list[float]:
    """The heaviest own hit, then logs of one plus the weights of own exact, own misspelled and
    quoted hits, and own hits a word."""
    words = letter_words(text)
    found = [m for hits in map(matches.__getitem__, words) if hits for m in hits]
    if not found:
        return [0.0] * FEATURES
    often = Counter(term for term, _ in found)
    most, own, near, quoted, n = 0.0, 0.0, 0.0, 0.0, 0
    for in_quote, w in _quoted(text.decode("utf-8", "replace")):
        hits = matches[w.encode()]
        if not hits or hits[0][0] in lex.twice and often[hits[0][0]] < 2:
            continue
        hit = hits[0]
        weight = lex.weights[hit[0]]
        if in_quote:
            quoted += weight
            continue
        n += 1
        if hit[1]:
            near += weight
        else:
            own, most = own + weight, max(most, weight)
    return [most, math.log1p(own), math.log1p(near), math.log1p(quoted), math.sqrt(n / len(words))]


def _one_of_copies(fit: DataFrame) -> DataFrame:
    """One row for each smallest hash of a row's word shingles: of copies and near copies few
    stay, so that words of a text that is copied often don't pass for frequent ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, PIECE):
            keys = []
            for text in utf8(b.column(0)):
                w = letter_words(text)
                shingles = zip(*(w[i:] for i in range(COPY_SHINGLE))) if len(w) >= COPY_SHINGLE else [w]
                keys.append(min(xxhash.xxh64_intdigest(b" ".join(x)) >> 1 for x in shingles))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(keys, pa.int64())], ["text", "y", "key"])

    keyed = fit.select("text", "y").mapInArrow(run, "text string, y double, key long")
    return stored(keyed.groupBy("key").agg(F.min(F.struct("text", "y")).alias("r")).select("r.*"))


def _documents_with(texts: DataFrame, among: frozenset[tuple[str, int]] | None = None) -> DataFrame:
    """term, kind (0: a word, k: a beginning of k words or more), n: documents of `texts` (text)
    that hold it; only terms in `among`, if given."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        spoken = Spoken()

        def table() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.int32()),
                 pa.array(list(counts.values()), pa.int64())], ["term", "kind", "n"])

        for b in pieces(batches, PIECE):
            for text in utf8(b.column(0)):
                words = spoken.words(text)
                starts = Counter(w[:n] for w in words for n in BEGINNINGS if len(w) >= n)
                terms = {(w, 0) for w in words}
                terms.update((s, 1) for s in starts)
                terms.update((s, 2) for s, often in starts.items() if often > 1)
                counts.update(terms if among is None else terms & among)
                if len(counts) > COUNTED:
                    yield table()
                    counts.clear()
        yield table()

    return texts.mapInArrow(run, "term string, kind int, n long").groupBy("term", "kind").agg(F.sum("n").alias("n"))


def lexicon(fit: DataFrame) -> Lexicon:
    """All sure terms of labelled rows, surest first.

    Terms of so many toxic documents that they could be sure are candidates, as many as the bounded
    number of labelled rows holds; then the other documents that hold them are counted. A word that an earlier
    beginning covers stays with its edits, as a hit of the beginning; a beginning that an earlier
    one covers is left out, and so is a beginning that is no surer than an earlier word of
    it. A term weighs the log of its odds over those of all labelled rows.
    """
    z2 = SURE ** 2
    least = math.ceil(LIKELY * z2 / (1 - LIKELY))
    toxic = {(r.term, r.kind): r.n for r in _documents_with(fit.where("y > 0").select("text")).where(F.col("n") >= least).collect()}
    harmless = {(r.term, r.kind): r.n for r in _documents_with(fit.where("y = 0").select("text"), frozenset(toxic)).collect()}
    share = fit.agg(F.avg("y")).first()[0]

    def low(key: tuple[str, int]) -> float:
        n = toxic[key] + harmless.get(key, 0)
        p = toxic[key] / n
        return (p + z2 / (2 * n) - SURE * math.sqrt(p * (1 - p) / n + z2 / (4 * n * n))) / (1 + z2 / n)

    sure = sorted((-round(low(k), 9), k[1], len(k[0]), k[0]) for k in toxic if low(k) >= LIKELY)
    out, said = Lexicon({}, {}, set()), {}
    for minus, kind, _, term in sure:
        covered = [term[:k] for k in BEGINNINGS if k <= len(term) and out.terms.get(term[:k], 0) is None]
        if covered and not kind:
            out.covered[term] = covered[0]
        if covered or kind and said.get(term, 0) >= -minus - 0.02:
            continue
        if term not in out.terms:
            out.terms[term] = None if kind else edits(term)
            odds = math.log((toxic[term, kind] + 0.5) / (harmless.get((term, kind), 0) + 0.5))
            out.weights[term] = max(0.1, odds - math.log(share / (1 - share)))
            out.twice.update({term} if kind == 2 else ())
        if not kind:
            for k in BEGINNINGS:
                said[term[:k]] = max(said.get(term[:k], 0), -minus)
    return out


def _scanned(rows: DataFrame, lex: Lexicon, harmless: frozenset[str]) -> DataFrame:
    """The columns of `rows` but text, which comes last, and `features`."""
    names = [c for c in rows.columns if c != "text"]
    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes if n != "text") + ", features array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matches = Matches(Automaton(lex.terms, lex.covered), harmless)
        for b in pieces(batches, PIECE):
            found = [features(t, matches, lex) for t in utf8(b.column(len(names)))]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(found, pa.list_(pa.float64()))], [*names, "features"])

    return rows.select(*names, "text").mapInArrow(run, schema)


def _harmless(fit: DataFrame, lex: Lexicon) -> frozenset[str]:
    """Words of harmless documents that are only a misspelling away from a term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matches = Matches(Automaton(lex.terms, lex.covered), frozenset())
        for b in pieces(batches, PIECE):
            parts = {p for t in utf8(b.column(0)) for p in set(letter_words(t)) if any(m[1] for m in matches[p])}
            near = {w for p in parts for w in matches.spoken[p] if (m := matches.automaton.match(w)) and m[1]}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(near), pa.string())], ["word"])

    return frozenset(r.word for r in fit.where("y = 0").select("text").mapInArrow(run, "word string").distinct().collect())


def scored(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """doc_id and score (0 to 1) of every row of `docs` (doc_id, text), learned from `labels`
    (doc_id, toxic).

    Null and empty texts score like texts without a hit. Without labels of both kinds there is
    no lexicon, and every score is the share of toxic labels (0 without any label). Repeated rows
    score alike. An empty table gives an empty result. Other columns are ignored.
    """
    fit = _one_of_copies(fit_rows(docs, labels, "toxic", rows))
    share = fit.agg(F.coalesce(F.avg((F.col("y") > 0).cast("double")), F.lit(0.0))).first()[0]
    everything = docs.select("doc_id", "text")
    if not 0 < share < 1:
        return everything.select("doc_id", F.lit(float(share)).alias("score"))
    lex = lexicon(fit)
    harmless = _harmless(fit, lex)
    known = stored(_scanned(fit, lex, harmless).select(array_to_vector("features").alias("features"), "y"))
    model = LogisticRegression(featuresCol="features", labelCol="y", regParam=1e-3, maxIter=50, standardization=False).fit(known)
    w, b = [float(x) for x in model.coefficients], float(model.intercept)
    logit = sum((F.lit(w[i]) * F.col("features")[i] for i in range(FEATURES)), F.lit(b))
    return _scanned(everything, lex, harmless).select("doc_id", (1 / (1 + F.exp(-logit))).alias("score"))
