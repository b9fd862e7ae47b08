"""Toxicity scores from misspelled lexicon terms and the words around them.

The lexicon is learned from labelled texts: words, and beginnings of words, that stand in toxic texts
far more often than in others. Its trie is intersected with a Levenshtein automaton: a state is
the set of trie nodes that the letters read so far can lead to, each with the least number of
edits, so one walk over a word finds every term within its distance. States and steps are made
when they are first needed and kept in a table, along which all words of a block walk at once.

A word that clean texts use is no misspelling. Each hit is weighed by what is known of its term and by
its context: inside quotation marks or beside words that report speech it counts less, beside
words that address someone, an exclamation mark or another hit it counts more. A logistic
model over the hits of a text gives its score.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.scratch import stored
from tradewind.llm.text import BLOCK_BYTES
from tradewind.session import keep

# Labelled texts that a model is fitted on at most: those with the least hashes of their ids.
SAMPLE_ROWS = 20_000
# Terms of a lexicon at most, by evidence.
MOST_TERMS = 2_000
# Units that are looked at closer at most: those in most toxic texts.
MOST_UNITS = 100_000
# A term stands in so many toxic texts of the sample, and in this share of them, at least; it has
# this evidence (the logarithm of a likelihood ratio), and this share of its texts are toxic.
LEAST_TEXTS, LEAST_PART, LEAST_EVIDENCE, LEAST_SHARE = 4, 0.004, 12.0, 0.4
# Misspellings are looked for of terms of whose texts at least this share is toxic.
SURE_SHARE = 0.9
PREFIXES = range(4, 9)
# Words on either side of a hit that make up its context.
WINDOW = 8
# States of an automaton at most before it is built afresh.
MOST_STATES = 100_000
QUOTES = frozenset('"„“”«»')
# Words that report or mention speech, and words that address someone.
REPORTING = frozenset(
    "said says say called calls call wrote writes quote quoted quotes quoting word words term terms insult insults slur slurs "
    "phrase comment comments reported reports alleged sagte sagt nannte nennt schrieb wort wörter begriff zitat beleidigung "
    "dit appelle appelé écrit mot mots terme insulte citation dijo dice llamó llama escribió palabra palabras término insulto cita".split()
)
ADDRESS = frozenset(
    "you your you're youre u ur yourself du dich dir dein deine ihr euch euer tu te toi ton ta vous votre tú ti usted ustedes vosotros".split()
)
# What a context is taken to say before labels speak: quoted, reported, addressed, shouted, beside another hit.
CONTEXT = np.array([-3.0, -2.5, 1.0, 0.5, 0.5])
_CONTEXT_TRUST = 20.0  # as strong as so many labelled hits of even odds


def allowed_edits(term: str, prefix: bool) -> int:
    """Edits within which a word is taken for a misspelling of a term."""
    return 0 if prefix or len(term) < 5 else 1 if len(term) < 9 else 2


class Automaton:
    """All words within the allowed number of edits of any term, as a table of states.

    ``step[s, c]`` is the state after s and a letter of class c, -1 if it was never needed;
    class 0 is any letter that no term has. ``accepts[s]`` is (edits, term) of the nearest term
    if a word may end in s. State 0 is the start and 1 is dead.
    """

    def __init__(self, terms: Sequence[tuple[str, bool]], allowed: Sequence[int] | None = None):
        self.terms = list(terms)
        self.allowed = [allowed_edits(*t) for t in self.terms] if allowed is None else list(allowed)
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.reach = [0]
        for number, (term, _) in enumerate(self.terms):
            edits, node = self.allowed[number], 0
            self.reach[0] = max(self.reach[0], edits)
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.reach.append(0)
                node = self.children[node][letter]
                self.reach[node] = max(self.reach[node], edits)
            self.ends[node].append(number)
        self.letters = sorted({letter for term, _ in self.terms for letter in term})
        self.codes = np.array([ord(letter) for letter in self.letters], np.int64)
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.accepts: list[tuple[int, int] | None] = []
        self.step = np.full((64, len(self.letters) + 1), -1, np.int32)
        self._number(*self._closed({0: 0}, frozenset()))
        dead = self._number(frozenset(), frozenset())
        assert dead == 1 or not self.terms

    def _closed(self, nodes: dict[int, int], seen: frozenset) -> tuple[frozenset, frozenset]:
        """Add the nodes reached by leaving out letters of a term, and the beginnings met."""
        open_nodes = list(nodes.items())
        while open_nodes:
            node, edits = open_nodes.pop()
            if nodes.get(node) != edits:
                continue
            for child in self.children[node].values():
                if edits < self.reach[child] and nodes.get(child, edits + 2) > edits + 1:
                    nodes[child] = edits + 1
                    open_nodes.append((child, edits + 1))
        met = {(e, t) for n, e in nodes.items() for t in self.ends[n] if self.terms[t][1] and e <= self.allowed[t]}
        return frozenset(nodes.items()), frozenset([min(seen | met)]) if seen or met else seen

    def _number(self, nodes: frozenset, seen: frozenset) -> int:
        key = (nodes, seen)
        if key in self.numbers:
            return self.numbers[key]
        number = self.numbers[key] = len(self.states)
        ends = [(e, t) for n, e in nodes for t in self.ends[n] if e <= self.allowed[t]]
        self.states.append(key)
        self.accepts.append(min([*ends, *seen], default=None))
        if number >= len(self.step):
            self.step = np.concatenate([self.step, np.full_like(self.step, -1)])
        return number

    def _made(self, state: int, kind: int) -> int:
        nodes, seen = self.states[state]
        letter, after = self.letters[kind - 1] if kind else None, {}

        def reached(node: int, edits: int) -> None:
            if edits <= self.reach[node] and after.get(node, edits + 1) > edits:
                after[node] = edits

        for node, edits in nodes:
            reached(node, edits + 1)  # a letter too many
            for own, child in self.children[node].items():
                reached(child, edits + (own != letter))
        return self._number(*self._closed(after, seen))

    def walked(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The state after each word of ``text``, an array of code points."""
        if len(self.states) > MOST_STATES:
            self.forget()
        at = np.minimum(np.searchsorted(self.codes, text), max(0, len(self.codes) - 1))
        kinds = np.where(self.codes[at] == text, at + 1, 0) if len(self.codes) else np.zeros(len(text), np.int64)
        state = np.zeros(len(starts), np.int64)
        going, place = np.flatnonzero(ends > starts), 0
        while len(going):
            kind = kinds[starts[going] + place]
            after = self.step[state[going], kind]
            missing = np.unique(state[going][after < 0] * self.step.shape[1] + kind[after < 0])
            for key in missing.tolist():
                made = self._made(*divmod(key, self.step.shape[1]))
                self.step[divmod(key, self.step.shape[1])] = made
            after = self.step[state[going], kind] if len(missing) else after
            state[going] = after
            place += 1
            going = going[(after != 1) & (ends[going] - starts[going] > place)]
        return state


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point, whether it is white space, and whether it is a letter or digit."""
    every = [chr(i) for i in range(0x110000)]
    return np.array([c.isspace() for c in every]), np.array([c.isalnum() for c in every])


@dataclass
class Words:
    """The words of a block of texts: runs without white space, from their first letter or digit to
    their last. Texts are in lower case, one after the other, each followed by a line end."""

    text: str
    points: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # the first word of each text, and one more at the end

    def __getitem__(self, i: int) -> str:
        return self.text[self.starts[i] : self.ends[i]]


def words_of(texts: Iterable[str | None]) -> Words:
    lower = [(t or "").lower() for t in texts]
    text = "\n".join([*lower, ""])
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    space, letter = (table[points] for table in _letters())
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    run_start, run_end = edge[::2], edge[1::2]
    n = len(points)
    at = np.flatnonzero(letter)
    after = np.append(at, n)[np.searchsorted(at, run_start)]  # the first letter from there on
    before = np.concatenate([[-1], at])[np.searchsorted(at, run_end)] + 1
    real = after < run_end
    starts, ends = after[real], before[real]
    offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in lower])]).astype(np.int64)
    return Words(text, points, starts, ends, np.searchsorted(starts, offsets))


@dataclass(frozen=True)
class Hits:
    """Words of a block that a term accepts: which word, term, edits, text, and the context of each."""

    word: np.ndarray
    term: np.ndarray
    edits: np.ndarray
    row: np.ndarray
    context: np.ndarray


def _quoted(words: Words, word: np.ndarray) -> np.ndarray:
    """Whether an odd number of quotation marks of its line stands before a word, and one behind it."""
    marks = np.flatnonzero(np.isin(words.points, [ord(q) for q in QUOTES]))
    lines = np.flatnonzero(words.points == 10)
    at = words.starts[word]
    line = np.searchsorted(lines, at)
    begin = np.where(line > 0, lines[np.maximum(line - 1, 0)], 0)
    before = np.searchsorted(marks, at) - np.searchsorted(marks, begin)
    behind = np.searchsorted(marks, lines[line]) - np.searchsorted(marks, words.ends[word])
    return (before % 2 == 1) & (behind > 0)


def hits_of(words: Words, automaton: Automaton, harmless: frozenset[str]) -> Hits:
    """Words within the allowed edits of a term, with their contexts."""
    state = automaton.walked(words.points, words.starts, words.ends)
    nearest = np.array([-1 if a is None else a[0] * len(automaton.terms) + a[1] for a in automaton.accepts], np.int64)[state]
    word = np.flatnonzero(nearest >= 0)
    edits, term = nearest[word] // max(1, len(automaton.terms)), nearest[word] % max(1, len(automaton.terms))
    if len(word):
        real = np.array([e == 0 or words[i] not in harmless for i, e in zip(word.tolist(), edits.tolist(), strict=True)], bool)
        word, edits, term = word[real], edits[real], term[real]
    row = np.searchsorted(words.first, word, "right") - 1
    low = np.maximum(word - WINDOW, words.first[row]) if len(word) else word
    high = np.minimum(word + WINDOW + 1, words.first[row + 1]) if len(word) else word
    context = np.zeros((len(word), len(CONTEXT)))
    if len(word):
        context[:, 0] = _quoted(words, word)
        context[:, 4] = np.searchsorted(word, high) - np.searchsorted(word, low) > 1
        for k, (a, b) in enumerate(zip(low.tolist(), high.tolist(), strict=True)):
            near = {words[i] for i in range(a, b)}
            stop = words.starts[b] if b < words.first[row[k] + 1] else words.ends[b - 1] + 3
            context[k, 1] = not near.isdisjoint(REPORTING)
            context[k, 2] = not near.isdisjoint(ADDRESS)
            context[k, 3] = "!" in words.text[words.starts[a] : stop]
    return Hits(word, term, edits, row, context)


def fitted(x: np.ndarray, y: np.ndarray, prior: np.ndarray, trust: np.ndarray, offset: np.ndarray | float = 0.0) -> np.ndarray:
    """Weights of a logistic model that is held to ``prior`` by ``trust``, by Newton's method."""
    w = prior.astype(float).copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w + offset, -30, 30)))
        slope = x.T @ (p - y) + trust * (w - prior)
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(trust)
        step = np.linalg.solve(bend, slope)
        w -= step * min(1, 3 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return w


FEATURES = ("one", "any_hit", "strongest", "together", "kinds", "density")


@dataclass
class Model:
    """What a score is made of. ``odds[term, edits]`` is the log odds that a text with such a hit is toxic."""

    terms: list[tuple[str, bool]]
    allowed: list[int]
    odds: np.ndarray
    harmless: frozenset[str] = frozenset()
    context: np.ndarray = field(default_factory=CONTEXT.copy)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(FEATURES)))

    def features(self, words: Words, hits: Hits) -> np.ndarray:
        """A row for each text of a block."""
        n = len(words.first) - 1
        out = np.zeros((n, len(FEATURES)))
        out[:, 0] = 1
        strength = self.odds[hits.term, hits.edits] + hits.context @ self.context if len(hits.word) else np.zeros(0)
        chance = 1 / (1 + np.exp(-strength))
        strongest = np.full(n, -np.inf)
        np.maximum.at(strongest, hits.row, strength)
        # Each different word of a text once, at its strongest place.
        best: dict[tuple[int, str], float] = {}
        for i, row, c in zip(hits.word.tolist(), hits.row.tolist(), chance.tolist(), strict=True):
            key = (row, words[i])
            best[key] = max(best.get(key, 0.0), c)
        rows = np.array([row for row, _ in best], np.int64)
        once = np.array(list(best.values()))
        none = np.zeros(n)
        np.add.at(none, rows, np.log1p(-np.minimum(once, 1 - 1e-9)))
        any_hit = np.isfinite(strongest)
        out[:, 1] = any_hit
        out[any_hit, 2] = np.clip(strongest[any_hit], -6, 6)
        together = -np.expm1(none[any_hit])
        out[any_hit, 3] = np.clip(np.log(together) - none[any_hit], -6, 12)
        out[:, 4] = np.log1p(np.bincount(rows, once, n))
        out[:, 5] = np.log1p(100 * np.bincount(hits.row, chance, n) / np.maximum(1, np.diff(words.first)))
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))


def chosen_terms(units: list[tuple[str, bool, int, int]], toxic: int, clean: int) -> list[tuple[str, bool, int, int]]:
    """Terms of a lexicon from (unit, whether it is a beginning, toxic texts, clean texts with it).

    A beginning is taken instead of longer units if it holds clearly more toxic texts than the
    best of them; then it covers them.
    """

    def evidence(p: int, n: int) -> float:
        """How much likelier the counts are if the unit has a share of its own in toxic texts."""
        share, whole = (p + n) / (toxic + clean), 0.0
        for own, size in ((p, toxic), (n, clean)):
            for part, expected in ((own, share * size), (size - own, (1 - share) * size)):
                whole += part * float(np.log(part / expected)) if part else 0.0
        return whole

    ranked = [(evidence(p, n), not prefix, len(u), u, prefix, p, n) for u, prefix, p, n in units]
    least = max(LEAST_TEXTS, LEAST_PART * toxic)
    fit = [r for r in ranked if r[0] >= LEAST_EVIDENCE and r[5] >= least and r[5] >= LEAST_SHARE * (r[5] + r[6])]
    best_word: dict[str, int] = {}  # for each beginning, the most toxic texts that one fit word of it has
    for _, _, _, u, prefix, p, _ in fit:
        for k in range(1, (0 if prefix else len(u)) + 1):
            best_word[u[:k]] = max(best_word.get(u[:k], 0), p)
    taken: list[tuple[str, bool, int, int]] = []
    beginnings: set[str] = set()
    longer: dict[str, int] = {}  # the same for units that are taken
    for _, _, _, u, prefix, p, n in sorted(fit, key=lambda r: (-r[0], -r[1], -r[2], r[3])):
        if any(u[:k] in beginnings for k in range(1, len(u) + 1)):
            continue
        if prefix and p < 1.5 * max(best_word.get(u, 0), longer.get(u, 0)):
            continue
        taken.append((u, prefix, p, n))
        if prefix:
            beginnings.add(u)
        for k in range(1, len(u) + 1):
            longer[u[:k]] = max(longer.get(u[:k], 0), p)
    covered = lambda u, prefix: any(u[:k] in beginnings for k in range(1, len(u) + (not prefix)))
    return [t for t in taken if not covered(t[0], t[1])][:MOST_TERMS]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of batches with about BLOCK_BYTES of texts, the last column; texts stay whole."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(batch.num_columns - 1)).fill_null(0).to_numpy(zero_copy_only=False)
        filled, row = np.cumsum(lengths), 0
        while row < batch.num_rows:
            before = filled[row - 1] if row else 0
            last = max(row + 1, int(np.searchsorted(filled, before + BLOCK_BYTES, "right")))
            yield batch.slice(row, last - row)
            row = last


def _print(words: list[str]) -> int:
    """The least hash of three words in a row: the same for most near copies of a text."""
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    return min(zlib.crc32(r.encode()) for r in runs)


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _blocks(batches):
        words = words_of(batch.column(2).to_pylist())
        own = [[words[i] for i in range(a, b)] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
        prints = pa.array([_print(w) if w else None for w in own], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), prints], names=["row", "toxic", "print"])


def _units(batches: Iterator[pa.RecordBatch], asked: frozenset[tuple[str, bool]] | None) -> Iterator[pa.RecordBatch]:
    """In how many texts of a block each unit stands: words, and beginnings of longer words."""
    for batch in _blocks(batches):
        words, found = words_of(batch.column(0).to_pylist()), Counter()
        for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
            own = {words[i] for i in range(a, b)}
            units = {(w, False) for w in own}
            units.update((w[:k], True) for w in own for k in PREFIXES if len(w) > k)
            found.update(units if asked is None else units & asked)
        columns = [pa.array([u for u, _ in found], pa.string()), pa.array([p for _, p in found], pa.bool_()), pa.array(list(found.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["unit", "prefix", "n"])


def lexicon(sample: DataFrame) -> tuple[list[tuple[str, bool, int, int]], int, int]:
    """Terms with the toxic and clean texts that hold them, and the numbers of such texts.

    ``sample`` has row, toxic (0 or 1) and text. Of near copies one counts, since a text that was copied often
    would make terms of all its words. At most MOST_UNITS units come to the driver.
    """
    prints = keep(sample.select("row", "toxic", "text").mapInArrow(_prints, "row long, toxic int, print long"), "prints")
    first = prints.where("print is not null").groupBy("print").agg(F.min(F.struct("row", "toxic")).alias("first"))
    first = keep(first.select("first.row", "first.toxic"), "first-copies")
    sizes = first.agg(F.count_if(F.col("toxic") == 1).alias("p"), F.count_if(F.col("toxic") == 0).alias("n")).first()
    texts = sample.drop("toxic").join(first, "row")

    def counted(toxic: int, asked: frozenset | None) -> DataFrame:
        units = texts.where(F.col("toxic") == toxic).select("text").mapInArrow(partial(_units, asked=asked), "unit string, prefix boolean, n long")
        return units.groupBy("unit", "prefix").agg(F.sum("n").alias("n"))

    least = max(LEAST_TEXTS, LEAST_PART * sizes.p)
    often = counted(1, None).where(F.col("n") >= least).orderBy(F.desc("n"), "unit", "prefix").limit(MOST_UNITS).collect()
    in_toxic = {(r.unit, r.prefix): r.n for r in often}
    in_clean = {(r.unit, r.prefix): r.n for r in counted(0, frozenset(in_toxic)).collect()} if in_toxic else {}
    units = [(u, prefix, p, in_clean.get((u, prefix), 0)) for (u, prefix), p in in_toxic.items()]
    return chosen_terms(units, sizes.p, sizes.n), sizes.p, sizes.n


def _sample_hits(batches: Iterator[pa.RecordBatch], terms: list[tuple[str, bool]], allowed: list[int]) -> Iterator[pa.RecordBatch]:
    """(text number, toxic, number of words, and of each hit: word, term, edits, context)."""
    automaton = Automaton(terms, allowed)
    for batch in _blocks(batches):
        words = words_of(batch.column(2).to_pylist())
        hits = hits_of(words, automaton, frozenset())
        first = np.searchsorted(hits.row, np.arange(batch.num_rows + 1))
        listed = lambda v, kind: pa.ListArray.from_arrays(first.astype(np.int32), pa.array(v, kind))  # noqa: E731,B023
        columns = [batch.column(0), batch.column(1), pa.array(np.diff(words.first), pa.int64())]
        columns += [listed([words[i] for i in hits.word.tolist()], pa.string()), listed(hits.term, pa.int64())]
        columns += [listed(hits.edits, pa.int64()), listed(hits.context @ (1 << np.arange(len(CONTEXT))), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["row", "toxic", "n", "word", "term", "edits", "context"])


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Fit lexicon, weights of contexts and score on texts of ``docs`` (doc_id, text) with labels.

    ``labels`` has doc_id and label, 0 or 1; labels of one id are averaged, ids or labels that are
    null are left out, and the ``rows`` ids with the least hashes are taken. Texts without words
    teach nothing. Without a toxic text no term is known, and all scores are near the share of toxic texts.
    """
    known = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.avg("label").alias("label"))
    known = known.select("doc_id", (F.col("label") >= 0.5).cast("int").alias("toxic"))
    drawn = keep(known.orderBy(F.xxhash64("doc_id", F.lit("toxic")), "doc_id").limit(rows), "labels")
    sample = docs.select("doc_id", "text").where("text is not null").join(drawn, "doc_id").select("toxic", "text")
    sample, _ = stored(sample.select(F.monotonically_increasing_id().alias("row"), "toxic", "text"), "toxic-sample")
    found, toxic, clean = lexicon(sample)
    terms = [(u, prefix) for u, prefix, _, _ in found]
    allowed = [allowed_edits(u, prefix) if p >= SURE_SHARE * (p + n) else 0 for u, prefix, p, n in found]
    fields = "row long, toxic int, n long, word array<string>, term array<long>, edits array<long>, context array<long>"
    met = sample.mapInArrow(partial(_sample_hits, terms=terms, allowed=allowed), fields).toArrow().sort_by("row").to_pylist()
    base = np.log((toxic + 0.5) / (clean + 0.5))

    # Misspellings that clean texts use, unless they are a small part of what toxic texts have of them.
    uses: dict[str, list[int]] = {}
    for r in met:
        for w in {w for w, e in zip(r["word"], r["edits"], strict=True) if e}:
            uses.setdefault(w, [0, 0])[r["toxic"]] += 1
    harmless = frozenset(w for w, (n, p) in uses.items() if n and p <= 3 * n)
    most = max([1, *allowed])
    odds = np.zeros((len(terms), most + 1))
    tally: Counter = Counter()
    for r in met:
        own = {(t, e) for w, t, e in zip(r["word"], r["term"], r["edits"], strict=True) if e and w not in harmless}
        tally.update((t, e, r["toxic"]) for t, e in own)
    for i, (_, _, p, n) in enumerate(found):
        odds[i, 0] = np.log((p + 0.5) / (n + 0.5))
        for e in range(1, most + 1):  # as likely as the term itself, less for each edit, until texts speak
            before = 1 / (1 + np.exp(1.5 * e - odds[i, 0]))
            p, n = tally[i, e, 1] + 4 * before, tally[i, e, 0] + 4 * (1 - before)
            odds[i, e] = np.log(p / n)
    model = Model(terms, allowed, odds, harmless)

    flat = [
        (r["toxic"], odds[t, e], c)
        for r in met
        for w, t, e, c in zip(r["word"], r["term"], r["edits"], r["context"], strict=True)
        if not e or w not in harmless
    ]
    if flat:
        y, offset, bits = (np.array(v) for v in zip(*flat, strict=True))
        seen = ((bits[:, None] >> np.arange(len(CONTEXT))) & 1).astype(float)
        # A text with many hits says no more than one with a single hit.
        model.context = fitted(seen, y.astype(float), CONTEXT, np.full(len(CONTEXT), _CONTEXT_TRUST), offset)
    x, y = _sample_features(met, model), np.array([r["toxic"] for r in met if r["n"]], float)
    start = np.zeros(len(FEATURES))
    start[0] = base
    trust = np.full(len(FEATURES), 1.0)
    model.weights = fitted(x, y, start, trust) if len(y) else start
    return model


def _sample_features(met: list[dict], model: Model) -> np.ndarray:
    """Features of the sample's texts from the hits that were gathered."""
    out = []
    for r in met:
        if not r["n"]:
            continue
        real = [k for k, (w, e) in enumerate(zip(r["word"], r["edits"], strict=True)) if not e or w not in model.harmless]
        listed = [r["word"][k] for k in real]
        text = " ".join(listed)
        ends = np.cumsum([len(w) + 1 for w in listed], dtype=np.int64) - 1 if listed else np.zeros(0, np.int64)
        starts = ends - np.array([len(w) for w in listed], np.int64)
        words = Words(text, np.zeros(0, np.int64), starts, ends, np.array([0, r["n"]]))
        bits = np.array([r["context"][k] for k in real], np.int64)
        context = ((bits[:, None] >> np.arange(len(CONTEXT))) & 1).astype(float)
        numbers = [np.array([r[c][k] for k in real], np.int64) for c in ("term", "edits")]
        hits = Hits(np.arange(len(real)), *numbers, np.zeros(len(real), np.int64), context)
        out.append(model.features(words, hits)[0])
    return np.array(out).reshape(len(out), len(FEATURES))


def _scored(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    automaton = Automaton(model.terms, model.allowed)
    for batch in _blocks(batches):
        words = words_of(batch.column(batch.num_columns - 1).to_pylist())
        hits = hits_of(words, automaton, model.harmless)
        score = model.scores(model.features(words, hits))
        first = np.searchsorted(hits.row, np.arange(batch.num_rows + 1)).astype(np.int32)
        named = [model.terms[t][0] + "*" * model.terms[t][1] for t in hits.term.tolist()]
        begin = words.starts[hits.word] - np.concatenate([[0], np.cumsum([len(t or "") + 1 for t in _lower(batch)])])[hits.row]
        spans = pa.StructArray.from_arrays(
            [
                pa.array(begin, pa.int64()),
                pa.array([words[i] for i in hits.word.tolist()], pa.string()),
                pa.array(named, pa.string()),
                pa.array(hits.edits, pa.int32()),
                pa.array(hits.context @ model.context, pa.float64()),
            ],
            names=["start", "word", "term", "edits", "context"],
        )
        kept = [batch.column(i) for i in range(batch.num_columns - 1)]
        columns = [*kept, pa.array(score, pa.float64()), pa.ListArray.from_arrays(first, spans)]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "score", "hits"])


def _lower(batch: pa.RecordBatch) -> list[str]:
    return [(t or "").lower() for t in batch.column(batch.num_columns - 1).to_pylist()]


def scored(docs: DataFrame, model: Model, ids: list[str]) -> DataFrame:
    """``ids``, the score of each text from 0 to 1, and its hits.

    A hit has the place of the word in the lower-case text, the word, the term it is taken for (`*`
    marks a beginning), the edits between them, and what its context adds to its log odds. A
    null or empty text has no hits and the score that such texts have.
    """
    rows = docs.select(*ids, "text")
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    hit = "struct<start: long, word: string, term: string, edits: int, context: double>"
    return rows.mapInArrow(partial(_scored, model=model), f"{fields}score double, hits array<{hit}>")
