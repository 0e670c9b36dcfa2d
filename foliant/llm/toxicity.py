"""Operator 2: toxicity by a weighted finite-state pattern grammar.

1. The lexicon is a transducer from words to symbols: INSULT and THREAT with a weight,
   TARGET, NEGATION, REPORT, and OTHER for all else. It knows whole words and word beginnings.
2. Three small automata read the symbols of a clause from left to right: how far back a
   target is, how many words a negation still governs, whether speech is reported. A fourth
   reads from right to left: how far ahead a target is. The first three are composed into one
   by the product construction; both directions together are a bimachine, which decides at
   every insult and threat by what is before it and what is behind it.
3. What it writes is a path: directed (an insult with a target up to five words before or
   two after, a threat with a target up to three words after) or bare, negated or not (a
   negation governs the three words after it), reported or not (what follows a verb of saying
   in its clause). Each of the eight kinds of path has a weight, which multiplies the term's.
   A bare path weighs nothing in the fixed grammar: words alone match nothing.
4. A document is scored by its matched clauses, the sum of their paths' weights, in
   total and per word, through a logistic function.

Labels teach, from a bounded sample: terms (words and beginnings of five to nine letters,
which stand for any longer word) that occur in toxic documents far more often than chance
allows, weighted by log odds; to which class a term belongs (a threat, if toxic documents
have a target after it more often than not; a fixed word keeps its class); further
negations and targets, from the words around hostile terms; the weights of the paths; the
logistic function. Whether a bare insult counts is thus a matter of evidence. Near copies
vote once. All documents are scored map-side.

Defined cases: null and empty texts match nothing and get the score of no match;
repeated rows are scored each, and learned as one row with the least text; labels other
than 0 and 1 are not learned, several labels of an id count as their greatest; without
labels of both kinds the fixed lists and weights decide; an empty table gives an empty
result; further columns of the input don't matter.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm._arrow import LOWER, NON_WORD, Block, HashIndex, blocks, hash_runs, runs
from foliant.llm.minhash import shingle_hashes
from foliant.llm.quality import labelled_sample, scored
from foliant.llm.shared import cut, discard

MAX_LABELLED = 10_000
#: Chance that a term of the lexicon is as lopsided by luck, at most.
LUCK = 1e-7

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
FIXED = {
    INSULT: "idiot idiots moron morons stupid dumb scum trash loser losers pathetic worthless disgusting clown fool imbecile vermin garbage idiota imbécil estúpido dummkopf abschaum idiotin crétin abruti".split(),
    THREAT: "kill hurt destroy strangle stab shoot burn töten umbringen tuer frapper matar golpear".split(),
    TARGET: "you your yours he she they him her them their these those du dich ihr sie tu vous toi ils usted tú ellos".split(),
    NEGATION: "not no never neither nor without isn't aren't nicht kein keine pas jamais nunca jamás".split(),
    REPORT: "said says claimed claims called wrote quoted reported according sagte schrieb dit écrit dijo escribió".split(),
}
#: Weight of a fixed hostile word before labels say more.
FIXED_WEIGHT = 3.0
BEFORE, AFTER_INSULT, AFTER_THREAT, SCOPE = 5, 2, 3, 3
#: Weights of the paths by (directed, negated, reported) before labels say more.
DIRECTED, NEGATED, REPORTED = 1.5, 0.1, 0.5
_CLAUSE = np.zeros(256, bool)
for _c in b".,;:!?\n\r()\"":
    _CLAUSE[_c] = True
_WORD = re.compile(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
PREFIX = range(5, 10)

Automaton = tuple[int, Callable[[int, int], int]]


def countdown(symbol: int, reach: int) -> Automaton:
    """States 0 to ``reach``: how many words after the last ``symbol`` are still within its reach."""
    return reach + 1, lambda state, read: reach if read == symbol else max(0, state - 1)


def latch(symbol: int) -> Automaton:
    """State 1 from the first ``symbol`` on."""
    return 2, lambda state, read: 1 if read == symbol else state


def compose(*parts: Automaton) -> tuple[np.ndarray, list[tuple[int, ...]]]:
    """The product of automata over one alphabet: its table (states x symbols), and what each state says of the parts."""
    states = list(product(*[range(n) for n, _ in parts]))
    place = {s: i for i, s in enumerate(states)}
    table = np.array([[place[tuple(step(s, a) for (_, step), s in zip(parts, state, strict=True))] for a in range(REPORT + 1)] for state in states])
    return table, states


LEFT, LEFT_STATES = compose(countdown(TARGET, BEFORE), countdown(NEGATION, SCOPE), latch(REPORT))
RIGHT, RIGHT_STATES = compose(countdown(TARGET, max(AFTER_INSULT, AFTER_THREAT)))
#: After so many other words nothing that counts words is left.
LONGEST_GAP = max(BEFORE, SCOPE, AFTER_INSULT, AFTER_THREAT)


def _paths() -> np.ndarray:
    """Kind of path by (left state, hostile symbol, right state): 4 * directed + 2 * negated + reported."""
    out = np.zeros((len(LEFT_STATES), 2, len(RIGHT_STATES)), np.int64)
    for (i, (before, negation, reported)), (j, (ahead,)) in product(enumerate(LEFT_STATES), enumerate(RIGHT_STATES)):
        gap = max(AFTER_INSULT, AFTER_THREAT) - ahead  # words up to the target, if there is one
        for kind, directed in ((0, before > 0 or (ahead > 0 and gap < AFTER_INSULT)), (1, ahead > 0 and gap < AFTER_THREAT)):
            out[i, kind, j] = 4 * directed + 2 * (negation > 0) + reported
    return out


PATHS = _paths()


def path_weights(bare: float = 0.0, negated: float = NEGATED, reported: float = REPORTED) -> np.ndarray:
    return np.array([(DIRECTED if k & 4 else bare) * (negated if k & 2 else 1.0) * (reported if k & 1 else 1.0) for k in range(8)])


def _run(table: np.ndarray, symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The state in front of every symbol, for many clauses at once, each from state 0."""
    out = np.zeros(len(symbols), np.int64)
    size = np.diff(bounds)
    order = np.argsort(-size, kind="stable")
    start, size = bounds[:-1][order], size[order]
    state = np.zeros(len(order), np.int64)
    for i in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -i, "left"))  # clauses with more than i symbols
        at = start[:n] + i
        out[at] = state[:n]
        state[:n] = table[state[:n], symbols[at]]
    return out


def bimachine(symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Kind of path at every hostile symbol of the clauses (symbols between ``bounds``), -1 elsewhere."""
    left = _run(LEFT, symbols, bounds)
    flipped = len(symbols) - bounds[::-1]
    right = _run(RIGHT, symbols[::-1], flipped)[::-1]
    hostile = (symbols == INSULT) | (symbols == THREAT)
    out = np.full(len(symbols), -1)
    out[hostile] = PATHS[left[hostile], symbols[hostile] - INSULT, right[hostile]]
    return out


@dataclass
class Grammar:
    """Whole words and word beginnings (bytes, lower case) with symbol and weight, the paths' weights, and the logistic function's."""

    words: dict[bytes, tuple[int, float]]
    prefixes: dict[bytes, tuple[int, float]] = field(default_factory=dict)
    paths: np.ndarray = field(default_factory=path_weights)
    logistic: tuple[float, ...] = (2.0, 0.0, -3.0)

    def __post_init__(self) -> None:
        self._tables = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_tables": None}

    def tables(self) -> list[tuple[int, HashIndex, np.ndarray, np.ndarray]]:
        if self._tables is None:
            groups: dict[int, dict[bytes, tuple[int, float]]] = {0: self.words}
            for p, v in self.prefixes.items():
                groups.setdefault(len(p), {})[p] = v
            self._tables = []
            for n, terms in groups.items():
                if terms:
                    size = np.array([len(t) for t in terms])
                    ends = np.cumsum(size)
                    keys = hash_runs(np.frombuffer(b"".join(terms), np.uint8), ends - size, ends)
                    order = np.argsort(keys)
                    v = list(terms.values())
                    self._tables.append((n, HashIndex(keys, 16), np.array([v[i][0] for i in order]), np.array([v[i][1] for i in order])))
        return self._tables

    def symbols(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The lexical transducer: (word, symbol, weight) of every word that isn't OTHER, in order, and all words' bounds.

        A word has one symbol: hostile before others, then the heavier one.
        """
        data = LOWER[block.data]
        starts, ends = runs(data, block.offsets, NON_WORD)
        at, symbol, weight = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        for n, index, kinds, weights in self.tables():
            where = np.flatnonzero(ends - starts > n) if n else np.arange(len(starts))
            if len(where):
                hit, place = index.find(hash_runs(data, starts[where], starts[where] + n if n else ends[where]))
                at.append(where[hit])
                symbol.append(kinds[place])
                weight.append(weights[place])
        at, symbol, weight = np.concatenate(at), np.concatenate(symbol), np.concatenate(weight)
        order = np.lexsort((-weight, symbol > THREAT, at))
        at, symbol, weight = at[order], symbol[order], weight[order]
        first = np.append(True, at[1:] != at[:-1])[: len(at)]
        return at[first], symbol[first], weight[first], starts, ends

    def matches(self, block: Block) -> np.ndarray:
        """Texts x 9: the weight of the terms on each kind of path, and the number of words."""
        out = np.zeros((len(block), 9))
        at, symbol, weight, starts, _ = self.symbols(block)
        bounds = np.searchsorted(starts, block.offsets)
        out[:, 8] = np.diff(bounds)
        text = np.searchsorted(bounds, at, "right") - 1
        hostile = np.zeros(len(block), bool)
        hostile[text[(symbol == INSULT) | (symbol == THREAT)]] = True
        keep = hostile[text]
        at, symbol, weight, text = (x[keep] for x in (at, symbol, weight, text))
        if not len(at):
            return out
        clause = np.searchsorted(np.flatnonzero(_CLAUSE[block.data]), starts[at])
        new = np.append(True, (clause[1:] != clause[:-1]) | (text[1:] != text[:-1]))
        gap = np.minimum(np.append(0, np.diff(at) - 1), LONGEST_GAP)
        gap[new] = 0
        place = np.cumsum(gap + 1) - 1
        stream = np.full(int(place[-1]) + 1, OTHER)
        stream[place] = symbol
        kinds = bimachine(stream, np.append(place[new], len(stream)))[place]
        on = kinds >= 0
        np.add.at(out, (text[on], kinds[on]), weight[on])
        return out

    def features(self, x: np.ndarray) -> np.ndarray:
        """(log of the matched weight, log of its share per word, 1) of texts, from ``matches``."""
        total = x[:, :8] @ self.paths
        return np.column_stack([np.log1p(total), np.log1p(100 * total / np.maximum(x[:, 8], 1)), np.ones(len(x))])

    def score(self, block: Block) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.features(self.matches(block)) @ np.array(self.logistic), -30, 30)))


def fixed_grammar() -> Grammar:
    return Grammar({w.encode(): (s, FIXED_WEIGHT if s <= THREAT else 0.0) for s, ws in FIXED.items() for w in ws})


def _terms(text: str) -> set[str]:
    """A text's words, and its word beginnings (marked by a final asterisk) of 5 to 9 letters."""
    found = set(_WORD.findall(text.lower()))
    return found | {w[:n] + "*" for w in found for n in PREFIX if len(w) > n}


def _lopsided(toxic: str, clean: str, rate: float) -> tuple:
    """(share of toxic, minus the log of Chernoff's bound on the chance of a share so far from ``rate``) as Columns."""
    a, b = F.col(toxic), F.col(clean)
    share = a / (a + b)
    part = lambda p, q: F.when(p > 0, p * F.log(p / q)).otherwise(0.0)
    return share, (a + b) * (part(share, rate) + part(1 - share, 1 - rate))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic", folds: int = 5, held: int = 0, max_labelled: int = MAX_LABELLED) -> Grammar:
    """The fixed grammar with what labelled rows that aren't held out teach."""

    def with_family(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(2)):
                values, bounds = shingle_hashes(block, 5)
                family = [int(values[a:b].min() >> np.uint64(1)) if b > a else 0 for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(k).slice(block.first, len(block)) for k in range(3)] + [pa.array(family, pa.int64())], ["id", "y", "text", "family"])

    sample = labelled_sample(docs, labels, label, folds, held, max_labelled, id_col, text_col)
    sample = cut(sample.select("id", "y", "text").mapInArrow(with_family, "id long, y int, text string, family long"))
    grammar = fixed_grammar()
    votes = sample.join(sample.groupBy("family", "y").agg(F.min("id").alias("id")), ["family", "y", "id"]).select("y", "text")
    total = {r["y"]: r["n"] for r in votes.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if total.get(0, 0) and total.get(1, 0):
        _learn_terms(grammar, votes, total)
        _learn_contexts(grammar, votes)
        _learn_weights(grammar, sample)
    discard(sample)
    return grammar


def _learn_terms(grammar: Grammar, votes: DataFrame, total: dict[int, int]) -> None:
    """Terms of toxic documents, with their log odds and their class. What comes back are terms of a bounded sample."""
    fixed = Grammar(dict(grammar.words))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        targets = {w.decode() for w, (s, _) in fixed.words.items() if s == TARGET}
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                df = (Counter(), Counter())
                ahead: Counter = Counter()
                for y, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    df[y].update(_terms(text or ""))
                    if y == 1:
                        found = _WORD.findall((text or "").lower())
                        threats: set[str] = set()
                        for i, w in enumerate(found):
                            if w in targets:
                                threats.update(*(_terms(x) for x in found[max(0, i - AFTER_THREAT) : i]))
                        ahead.update(threats)
                terms = list(df[1] | df[0])
                yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), *(pa.array([c[t] for t in terms], pa.int64()) for c in (df[1], df[0], ahead))], ["term", "toxic", "clean", "ahead"])

    share, evidence = _lopsided("toxic", "clean", total[1] / (total[0] + total[1]))
    odds = F.log((F.col("toxic") + 0.5) / (total[1] + 1)) - F.log((F.col("clean") + 0.5) / (total[0] + 1))
    terms = votes.mapInArrow(count, "term string, toxic long, clean long, ahead long").groupBy("term").agg(*[F.sum(c).alias(c) for c in ("toxic", "clean", "ahead")])
    chosen = terms.where((F.col("toxic") >= 3) & (share > 0.6) & (evidence > -math.log(LUCK))).select("term", odds.alias("weight"), "toxic", "ahead")
    taken: set[str] = set()
    for r in chosen.orderBy(F.desc("toxic"), F.desc("weight"), F.length("term"), "term").collect():  # the commonest first: a longer term inside a taken beginning adds nothing
        term = r["term"].rstrip("*")
        if any(term[:n] in taken for n in range(5, len(term) + 1)):
            continue
        known = [s for w, (s, _) in fixed.words.items() if s <= THREAT and w.startswith(term.encode())]
        symbol = known[0] if known else THREAT if 2 * r["ahead"] > r["toxic"] else INSULT
        if r["term"].endswith("*"):
            taken.add(term)
            grammar.prefixes[term.encode()] = (symbol, float(r["weight"]))
        elif grammar.words.get(term.encode(), (symbol,))[0] <= THREAT:  # targets, negations and reports stay what they are
            grammar.words[term.encode()] = (symbol, float(r["weight"]))
    grammar._tables = None


def _learn_contexts(grammar: Grammar, votes: DataFrame) -> None:
    """Words around hostile terms that tell clean documents from toxic ones: negations in front, targets on either side."""
    fixed = Grammar(dict(grammar.words), dict(grammar.prefixes))

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                at, symbol, _, starts, ends = fixed.symbols(block)
                at = at[(symbol == INSULT) | (symbol == THREAT)]
                bounds = np.searchsorted(starts, block.offsets)
                text = np.searchsorted(bounds, at, "right") - 1
                seen: set[tuple[int, str, bool]] = {(int(i), "", False) for i in text}
                for i, p in zip(text.tolist(), at.tolist(), strict=True):
                    for q in (*range(max(p - SCOPE, bounds[i]), p), *range(p + 1, min(p + 1 + AFTER_INSULT, bounds[i + 1]))):
                        seen.add((i, block.data[starts[q] : ends[q]].tobytes().decode("utf-8", "replace").lower(), q < p))
                rows = sorted(seen)
                y = batch.column(0).to_numpy()[block.first + np.array([r[0] for r in rows], np.int64)] if rows else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.bool_()), pa.array(y.astype(np.int64)), pa.array(1 - y.astype(np.int64))], ["word", "front", "toxic", "clean"])

    found = votes.mapInArrow(around, "word string, front boolean, toxic long, clean long").groupBy("word", "front").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    base = found.where("word = ''").first()
    if base is None or not base["toxic"] or not base["clean"]:
        return  # hostile terms are in documents of one kind only: their surroundings tell nothing
    rate = base["toxic"] / (base["toxic"] + base["clean"])
    share, evidence = _lopsided("toxic", "clean", rate)
    for r in found.where("word <> ''").where(evidence > -math.log(LUCK)).select("word", "front", (share < rate).alias("clean")).orderBy("word", "front").collect():
        word = r["word"].encode()
        if word not in grammar.words and (r["front"] or not r["clean"]):
            grammar.words[word] = (NEGATION if r["clean"] else TARGET, 0.0)
    grammar._tables = None


def _learn_weights(grammar: Grammar, sample: DataFrame) -> None:
    """The paths' weights and the logistic function: a path's weight leaves its fixed value only if the sample is likelier by a good deal."""
    fixed = Grammar(dict(grammar.words), dict(grammar.prefixes))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(2)):
                x = fixed.matches(block)
                yield pa.RecordBatch.from_arrays([batch.column(k).slice(block.first, len(block)) for k in (0, 1)] + [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), 9).cast(pa.list_(pa.float64()))], ["id", "y", "x"])

    rows = sample.select("id", "y", "text").mapInArrow(measure, "id long, y int, x array<double>").toPandas().sort_values("id", kind="stable")
    x, y = np.array(rows["x"].tolist(), float).reshape(-1, 9), rows["y"].to_numpy(float)

    def fitted(weights: dict[str, float]) -> tuple[float, tuple[float, ...]]:
        grammar.paths = path_weights(**weights)
        f = grammar.features(x)
        w = _logistic(f, y)
        z = f @ np.array(w)
        return float(-(np.logaddexp(0, z) - y * z).sum()), w

    best = {"bare": 0.0, "negated": NEGATED, "reported": REPORTED}
    likelihood, grammar.logistic = fitted(best)
    for name, values in (("bare", (0.25, 0.5, 1.0)), ("negated", (0.0, 0.5, 1.0)), ("reported", (0.0, 1.0))):
        for value in values:
            tried, w = fitted(best | {name: value})
            if tried > likelihood + 2:
                likelihood, best, grammar.logistic = tried, best | {name: value}, w
    grammar.paths = path_weights(**best)


def _logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-2, steps: int = 50) -> tuple[float, ...]:
    """Logistic regression by Newton steps; matches never lower a score."""
    w = np.array([1.0, 0.0, -2.0])
    ridge = l2 * np.diag([1.0, 1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge + 1e-6 * np.eye(3), x.T @ (y - p) - ridge @ w)
        w = w + step * min(1.0, 2 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    for k in (0, 1):
        if w[k] < 0:  # one coefficient less
            w[k] = 0.0
            rest = [i for i in range(3) if i != k]
            z = x[:, rest]
            for _ in range(steps):
                p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
                w[rest] += np.clip(np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag([l2, 1e-6]), z.T @ (y - p) - np.array([l2 * w[rest[0]], 0])), -2, 2)
            w[rest[0]] = max(0.0, w[rest[0]])
    return tuple(w.tolist())


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic", folds: int = 5, held: int = 0, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Every document with held_out, score (0 to 1) and predicted."""
    grammar = learn(docs, labels, id_col, text_col, label, folds, held, max_labelled)
    return scored(docs, grammar.score, id_col, text_col, folds, held)
