"""Toxicity: a weighted finite-state pattern grammar over word classes, scoring matched clauses.

Training rows teach two kinds of words. Some stand in toxic texts almost only: such an insult is a match by itself, as the
labels have it, and a target nearby adds to it. Others, mostly beginnings of words, stand in other texts as well: such a
hint is a match only behind another insult or hint, so that the grammar and not the word decides.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import held_out, labelled_sample, prepare

#: Labelled training texts at most, of each class.
SAMPLE = {0: 4000, 1: 3000}
#: Words and word beginnings that the training rows may add to the lexicon at most, the toxic texts that must hold one,
#: their least share of all that do, and the accidental ones expected among all words tried.
LEXICON, LEAST_TOXIC, LEAST_SHARE, ACCIDENT = 4000, 3, 0.95, 1.0
#: Hints: their least share of toxic texts among those that hold one, and among those that hold two within SPAN tokens; words
#: and beginnings that are looked at, those with the most toxic texts first.
HINT_SHARE, RUN_SHARE, HINTS, SPAN = 0.3, 0.85, 2000, 48
#: Contrast rows made for each modifier from training rows that are not toxic.
CONTRAST = 40
#: Parts of the training rows: each one's matches come from a lexicon that the others teach.
PARTS = 3
PREFIXES = (4, 5, 6, 7)
#: Words of each class that need no training, in the languages of the corpus.
SEED_INSULTS = "idiot moron imbecile stupid scum trash pathetic worthless disgusting loser clown dumbass bastard vermin idioten trottel arschloch abschaum dumm crétin abruti ordure salaud débile imbécil estúpido basura escoria".split()
SEED_THREATS = "kill hurt destroy stab töten umbringen verletzen tuer frapper détruire matar golpear destruir".split()
TARGETS = "you your he she they them him her people du ihr sie euch er tu vous il elle ils elles vosotros tú usted ellos ella él ustedes".split()
NEGATIONS = "not never no nobody nicht kein keine niemals nie ne pas jamais aucun nunca ningún jamás".split()
REPORTS = "said says wrote quoted claimed reported sagte schrieb behauptete dit écrit déclara dijo escribió según".split()
SELVES = "i me myself ich mich je moi yo".split()
#: Words that an insult, a threat or a negation reaches.
REACH = 3
#: Classes up to HINT carry weight.
INSULT, THREAT, HINT, TARGET, NEGATION, REPORT, SELF, OTHER = CLASSES = range(8)
#: Output marks of the transducers: a match, and what modifies it.
HIT, PILED, AIMED, NEGATED, REPORTED, OWN, RUN = MARKS = (1, 2, 4, 8, 16, 32, 64)
#: Log-weight of each modifier before training, the sign that training may not turn, and how firmly it is held.
MODIFIERS, FIRMNESS = {PILED: 0.2, AIMED: 0.7, NEGATED: -1.5, REPORTED: -1.0, OWN: -1.5, RUN: 0.2}, 0.5
THRESHOLD = 0.7
TOKEN = re.compile(r"\w+|[.!?;\n]")
ENDS = frozenset(".!?;\n")
#: Cached words of one worker at most.
CACHE = 300_000


@dataclass
class Transducer:
    """Deterministic transducer that reads word classes and writes sets of marks: arcs[state][class] = (next state, marks)."""

    arcs: list[list[tuple[int, int]]] = field(default_factory=list)

    def compose(self, other: Transducer) -> Transducer:
        """Both read the same classes and write side by side: states are the reachable pairs, marks are joined."""
        names, todo, out = {(0, 0): 0}, [(0, 0)], []
        while todo:
            a, b = todo.pop(0)
            row = []
            for c in CLASSES:
                (na, ma), (nb, mb) = self.arcs[a][c], other.arcs[b][c]
                if (na, nb) not in names:
                    names[na, nb] = len(names)
                    todo.append((na, nb))
                row.append((names[na, nb], ma | mb))
            out.append(row)
        return Transducer(out)


def _machine(states: int, step) -> Transducer:
    return Transducer([[step(s, c) for c in CLASSES] for s in range(states)])


def grammar() -> Transducer:
    """insult, threat, target, negation, self and reported-speech transducers, composed. A clause starts in state 0.

    The insult machine matches an insult, marks one that follows another within REACH words as piled on it, and matches
    once more, as aimed, when a target comes within REACH words after one ("idiots like you"). The threat machine
    matches when a target comes within REACH words after a threat word: a threat word alone is no match. The target
    machine marks insults after a target in their clause as aimed, the negation machine matches within REACH words after
    a negation as negated (two words longer where a threat waits for its target), the self machine those within REACH
    words after the writer's own person, the report machine those after a verb of reported speech. Only marked matches
    carry weight.
    """
    far = REACH + 2
    insult = _machine(REACH + 1, lambda s, c: (REACH, HIT | (PILED if s else 0)) if c == INSULT else (0, HIT | AIMED) if c == TARGET and s else (max(0, s - 1), 0))
    threat = _machine(REACH + 1, lambda s, c: (REACH, 0) if c == THREAT else (0, HIT | AIMED) if c == TARGET and s else (max(0, s - 1), 0))
    target = _machine(2, lambda s, c: (1 if c == TARGET else s, AIMED if s and c in (INSULT, HINT) else 0))
    own = _machine(REACH + 1, lambda s, c: (REACH if c == SELF else 0 if c == TARGET else max(0, s - 1), OWN if s and c in (INSULT, HINT) else 0))
    negation = _machine(far + 1, lambda s, c: (far if c == NEGATION else max(0, s - 1), NEGATED if s > (0 if c == TARGET else 2) else 0))
    report = _machine(2, lambda s, c: (1 if c == REPORT else s, REPORTED if s else 0))
    return insult.compose(threat).compose(target).compose(negation).compose(own).compose(report)


def runs() -> Transducer:
    """The machine of runs: it counts down SPAN tokens, over the ends of clauses, from each insult or hint, and marks the next
    one within them; a hint is a match by this mark only. It runs beside the grammar: between two such words it does
    nothing but count, so its SPAN states are not multiplied with the grammar's but stepped over in one go.
    """
    return _machine(SPAN + 1, lambda s, c: (SPAN, (RUN | (HIT if c == HINT else 0)) if s else 0) if c in (INSULT, HINT) else (max(0, s - 1), 0))


class Lexicon(dict):
    """word -> (class, weight), or None for others; unseen words are looked up by their longest known beginning."""

    def __init__(self, words: dict[str, tuple[int, float]], starts: dict[str, tuple[int, float]]):
        self.words, self.starts = words, starts
        self.fixed = {w: (c, 0.0) for c, ws in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (SELF, SELVES)) for w in ws}
        super().__init__()

    def __missing__(self, word: str):
        out = self.fixed.get(word) or self.words.get(word)
        if out is None:
            for n in reversed(PREFIXES):
                if len(word) > n and word[:n] in self.starts:
                    out = self.starts[word[:n]]
                    break
        if len(self) > CACHE:
            self.clear()
        self[word] = out
        return out


def newton(a: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic weights of ``a`` (first column 1) with a small ridge; none but the first is negative."""
    free, w = list(range(a.shape[1])), np.zeros(a.shape[1])
    while True:
        w[:] = 0
        b, v, ridge = a[:, free], np.zeros(len(free)), np.diag([1e-6] + [1e-2] * (len(free) - 1))
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(b @ v, -30, 30)))
            v = v - np.linalg.solve((b * (p * (1 - p))[:, None]).T @ b + ridge + 1e-9 * np.eye(len(free)), b.T @ (p - y) + ridge @ v)
        w[free] = v
        low = [k for k in free[1:] if w[k] < 0]
        if not low:
            return w
        free = [k for k in free if k not in low]


class ToxicityModel:
    def __init__(self):
        self.grammar, self.runs = grammar().arcs, runs().arcs
        self.words = {w: (INSULT, 3.0) for w in SEED_INSULTS} | {w: (THREAT, 3.0) for w in SEED_THREATS}
        self.starts: dict[str, tuple[int, float]] = {}
        self.modifiers = dict(MODIFIERS)
        self.weights = np.array([-4.0, 1.0, 1.0])
        self.lexicon: Lexicon | None = None

    def __getstate__(self):
        return self.__dict__ | {"lexicon": None}

    def matches(self, text: str | None) -> list[list[tuple[float, int]]]:
        """For each clause with a match, its matches as (weight of the word, marks). Clauses end at ENDS."""
        if self.lexicon is None:
            self.lexicon = Lexicon(self.words, self.starts)
        tokens = TOKEN.findall((text or "").lower())
        classes = list(map(self.lexicon.__getitem__, tokens))
        out, done, run, heard = [], -1, 0, -1
        for i, c in enumerate(classes):
            if c is None or c[0] > HINT or i < done:
                continue
            at = i
            while at > 0 and tokens[at - 1] not in ENDS:
                at -= 1
            state, found, heavy = 0, [], 0.0
            while at < len(tokens) and tokens[at] not in ENDS:
                c, weight = classes[at] or (OTHER, 0.0)
                state, marks = self.grammar[state][c]
                if c <= HINT:
                    heavy = weight
                    run, more = self.runs[max(0, run - (at - heard - 1))][c]
                    marks, heard = marks | more, at
                if marks & HIT:
                    found.append((heavy, marks))
                at += 1
            done = at
            if found:
                out.append(found)
        return out

    def features(self, clauses: list[list[tuple[float, int]]]) -> list[float]:
        """Heaviest clause and log of the sum of all clauses' weights; a match weighs its word's evidence times its modifiers."""
        factor = [math.exp(sum(v for k, v in self.modifiers.items() if marks & k)) for marks in range(2 * MARKS[-1])]
        sums = [sum(w * factor[marks] for w, marks in found) for found in clauses]
        return [1.0, math.log1p(max(sums, default=0.0)), math.log1p(sum(sums))]

    def score(self, text: str | None) -> float:
        z = float(np.array(self.features(self.matches(text))) @ self.weights)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

    def fit(self, rows: list[tuple[str, int]]) -> ToxicityModel:
        """Lexicon from all rows; modifiers and clause weights by a logistic fit on matches that each row has under a
        lexicon learned without its own part, and on contrast rows. Without rows of both classes the built-in lexicon and
        weights stand."""
        y = np.array([y for _, y in rows], float)
        if len(rows) == 0 or y.min() == y.max():
            return self
        seeds, found = dict(self.words), [[] for _ in rows]
        for part in range(PARTS):
            self.words, self.starts = dict(seeds), {}
            self.learn([r for i, r in enumerate(rows) if i % PARTS != part])
            for i in range(part, len(rows), PARTS):
                found[i] = self.matches(rows[i][0])
        self.words, self.starts = dict(seeds), {}
        self.learn(rows)
        more = self.contrast([t for t, mark in rows if not mark])
        found, y = found + [self.matches(t) for t, _ in more], np.concatenate([y, [mark for _, mark in more]])

        def loss() -> float:
            a = np.array([self.features(f) for f in found])
            self.weights = newton(a, y)
            p = np.clip(1 / (1 + np.exp(-np.clip(a @ self.weights, -30, 30))), 1e-9, 1 - 1e-9)
            firm = sum((self.modifiers[k] - v) ** 2 for k, v in MODIFIERS.items())
            return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).sum() + FIRMNESS * firm)

        best = loss()
        for k, usual in MODIFIERS.items():  # one after the other, at a few strengths of the modifier's own sign
            for strength in (0.25, 0.5, 1.5, 2.0, 3.0):
                was, self.modifiers[k] = self.modifiers[k], usual * strength
                if (now := loss()) < best - 1e-9:
                    best = now
                else:
                    self.modifiers[k] = was
        loss()
        return self

    def learn(self, rows: list[tuple[str, int]]) -> None:
        """Add words and word beginnings whose texts are toxic too often for an accident, with smoothed log-odds as weight.

        A word whose occurrences are followed by a target within REACH words more often than not is a threat word. Of
        those whose share of toxic texts is too small for that, the ones become hints that stand twice within SPAN tokens
        in toxic texts almost only.
        """
        seen = {0: Counter(), 1: Counter()}
        texts = [([sys.intern(w) for w in TOKEN.findall(text.lower())], y) for text, y in rows]
        for tokens, y in texts:
            words = {w for w in tokens if len(w) > 2}
            seen[y].update(words)
            seen[y].update({w[:n] + "*" for w in words for n in PREFIXES if len(w) > n})
        n1, n0 = sum(y for _, y in rows), sum(1 - y for _, y in rows)
        tried = [w for w, k in seen[1].items() if k >= LEAST_TOXIC]
        rate, odds, unsure = n1 / (n1 + n0), {}, []

        def telling(k: int, m: int, least: float) -> bool:
            share = k / (k + m)
            # Chernoff's bound on the chance of k toxic texts or more among k + m
            bits = (k + m) * (share * math.log(share / rate) + (0 if share == 1 else (1 - share) * math.log((1 - share) / (1 - rate))))
            return share > max(least, rate) and bits > math.log(len(tried) / ACCIDENT)

        weight = lambda k, m: math.log((k + 0.5) / (n1 + 1)) - math.log((m + 0.5) / (n0 + 1))
        for w in tried:
            k, m = seen[1][w], seen[0][w]
            if telling(k, m, LEAST_SHARE):
                odds[w] = weight(k, m)
            elif telling(k, m, HINT_SHARE):
                unsure.append((k, len(w), w))
        doubtful = {w for _, _, w in sorted(unsure, reverse=True)[:HINTS]}
        twice = {0: Counter(), 1: Counter()}
        for tokens, y in texts:
            last, near = {}, set()
            for i, t in enumerate(tokens):
                for w in (t, *[t[:n] + "*" for n in PREFIXES if len(t) > n]):
                    if w in doubtful:
                        if i - last.get(w, -SPAN - 1) <= SPAN:
                            near.add(w)
                        last[w] = i
            twice[y].update(near)
        chosen = sorted(odds.items(), key=lambda x: (-x[1], x[0]))[:LEXICON]
        aimed, all_of = Counter(), Counter()
        plain = {w for w, _ in chosen if not w.endswith("*")}
        for tokens, y in texts:
            if y:
                for i, w in enumerate(tokens):
                    if w in plain:
                        all_of[w] += 1
                        aimed[w] += any(t in TARGETS for t in tokens[i + 1 : i + 1 + REACH])
        for w, value in chosen:
            if w.endswith("*"):
                self.starts[w[:-1]] = (INSULT, value)
            else:
                self.words[w] = (THREAT if w in SEED_THREATS or (w not in SEED_INSULTS and 2 * aimed[w] > all_of[w]) else INSULT, value)
        hints: dict[str, float] = {}
        for w in sorted(doubtful, key=lambda w: (len(w), w)):
            k, m = twice[1][w], twice[0][w]
            # a longer beginning, or a whole word, must say more than the shorter ones that hold it
            if k >= LEAST_TOXIC and telling(k, m, RUN_SHARE) and weight(k, m) > max((hints.get(w[:n] + "*", -math.inf) for n in PREFIXES if n < len(w.rstrip("*"))), default=-math.inf):
                hints[w] = weight(k, m)
        for w, value in hints.items():
            (self.starts if w.endswith("*") else self.words).setdefault(w.rstrip("*"), (HINT, value))
        self.lexicon = None

    def contrast(self, clean: list[str]) -> list[tuple[str, int]]:
        """Rows to tell modifiers by: one clause in front of a text that is not toxic, with an insult that is aimed (label 1),
        negated, reported or about the writer (label 0). The most telling insults, in turn."""
        insults = [w for w, (c, _) in sorted(self.words.items(), key=lambda x: (-x[1][1], x[0])) if c == INSULT]
        kinds = ((1, TARGETS), (0, NEGATIONS), (0, REPORTS), (0, SELVES))
        return [(f"{words[i % len(words)]} {insults[i % len(insults)]}. {t}", y) for y, words in kinds for i, t in enumerate(clean[:CONTRAST])]


def train(docs: DataFrame, labels: DataFrame, sample: dict[int, int] | None = None) -> ToxicityModel:
    """A model from a bounded sample of labelled rows outside the held-out fold (SAMPLE texts of each class at most)."""
    return ToxicityModel().fit(labelled_sample(docs, labels, "toxic", sample or SAMPLE))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``; only texts enter a score.

    Null and empty texts get the score of a text without matches; repeated rows get equal scores; an empty table gives
    an empty result; other columns are not looked at.
    """
    prepare(docs.sparkSession)
    # the lexicon holds LEXICON learned entries at most
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for batch in batches:
            score = np.array([model.score(t) for t in batch["text"]], float)
            yield batch[["doc_id", "held_out"]].assign(score=score, predicted=(score >= THRESHOLD).astype(np.int32))

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    schema = rows.drop("text").withColumns({"score": F.lit(0.0), "predicted": F.lit(0)}).schema
    return rows.mapInPandas(run, schema)
