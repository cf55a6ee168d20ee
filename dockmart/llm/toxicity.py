"""Toxicity from a weighted finite-state grammar over clauses.

A lexical transducer maps each word to a class (insult, threat, target, negation, report, quote mark, other) with a
weight. Three transducers read the class sequence of a clause and put a factor on each insult or threat:

* **negation**: within three words after a negator the factor is ``NEGATED``;
* **reported speech**: after a verb of saying, to the end of the clause, or between quote marks, it is ``REPORTED``;
* **target**: near a word for a person addressed or spoken of an insult counts ``TARGETED``, a threat counts in full;
  a threat without a target counts little.

They are composed into one automaton (states are tuples, weights multiply), built once. A clause scores the sum of
weight times factor; a document's features are its highest clause, the sum over clauses, the number of matched clauses
and its length, which a logistic regression turns into a calibrated score.

**What is learned.** Insult weights, from labelled rows only: log-odds of a word (or of a beginning of 4 to 8 letters,
which covers inflected and invented forms) between toxic and other documents, at the lower end of their error. A form must stand in several different
contexts (a 64-bit sketch of the words before it), so that copies of one document teach nothing. Fixed lists of
insults, threats, targets, negators and verbs of saying in four languages are the grammar's starting point.

**Bounds.** At most ``ROWS`` labelled rows of each class, in the order of a hash of the id; at most ``LEXICON`` learned
forms. Everything else covers all rows and whole texts.

Scale: the sample joins by a broadcast of bounded size, word statistics are combined before the shuffle, scoring is one
pass without a shuffle. A text is scanned once; the automaton runs only on texts with a matched word.

Edge cases: null and empty texts match nothing and get the score of no match. With one class only the score is the share
of toxic labels (0 without labels). Extra columns are ignored. Repeated rows score alike; an empty table gives an empty
result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockmart.llm.common import bounded_label_sample, class_counts, fit_logistic, logistic_score, sampled_texts, staged

ROWS = 8000
LEXICON = 20_000
#: A learned form weighs the lower end of its log-odds, ``Z`` standard errors down, and at least ``MIN_WEIGHT``.
Z, MIN_WEIGHT = 2.0, 1.5
MIN_DOCS = 3
MIN_CONTEXTS = 3
PREFIXES = (4, 5, 6, 7, 8)

NEGATED, REPORTED, TARGETED, THREAT_ALONE = 0.3, 0.4, 1.5, 0.25
SEED_WEIGHT, THREAT_WEIGHT = 2.0, 3.0
CACHE_WORDS = 300_000

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE = range(7)

INSULTS = (
    "idiot idiots moron morons stupid imbecile loser losers scum trash pathetic worthless disgusting dumb garbage vermin "
    "dummkopf idioten trottel abschaum widerlich "
    "imbécile crétin abruti ordure minable "
    "idiota imbécil estúpido estúpida basura escoria"
).split()
THREATS = (
    "kill hurt destroy stab shoot murder beat strangle "
    "töten umbringen vernichten verprügeln "
    "tuer détruire frapper "
    "matar destruir golpear"
).split()
TARGETS = (
    "you your yours yourself he she they them him her people "
    "du dich dir sie euch ihr "
    "tu toi te vous ils elles "
    "tú ti usted ustedes ellos ellas"
).split()
NEGATIONS = (
    "not never no isn't aren't wasn't don't doesn't "
    "nicht kein keine nie niemals "
    "pas jamais aucun "
    "nunca jamás ningún"
).split()
REPORTS = (
    "said says saying wrote writes called claimed quoted "
    "sagte sagt schrieb nannte "
    "dit disait écrit "
    "dijo dice escribió"
).split()

_TOKENS = re.compile(r"[^\W_]+(?:'[^\W_]+)*|[.!?;\n]+|[\"“”«»„]")
_END = re.compile(r"[.!?;\n]")


@dataclass(frozen=True)
class Transducer:
    """States 0..n-1 (0 is the start); ``step[state][symbol]`` is (next state, factor)."""

    step: tuple[tuple[tuple[int, float], ...], ...]

    def compose(self, other: Transducer) -> Transducer:
        """Both read the same symbols; states are the reachable pairs and factors multiply."""
        numbers = {(0, 0): 0}
        order, table = [(0, 0)], []
        for pair in order:
            row = []
            for (a, x), (b, y) in zip(self.step[pair[0]], other.step[pair[1]], strict=True):
                if (a, b) not in numbers:
                    numbers[a, b] = len(order)
                    order.append((a, b))
                row.append((numbers[a, b], x * y))
            table.append(tuple(row))
        return Transducer(tuple(table))


def _negation(scope: int = 3) -> Transducer:
    rows = []
    for left in range(scope + 1):
        factor = NEGATED if left else 1.0
        rows.append(tuple((scope if c == NEGATION else max(0, left - 1), factor if c in (INSULT, THREAT, TARGET) else 1.0) for c in range(7)))
    return Transducer(tuple(rows))


def _reported() -> Transducer:
    # 0 plain, 1 after a verb of saying, 2 between quote marks
    rows = []
    for state in range(3):
        row = []
        for c in range(7):
            after = (0 if state == 2 else 2) if c == QUOTE else 1 if c == REPORT and state == 0 else state
            row.append((after, REPORTED if state and c in (INSULT, THREAT, TARGET) else 1.0))
        rows.append(tuple(row))
    return Transducer(tuple(rows))


def _target(scope: int = 4) -> Transducer:
    """States: words left in which a target counts as near (0..scope), then words left for a threat to find its target."""
    rows = []
    for state in range(2 * scope + 1):
        near, threat = (state, 0) if state <= scope else (0, state - scope)
        row = []
        for c in range(7):
            if c == TARGET:
                row.append((scope, 1.0 if threat else 0.0))  # a target completes a waiting threat, else weighs nothing
            elif c == THREAT:
                row.append((max(0, near - 1), 1.0) if near else (2 * scope, THREAT_ALONE))
            else:
                after = max(0, near - 1) if not threat else (scope + threat - 1 if threat > 1 else 0)
                row.append((after, TARGETED if c == INSULT and near else 1.0))
        rows.append(tuple(row))
    return Transducer(tuple(rows))


GRAMMAR = _target().compose(_negation()).compose(_reported())
N_FEATURES = 5


@dataclass
class ToxicityModel:
    """The lexicon (form -> class and weight; a form ending in * is a beginning) and the calibration."""

    lexicon: dict[str, tuple[int, float]]
    calibration: dict | None = None
    prior: float = 0.0
    cache: dict[str, tuple[int, float]] = field(default_factory=dict, repr=False, compare=False)

    def look_up(self, word: str) -> tuple[int, float]:
        found = self.cache.get(word)
        if found is None:
            found = self.lexicon.get(word)
            for k in () if found else reversed(PREFIXES):
                if len(word) > k and (found := self.lexicon.get(word[:k] + "*")):
                    break
            found = found or (OTHER, 0.0)
            if len(self.cache) >= CACHE_WORDS:
                self.cache.clear()
            self.cache[word] = found
        return found

    def clauses(self, text: str) -> tuple[list[float], int]:
        """The scores of the matched clauses of a text, and its number of tokens."""
        tokens = _TOKENS.findall(text.lower())
        symbols = [self.look_up(t) for t in tokens]
        if not any(c == INSULT or c == THREAT for c, _ in symbols):
            return [], len(tokens)
        scores, state, total = [], 0, 0.0
        for token, (c, weight) in zip(tokens, symbols, strict=True):
            if c == OTHER and _END.match(token):
                if total > 0:
                    scores.append(total)
                state, total = 0, 0.0
                continue
            state, factor = GRAMMAR.step[state][c]
            total += weight * factor
        if total > 0:
            scores.append(total)
        return scores, len(tokens)

    def features(self, text: str | None) -> list[float]:
        scores, n = self.clauses(text or "")
        total = sum(scores)
        return [max(scores, default=0.0), math.log1p(total), math.log1p(len(scores)), math.log1p(n) if scores else 0.0, total / max(n, 20)]

    def scores(self, texts) -> np.ndarray:
        if self.calibration is None:
            return np.full(len(texts), self.prior)
        return logistic_score(self.calibration, np.array([self.features(t) for t in texts]).reshape(-1, N_FEATURES))


def seed_lexicon() -> dict[str, tuple[int, float]]:
    out: dict[str, tuple[int, float]] = {w: (TARGET, THREAT_WEIGHT * (1 - THREAT_ALONE)) for w in TARGETS}
    out |= {w: (NEGATION, 0.0) for w in NEGATIONS} | {w: (REPORT, 0.0) for w in REPORTS}
    out |= {w: (THREAT, THREAT_WEIGHT) for w in THREATS} | {w: (INSULT, SEED_WEIGHT) for w in INSULTS}
    return out | {c: (QUOTE, 0.0) for c in "\"“”«»„"}


_COUNTS = "form string, toxic long, other long, contexts long"


def _forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per batch and form: documents of either class that hold it, and a sketch of the words before it in toxic ones."""
    for batch in batches:
        counts: dict[str, list[int]] = {}
        for label, text in zip(batch["label"], batch["text"], strict=True):
            before, seen = "", set()
            for word in _TOKENS.findall((text or "").lower()):
                if not word[0].isalpha():
                    before = ""
                    continue
                for form in (word, *(word[:k] + "*" for k in PREFIXES if len(word) > k)):
                    row = counts.setdefault(form, [0, 0, 0])
                    if form not in seen:
                        seen.add(form)
                        row[0 if label else 1] += 1
                    if label:
                        row[2] |= 1 << (zlib.crc32(before.encode()) & 63)
                before = word
        rows = [(f, t, o, c - (1 << 64) if c >> 63 else c) for f, (t, o, c) in counts.items()]
        yield pd.DataFrame(rows, columns=["form", "toxic", "other", "contexts"]).astype({"contexts": "int64"})


def fit(docs: DataFrame, labels: DataFrame, eligible: Column, label: str = "toxic", rows: int = ROWS, seed: int = 7) -> ToxicityModel:
    """Learn from the rows of ``labels`` where ``eligible`` holds (the only labels that are read)."""
    n_clean, n_toxic = class_counts(labels, label, eligible)
    prior = n_toxic / (n_toxic + n_clean) if n_toxic + n_clean else 0.0
    lexicon = seed_lexicon()
    if not n_toxic or not n_clean:
        return ToxicityModel(lexicon, None, prior)
    ids = bounded_label_sample(labels, label, eligible, rows, seed)
    sample = staged(sampled_texts(docs, ids, "string"), "toxicity-sample")
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return ToxicityModel(lexicon, None, prior)
    summed = (
        sample.select("label", "text")
        .mapInPandas(_forms, _COUNTS)
        .groupBy("form")
        .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"), F.bit_or("contexts").alias("contexts"))
    )
    odds = F.log((F.col("toxic") + 0.5) / (sizes[1] + 1.0)) - F.log((F.col("other") + 0.5) / (sizes[0] + 1.0))
    odds = odds - Z * F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("other") + 0.5))
    strong = (F.col("toxic") >= MIN_DOCS) & (F.bit_count("contexts") >= MIN_CONTEXTS) & (odds >= MIN_WEIGHT)
    known = F.col("form").isin(INSULTS) & (F.col("toxic") + F.col("other") >= 5)
    chosen = (
        summed.withColumn("odds", odds)
        .filter(strong | known)
        .orderBy(F.col("toxic").desc(), F.col("odds").desc(), "form")
        .limit(LEXICON)
        .select("form", "odds")
        .collect()
    )
    for row in chosen:
        if lexicon.get(row["form"], (INSULT, 0))[0] == INSULT:
            lexicon[row["form"]] = (INSULT, max(0.0, float(row["odds"])))
    model = ToxicityModel(lexicon, None, prior)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "x": [model.features(t) for t in batch["text"]]})

    seen = sample.mapInPandas(measure, "doc_id long, label int, x array<double>").orderBy("doc_id").collect()
    y = np.array([r["label"] for r in seen], float)
    weight = np.where(y == 1, prior / max(y.mean(), 1e-9), (1 - prior) / max(1 - y.mean(), 1e-9))
    return ToxicityModel(lexicon, fit_logistic(np.array([r["x"] for r in seen]), y, weight), prior)


def scorer(model: ToxicityModel):
    """A column function: the toxicity score of a text column."""

    @F.pandas_udf("double")
    def toxicity(text: pd.Series) -> pd.Series:
        return pd.Series(model.scores([t if isinstance(t, str) else None for t in text]), dtype=float)

    return toxicity


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score) of every row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), scorer(model)(F.col("text").cast("string")).alias("score"))
