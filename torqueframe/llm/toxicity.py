"""Toxicity by a weighted finite-state pattern grammar.

Four small transducers read the words of a clause: negation, reported speech,
target, and the insults and threats themselves. Their composition writes, for
every insult or threat, which of them hold over it ("insult/negated/aimed"),
and its term's weight is added to that output. So matched clauses are scored,
not isolated words. A logistic regression over the summed outputs, fitted by
Spark ML on labelled rows, turns them into a probability.

The terms are the listed ones and those that labelled rows show to go with
toxic texts: whole words and word beginnings (stems that take many endings).
Learning reads at most about ``max_rows`` labelled rows, chosen by a hash of
their id; several labels of one id count as toxic if one is.

Null and empty texts score like any text without a match. Long texts are read
whole. Without labelled rows, the listed terms and fixed weights are used.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

# fixed values: listed terms in English, German, French and Spanish
INSULTS = ("idiot moron stupid scum trash loser pathetic worthless disgusting clown dumb imbecile vermin "
           "dummkopf trottel abschaum arschloch widerlich versager crétin imbécile connard ordure minable "
           "idiota estúpido imbécil basura escoria asqueroso inútil").split()
THREATS = ("kill hurt destroy murder beat töten umbringen vernichten schlagen tuer frapper détruire "
           "matar destruir golpear").split()
TARGETS = ("you your he she they them him her his their these those du dich dir sie er ihr ihn euch "
           "tu toi vous il elle ils elles lui leur te tú usted ustedes él ella ellos ellas les").split()
NEGATIONS = ("not no never isn't aren't wasn't don't doesn't didn't without nicht kein keine keinen nie ohne "
             "pas non jamais sans nunca jamás sin").split()
REPORTS = ("said says say told wrote quoted called claimed sagte sagt schrieb nannte zitierte "
           "dit disait écrit appelé cité dijo dice escribió llamó citó").split()

CLASSES = {**{w: "report" for w in REPORTS}, **{w: "negation" for w in NEGATIONS}, **{w: "target" for w in TARGETS}}


@dataclass(frozen=True)
class Transducer:
    """Deterministic: (state, input) -> (state, output); a missing arc copies
    its input and follows ``other`` from the state."""
    arcs: dict
    other: dict = field(default_factory=dict)

    def step(self, state, symbol):
        if (state, symbol) in self.arcs:
            return self.arcs[state, symbol]
        return self.other.get(state, state), symbol


def compose(*machines: Transducer):
    """Feed each machine's output to the next; states are tuples."""
    def step(state, symbol):
        out = []
        for machine, s in zip(machines, state):
            s, symbol = machine.step(s, symbol)
            out.append(s)
        return tuple(out), symbol
    return step


HITS = ("insult", "threat")
# negation holds over the next three words
NEGATION = Transducer(
    {**{(s, "negation"): (3, "negation") for s in range(4)},
     **{(s, h): (s - 1, h + "/negated") for s in (1, 2, 3) for h in HITS}},
    {3: 2, 2: 1, 1: 0})
# a reporting verb holds to the clause's end, a quotation mark to the next one
REPORT = Transducer(
    {**{(s, "report"): ("said" if s == "plain" else s, "report") for s in ("plain", "said", "quoted")},
     ("plain", "quote"): ("quoted", "quote"), ("said", "quote"): ("quoted", "quote"),
     ("quoted", "quote"): ("plain", "quote"),
     **{(s, h + n): (s, h + n + "/reported") for s in ("said", "quoted") for h in HITS for n in ("", "/negated")}})
# a target before the hit; one after it is found by reading the clause backwards
TARGET = Transducer(
    {**{(s, "target"): ("aimed", "target") for s in ("open", "aimed")},
     **{("aimed", h + n + r): ("aimed", h + n + r + "/aimed")
        for h in HITS for n in ("", "/negated") for r in ("", "/reported")}})

GRAMMAR = compose(NEGATION, REPORT, TARGET)
START = (0, "plain", "open")
OUTPUTS = [h + n + r + a for h in HITS for n in ("", "/negated") for r in ("", "/reported") for a in ("", "/aimed")]
_AT = {o: i for i, o in enumerate(OUTPUTS)}

_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)?|[\"“”«»„]")
_ENDS = re.compile(r"[.!?;\n]")
_UNIT = re.compile(r"[^\W\d_]{3,}")
STEMS = (4, 5, 6, 7)


@dataclass
class Lexicon:
    words: dict[str, float]  # insults
    stems: dict[str, float]
    threats: dict[str, float]

    def find(self, word: str) -> tuple[str, float] | None:
        if word in self.words:
            return "insult", self.words[word]
        if word in self.threats:
            return "threat", self.threats[word]
        for n in STEMS:
            if len(word) >= n and word[:n] in self.stems:
                return "insult", self.stems[word[:n]]
        return None

    def automaton(self):
        import ahocorasick
        out = ahocorasick.Automaton()
        for w in (*self.words, *self.threats, *self.stems):
            out.add_word(w, len(w))
        if len(out):
            out.make_automaton()
        return out


def clause_outputs(clause: str, lexicon: Lexicon) -> list[tuple[str, float]]:
    """What the composed transducers write for a lower-cased clause."""
    words = _WORD.findall(clause)
    symbols, weights = [], []
    for w in words:
        hit = lexicon.find(w)
        weights.append(hit[1] if hit else 0.0)
        symbols.append(hit[0] if hit else CLASSES.get(w) or ("quote" if len(w) == 1 and not w.isalnum() else "word"))
    last = max((i for i, s in enumerate(symbols) if s == "target"), default=-1)
    state, out = START, []
    for i, (s, w) in enumerate(zip(symbols, weights)):
        state, o = GRAMMAR(state, s)
        if w:
            out.append((o if o.endswith("/aimed") or last < i else o + "/aimed", w))
    return out


def text_outputs(text: str, lexicon: Lexicon, automaton) -> np.ndarray:
    """Summed weights by output, over the clauses that hold a term."""
    sums = np.zeros(len(OUTPUTS))
    if not len(automaton):
        return sums
    text = text.lower()
    done = -1
    for at, n in automaton.iter(text):
        first = at - n + 1
        if first <= done or (first and text[first - 1].isalnum()):
            continue
        begin = max(text.rfind(c, 0, first) for c in ".!?;\n") + 1
        end = _ENDS.search(text, at)
        done = end.start() if end else len(text)
        for o, w in clause_outputs(text[begin:done], lexicon):
            sums[_AT[o]] += w
    return sums


@dataclass
class Model:
    lexicon: Lexicon
    coef: np.ndarray
    intercept: float


def _spread(sums: np.ndarray) -> np.ndarray:
    return np.log1p(sums)


def default_model() -> Model:
    coef = np.array([(0.3 if "/negated" in o else 0.5 if "/reported" in o else 1.5) + ("/aimed" in o) for o in OUTPUTS])
    return Model(Lexicon(dict.fromkeys(INSULTS, 3.0), {}, dict.fromkeys(THREATS, 1.0)), coef, -3.0)


def _units(train: DataFrame) -> DataFrame:
    """(kind, unit, pos, neg): rows of either label that have the word or stem."""
    def count(batches):
        for batch in batches:
            pos: Counter = Counter()
            neg: Counter = Counter()
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = set(_UNIT.findall((text or "").lower()))
                units = {("w", w) for w in words}
                units.update(("s", w[:n]) for n in STEMS for w in words if len(w) >= n)
                (pos if toxic else neg).update(units)
            # a unit of non-toxic rows alone is of no use, but its count is
            keys = list(pos.keys() | neg.keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                 pa.array([pos[k] for k in keys], pa.int64()), pa.array([neg[k] for k in keys], pa.int64())],
                names=["kind", "unit", "pos", "neg"])

    return train.select("text", "toxic").mapInArrow(count, "kind string, unit string, pos long, neg long").groupBy(
        "kind", "unit").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def _outputs_column(text: Column, lexicon: Lexicon) -> Column:
    @F.arrow_udf("array<double>")
    def outputs(t: pa.Array) -> pa.Array:
        machine = lexicon.automaton()
        rows = [_spread(text_outputs(x or "", lexicon, machine)) for x in t.to_pylist()]
        return pa.array([r.tolist() for r in rows], pa.list_(pa.float64()))
    return outputs(text)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", max_rows: int = 20_000, min_rows: int = 4, max_terms: int = 20_000,
        min_odds: float = 2.5, reg: float = 1e-3) -> Model:
    """Learn terms and weights from the rows of ``labels`` (id, 0/1) and their texts."""
    own = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(
        F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("toxic"))
    n = own.count()
    if not n:
        return default_model()
    part = F.pmod(F.xxhash64(F.col("_id").cast("string"), F.lit("toxicity sample")), F.lit(1 << 20))
    chosen = own.where(part < F.lit(int(min(1.0, max_rows / n) * (1 << 20)))).limit(2 * max_rows)
    # bounded by max_rows, so it may be broadcast
    train = written(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(
        F.broadcast(chosen), "_id").select("text", "toxic"), "toxicity-sample")
    totals = train.agg(F.sum("toxic").alias("pos"), F.count(F.lit(1)).alias("n")).first()
    pos, neg = totals["pos"] or 0, totals["n"] - (totals["pos"] or 0)
    model = default_model()
    if not pos or not neg:
        return model
    odds = (F.log((F.col("pos") + 0.5) / (F.lit(pos + 0.5) - F.col("pos")))
            - F.log((F.col("neg") + 0.5) / (F.lit(neg + 0.5) - F.col("neg"))))
    units = (_units(train).where((F.col("pos") >= min_rows) & (F.col("pos") >= F.col("neg")))
             .withColumn("odds", odds).where(F.col("odds") >= min_odds)
             .orderBy(F.desc("pos"), "kind", "unit").limit(max_terms).collect())
    words = {u["unit"]: u["odds"] for u in units if u["kind"] == "w"}
    stems = {u["unit"]: u["odds"] for u in units if u["kind"] == "s"}
    lexicon = Lexicon({**model.lexicon.words, **words}, stems, model.lexicon.threats)
    vectors = written(train.select(_outputs_column(F.col("text"), lexicon).alias("x"),
                                   F.col("toxic").cast("double").alias("label")), "toxicity-vectors")
    lr = LogisticRegression(regParam=reg, maxIter=60).fit(
        vectors.select(array_to_vector("x").alias("features"), "label"))
    return Model(lexicon, np.asarray(lr.coefficients.toArray()), float(lr.intercept))


def scored(text: Column, model: Model) -> Column:
    """The probability that a text is toxic."""
    @F.arrow_udf("double")
    def score(t: pa.Array) -> pa.Array:
        machine = model.lexicon.automaton()
        out = []
        for x in t.to_pylist():
            z = float(_spread(text_outputs(x or "", model.lexicon, machine)) @ model.coef) + model.intercept
            out.append(1 / (1 + math.exp(-max(-50.0, min(50.0, z)))))
        return pa.array(out, pa.float64())
    return score(F.coalesce(text, F.lit("")))
