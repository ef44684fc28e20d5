"""Toxicity by a weighted finite-state grammar of abusive clauses.

A lexical transducer maps every word of a text to a symbol: insult, threat verb, person,
negation, report, quotation mark, clause end, or other. Insults have weights. Its entries
are the listed words and arcs learned from labelled documents: whole words and stems
(a prefix followed by any ending) that stand in more toxic documents than chance allows.
Five small transducers read the symbols: *insult* passes insults on, *threat* finds a
threat verb followed by a person, *target* marks insults beside a person, *negation* marks
what follows a negating word, *reported speech* marks what follows a reporting verb or
stands in quotation marks. Their product is built once, state by state; a text is one
walk through it. A matched clause scores the sum of its weights, each times a factor for
how it was matched (plain, at a target, negated, reported). The document's features are
made of its clauses' scores, never of single words, and a logistic function of them is
the result.

Learned are, from labelled rows outside the held-out fold alone: the arcs and their
weights, and the coefficients of the features, by maximum a posteriori around the
grammar's own values, so what no label shows keeps its listed weight. Fitting reads a
sample of at most about ``max_training_rows`` documents, chosen by a hash of the id; all
documents are scored. Text alone enters a score.

Null and empty texts score the intercept. Documents without a label, or with a null one,
are scored and not learned from; of several labels of an id the toxic one counts; a row
with a null id is scored and never held out. Repeated rows are scored each time. Without
any training row the listed grammar stands. An empty table gives no rows. Extra columns
are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import BATCH_ROWS, checkpointed, text_or_empty

# The listed part of the lexicon, in four languages.
INSULTS = (
    "idiot idiots moron morons imbecile imbeciles stupid dumb loser losers scum trash worthless pathetic clown "
    "clowns disgusting filth vermin bastard bastards "
    "idiotisch dummkopf trottel abschaum wertlos erbärmlich widerlich "
    "imbécile abruti abrutis ordure minable dégoûtant connard "
    "idiota idiotas imbécil estúpido estúpida basura escoria patético asqueroso"
).split()
THREATS = (
    "kill hurt destroy beat strangle burn shoot stab punish "
    "töten umbringen verletzen vernichten verprügeln "
    "tuer frapper détruire brûler "
    "matar golpear destruir quemar"
).split()
PERSONS = (
    "you your yours u he she him her they them these those people "
    "du dich dir euch ihr er sie ihn ihnen "
    "tu toi te vous ton il elle ils elles eux "
    "tú ti usted ustedes vosotros él ella ellos ellas"
).split()
NEGATIONS = (
    "not no never nobody isn't aren't wasn't weren't don't doesn't didn't won't can't cannot without "
    "nicht kein keine keinen niemals nie ohne "
    "ne pas jamais aucun aucune sans "
    "nunca jamás ningún ninguna sin"
).split()
REPORTS = (
    "said says say called calls calling wrote writes claimed claims quoted quote reported reports allegedly accused "
    "sagte sagt nannte schrieb behauptete "
    "dit disait appelé écrit prétend "
    "dijo dice llamó escribió"
).split()

OTHER, INSULT, THREAT, PERSON, NEGATION, REPORT, QUOTE, END = range(8)
SYMBOLS = 8
#: What a walk puts out at a symbol.
NOTHING, PLAIN, TARGETED, NEGATED, REPORTED, THREATENED, CLOSED = range(7)
_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[\"“”«»„.!?;:\n]")
_QUOTES, _ENDS = frozenset('"“”«»„'), frozenset(".!?;:\n")
FEATURES = ("intercept", "any", "second", "plain", "targeted", "negated", "reported", "threats", "top", "density")


@dataclass(frozen=True)
class ToxicityParams:
    #: Labelled documents that fitting reads, about; chosen by a hash of the id.
    max_training_rows: int = 10_000
    #: Fewest toxic documents of a learned arc, and its least likelihood ratio statistic.
    min_documents: int = 4
    min_evidence: float = 25.0
    #: Share of the strongest arc's evidence that makes an arc one whatever stands beside it.
    strong_share: float = 0.25
    stem_lengths: tuple[int, int] = (3, 8)
    #: Weight of a listed insult that no label speaks about, and the largest weight.
    listed_weight: float = 3.0
    max_weight: float = 6.0
    #: Words over which a negation or a person reaches.
    reach: int = 3
    threshold: float = 0.3
    #: The grammar's own coefficients, in the order of FEATURES, and how firmly they hold.
    prior: tuple[float, ...] = (-3.5, 1.0, 0.5, 0.5, 0.6, 0.05, 0.1, 1.5, 0.3, 0.5)
    prior_spread: float = 1.5
    #: Words that a Python worker remembers the symbols of.
    remembered: int = 200_000


def tokens(text: str) -> Iterator[str]:
    """Lower-cased words, quotation marks and clause ends of a text, one by one."""
    return (m[0] for m in _TOKEN.finditer(text.lower()))


# --- the grammar --------------------------------------------------------------


def _insult(state: int, symbol: int, reach: int) -> tuple[int, bool]:
    return 0, symbol == INSULT


def _threat(state: int, symbol: int, reach: int) -> tuple[int, bool]:
    """State: words left in which a person completes the threat."""
    if symbol == THREAT:
        return reach, False
    if symbol == PERSON and state:
        return 0, True
    return (0 if symbol == END else max(0, state - 1)), False


def _within(opener: int):
    """Marks insults and threats at most ``reach`` words after ``opener``."""

    def step(state: int, symbol: int, reach: int) -> tuple[int, bool]:
        if symbol == END:
            return 0, False
        if symbol == opener:
            return reach, state > 0
        return max(0, state - 1), state > 0

    return step


def _reported(state: int, symbol: int, reach: int) -> tuple[int, bool]:
    """State 1: a reporting verb stands earlier in the clause. State 2: inside quotation marks."""
    if symbol == QUOTE:
        return (0 if state == 2 else 2), False
    if state == 2:
        return 2, True
    if symbol == END:
        return 0, False
    return (1 if symbol == REPORT else state), state == 1


MACHINES = (_insult, _threat, _within(PERSON), _within(NEGATION), _reported)


def _output(symbol: int, insult: bool, threat: bool, target: bool, negated: bool, reported: bool) -> int:
    if symbol == END:
        return CLOSED
    if insult or threat:
        if reported:
            return REPORTED
        if negated:
            return NEGATED
        return THREATENED if threat else TARGETED if target else PLAIN
    return NOTHING


def compose(reach: int) -> tuple[list[list[int]], list[list[int]]]:
    """The product of the machines: next state and output by state and symbol.

    Only states that a text can reach are made. State 0 is the start.
    """
    numbers, order, following, outputs = {(0,) * len(MACHINES): 0}, [(0,) * len(MACHINES)], [], []
    for state in order:
        row, out = [], []
        for symbol in range(SYMBOLS):
            steps = [machine(part, symbol, reach) for machine, part in zip(MACHINES, state)]
            goal = tuple(s for s, _ in steps)
            if goal not in numbers:
                numbers[goal] = len(order)
                order.append(goal)
            row.append(numbers[goal])
            out.append(_output(symbol, *(mark for _, mark in steps)))
        following.append(row)
        outputs.append(out)
    return following, outputs


@dataclass
class Lexicon:
    """Word to symbol and weight. ``words`` and ``stems`` are learned arcs; a word's own arc goes first."""

    words: dict[str, float]
    stems: dict[str, float]
    params: ToxicityParams
    _known: dict[str, tuple[int, float]] = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        self._listed = {}
        for symbol, names in (
            (REPORT, REPORTS), (NEGATION, NEGATIONS), (PERSON, PERSONS), (THREAT, THREATS), (INSULT, INSULTS),
        ):
            self._listed.update({name: (symbol, self.params.listed_weight) for name in names})
        self._listed.update({mark: (QUOTE, 0.0) for mark in _QUOTES} | {mark: (END, 0.0) for mark in _ENDS})
        self._lengths = sorted({len(s) for s in self.stems}, reverse=True)

    def _look_up(self, word: str) -> tuple[int, float]:
        if word in self.words:
            return INSULT, self.words[word]
        if word in self._listed:
            return self._listed[word]
        for length in self._lengths:
            if len(word) >= length and word[:length] in self.stems:
                return INSULT, self.stems[word[:length]]
        return OTHER, 0.0

    def symbol(self, word: str) -> tuple[int, float]:
        got = self._known.get(word)
        if got is None:
            if len(self._known) >= self.params.remembered:
                self._known.clear()
            got = self._look_up(word.replace("’", "'"))
            if len(word) <= 64:
                self._known[word] = got
        return got


@dataclass
class Grammar:
    """The composed transducer with its lexicon: from a text to the features of its matched clauses."""

    lexicon: Lexicon
    reach: int

    def __post_init__(self) -> None:
        self.following, self.outputs = compose(self.reach)

    def features(self, text: str) -> list[float]:
        totals, clauses, matched, top, clause = [0.0] * 7, 0, 0, 0.0, 0.0
        state, words, symbol_of, listed = 0, 0, self.lexicon.symbol, self.lexicon.params.listed_weight
        following, outputs = self.following, self.outputs
        for word in tokens(text):
            symbol, weight = symbol_of(word)
            words += 1
            out = outputs[state][symbol]
            state = following[state][symbol]
            if out == CLOSED:
                clauses, top, clause = clauses + (clause > 0), max(top, clause), 0.0
            elif out:
                value = listed if out == THREATENED else weight
                totals[out] += value
                if out not in (NEGATED, REPORTED):
                    matched += 1
                    clause += value
        clauses, top = clauses + (clause > 0), max(top, clause)
        return [
            1.0,
            float(matched > 0),
            float(matched > 1),
            *[math.log1p(totals[o]) for o in (PLAIN, TARGETED, NEGATED, REPORTED, THREATENED)],
            math.log1p(top),
            min(1.0, 10.0 * matched / max(words, 10)) * float(matched > 1),
        ]


# --- learning -----------------------------------------------------------------


def held_out(doc_id: str | Column) -> Column:
    """The fold that nothing is learned from."""
    fold = F.pmod(F.crc32((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string").cast("binary")), F.lit(4))
    return F.coalesce(fold == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, params: ToxicityParams, id_column: str, text_column: str) -> DataFrame:
    """text and toxic of a sample of labelled documents outside the held-out fold.

    The sample depends on the id alone, so it is cut on both sides before they are joined.
    """
    usable = labels.where(F.col("toxic").isNotNull() & F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("bigint").alias("id"), F.col("toxic").cast("int").alias("toxic")
    )
    marked = usable.where(~held_out("id")).groupBy("id").agg(F.max("toxic").alias("toxic"))
    n = marked.count()
    if not n:
        return docs.sparkSession.createDataFrame([], "text string, toxic int")
    share = min(1.0, params.max_training_rows / n)

    def drawn(df: DataFrame) -> DataFrame:
        return df if share == 1.0 else df.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30)))

    texts = docs.select(F.col(id_column).cast("bigint").alias("id"), text_or_empty(text_column).alias("text"))
    return drawn(texts).join(drawn(marked), "id").select("text", "toxic")


def _arcs_of(text: str, shortest: int, longest: int) -> set[str]:
    """All arcs that a text would travel: its words, marked by a final blank, and their stems."""
    words = {w for w in tokens(text) if w not in _QUOTES and w not in _ENDS}
    arcs = {w[:n] for w in words for n in range(shortest, min(longest, len(w)) + 1)}
    return arcs.union([f"{w[:64]} " for w in words])


def _count_arcs(shortest: int, longest: int):
    schema = pa.schema([("arc", pa.string()), ("toxic", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[toxic == 1].update(_arcs_of(text, shortest, longest))
            if sum(map(len, counts)) > 400_000:
                yield from out(counts)
                for c in counts:
                    c.clear()
        yield from out(counts)

    def out(counts: tuple[Counter, Counter]) -> Iterator[pa.RecordBatch]:
        for toxic, c in enumerate(counts):
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), pa.string()), pa.array([toxic] * len(c), pa.int64()), pa.array(list(c.values()), pa.int64())],
                schema=schema,
            )

    return run


def _held_arcs(arcs: list[str], shortest: int, longest: int):
    schema = pa.schema([("toxic", pa.int32()), ("arcs", pa.list_(pa.int32()))])
    number = {arc: i for i, arc in enumerate(arcs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [sorted(number[a] for a in _arcs_of(t, shortest, longest) & number.keys()) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1).cast(pa.int32()), pa.array(held, schema[1].type)], schema=schema)

    return run


def evidence(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> tuple[np.ndarray, np.ndarray]:
    """Per arc the log odds of the class given it, and the likelihood ratio statistic for it."""
    odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    seen, total = toxic + clean, max(n_toxic + n_clean, 1)

    def part(count: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(count > 0, count * np.log(np.maximum(count, 1) / np.maximum(expected, 1e-300)), 0.0)

    statistic = 2 * sum(
        part(count, whole * share)
        for whole, inside in ((n_toxic, toxic), (n_clean, clean))
        for count, share in ((inside, seen / total), (whole - inside, 1 - seen / total))
    )
    return odds, statistic


def choose_arcs(
    arcs: list[str], held: list[np.ndarray], toxic: np.ndarray, params: ToxicityParams
) -> tuple[dict[str, float], dict[str, float]]:
    """Weights of words and stems, from the numbers of the arcs that each sampled document holds.

    First come arcs with at least ``strong_share`` of the strongest arc's evidence. Then, one
    by one, the arc with the most evidence among documents that hold none of the chosen
    arcs, so what stands beside an insult, or in copies of one toxic text, is not taken for
    one. Of a stem, its longer stems and their words only the strongest is chosen, of
    equals the most specific.
    """
    place = np.repeat(np.arange(len(held)), [len(h) for h in held])
    arc = np.concatenate(held) if held else np.zeros(0, int)
    lengths = np.asarray([len(a) for a in arcs], float)
    free, open_docs = np.ones(len(arcs), bool), np.ones(len(held), bool)
    words, stems = {}, {}

    def weighed() -> tuple[np.ndarray, np.ndarray]:
        use = open_docs[place]
        hit = toxic[place]
        seen = [np.bincount(arc[use & (hit == y)], minlength=len(arcs)) for y in (1, 0)]
        return evidence(*seen, int((toxic[open_docs] == 1).sum()), int((toxic[open_docs] == 0).sum()))

    def best(scores: np.ndarray) -> int:
        return int(np.lexsort((-lengths, -np.round(scores, 6)))[0])

    def choose(i: int) -> None:
        name, weight = arcs[i], float(np.clip(whole_odds[i], 0.0, params.max_weight))
        if name.endswith(" "):
            words[name[:-1]] = weight
        else:
            stems[name] = weight
        open_docs[place[arc == i]] = False
        for j, other in enumerate(arcs):
            if other.startswith(name) or name.startswith(other):
                free[j] = False

    if not arcs:
        return words, stems
    whole_odds, whole = weighed()
    least = max(params.min_evidence, params.strong_share * float(whole.max()))
    while free.any():
        scores = np.where(free & (whole_odds > 0), whole, -1.0)
        i = best(scores)
        if scores[i] < least:
            break
        choose(i)
    while free.any() and open_docs.any():
        odds, left = weighed()
        scores = np.where(free & (odds > 0), left, -1.0)
        i = best(scores)
        if scores[i] < params.min_evidence:
            break
        choose(i)
    return words, stems


def fit_coefficients(features: np.ndarray, toxic: np.ndarray, params: ToxicityParams) -> np.ndarray:
    """Logistic regression around the prior, by Newton's method."""
    prior = np.asarray(params.prior)
    firm = np.full(len(prior), 1.0 / params.prior_spread**2)
    firm[0] /= 100.0  # the base rate is the labels' alone
    beta = prior.copy()

    def loss(b: np.ndarray) -> float:
        z = features @ b
        return float(np.logaddexp(0.0, z).sum() - toxic @ z + 0.5 * (firm * (b - prior) ** 2).sum())

    for _ in range(100):
        p = 1.0 / (1.0 + np.exp(-np.clip(features @ beta, -40, 40)))
        gradient = features.T @ (p - toxic) + firm * (beta - prior)
        curve = (features.T * (p * (1 - p))) @ features + np.diag(firm)
        step, size, now = np.linalg.solve(curve, gradient), 1.0, loss(beta)
        while loss(beta - size * step) > now and size > 1e-8:
            size /= 2
        beta = beta - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    # more abuse never makes a text less toxic
    return np.where(np.arange(len(beta)) > 0, np.maximum(beta, 0.0), beta)


@dataclass(frozen=True)
class ToxicityModel:
    words: dict[str, float]
    stems: dict[str, float]
    coefficients: tuple[float, ...]
    params: ToxicityParams

    def grammar(self) -> Grammar:
        return Grammar(Lexicon(self.words, self.stems, self.params), self.params.reach)


def _featured(words: dict, stems: dict, params: ToxicityParams):
    schema = pa.schema([("toxic", pa.int32()), ("features", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(Lexicon(words, stems, params), params.reach)
        for batch in batches:
            made = [grammar.features(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1).cast(pa.int32()), pa.array(made, schema[1].type)], schema=schema)

    return run


def fit(
    docs: DataFrame,
    labels: DataFrame,
    params: ToxicityParams = ToxicityParams(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> ToxicityModel:
    """Arcs and coefficients from labelled documents; what the driver holds is bounded by the sample."""
    sample = checkpointed(training_rows(docs, labels, params, id_column, text_column))
    sizes = {bool(r["toxic"]): r["n"] for r in sample.groupBy((F.col("toxic") == 1).alias("toxic")).agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = sizes.get(True, 0), sizes.get(False, 0)
    if not n_toxic or not n_clean:
        return ToxicityModel({}, {}, params.prior, params)
    counted = sample.mapInArrow(_count_arcs(*params.stem_lengths), "arc string, toxic bigint, n bigint")
    by_class = counted.groupBy("arc").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("clean"),
    )
    # arcs that cannot pass stay where they are
    likely = by_class.where(
        (F.col("toxic") >= params.min_documents) & (F.col("toxic") * n_clean > F.col("clean") * n_toxic * 2)
    )
    arcs = sorted(r["arc"] for r in likely.select("arc").collect())
    found = sample.mapInArrow(_held_arcs(arcs, *params.stem_lengths), "toxic int, arcs array<int>").toArrow()
    hits = [np.asarray(a, int) for a in found.column("arcs").to_pylist()]
    words, stems = choose_arcs(arcs, hits, (found.column("toxic").to_numpy() == 1).astype(int), params)
    rows = sample.mapInArrow(_featured(words, stems, params), "toxic int, features array<double>").collect()
    rows.sort()
    features, toxic = np.asarray([r["features"] for r in rows]), np.asarray([float(r["toxic"] == 1) for r in rows])
    return ToxicityModel(words, stems, tuple(fit_coefficients(features, toxic, params).tolist()), params)


# --- scoring ------------------------------------------------------------------


def _score(model: ToxicityModel):
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar, coefficients = model.grammar(), np.asarray(model.coefficients)
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(start, BATCH_ROWS)
                features = np.asarray([grammar.features(t) for t in part.column(2).to_pylist()]).reshape(-1, len(FEATURES))
                scores = 1.0 / (1.0 + np.exp(-np.clip((features * coefficients).sum(axis=1), -40, 40)))
                predicted = (scores >= model.params.threshold).astype("<i4")
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(scores), pa.array(predicted)], schema=schema)

    return run


def score(docs: DataFrame, model: ToxicityModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    read = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"), held_out(id_column).alias("held_out"), text_or_empty(text_column).alias("text")
    )
    return read.mapInArrow(_score(model), "doc_id bigint, held_out boolean, score double, predicted int")
