"""Toxicity of texts by a weighted finite-state grammar over clauses.

Words become symbols (insult, threat, target, negation, report, restriction, other). Small
transducers are composed into one: the first marks what a negation reaches, the second what is
reported speech, the third what has a target before it in its clause. The composed machine reads
every clause that has an insult or threat in it from the left, and the third reads what it wrote
again from the right, for targets that come after. So each match gets one outcome; a text is scored
by its outcomes, not by single words.

Which words insult is learned: from labelled rows, words and word beginnings that mark toxic texts.
Weights of the outcomes are learned from the same rows by logistic regression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgertag.llm.storage import column, smallest, stage, text_slices
from ledgertag.llm.words import LETTERS, Words

THRESHOLD = 0.7
# Labelled rows to learn from: those with the smallest digest of their id, if there are more.
MAX_LABELLED = 200_000
MIN_LOG_ODDS = 4.0
MIN_PURITY = 0.97  # share of toxic texts among the labelled ones that have the term
STEMS = (3, 4, 5, 6)  # lengths of word beginnings in bytes

# Seeds of the word classes, in English, German, French and Spanish.
INSULTS = "idiot moron stupid loser scum trash worthless pathetic disgusting clown dumb imbecile"
THREATS = "kill hurt destroy töten umbringen frapper matar golpear"
TARGETS = (
    "you your yourself he him his she her they them their us me these those "
    "du dich dir dein ihr ihm ihn ihnen euch euer sie mich mir uns "
    "tu te toi ton vous vos votre lui leur eux moi "
    "tú ti tus usted ustedes vosotros ellos ellas"
)
NEGATIONS = "not never no isn aren don doesn nicht kein keine nie pas jamais ne nunca ni"
REPORTS = "said says wrote called quoted claimed sagte schrieb nannte dit écrit appelé dijo escribió"

# After a negation these take it back: "not only".
RESTRICTIONS = "only just merely nur bloß seulement solo sólo solamente"

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, RESTRICTION = range(7)
# Outcomes of a match, after the three transducers.
OUTCOMES = ("insult", "threat", "negated", "reported", "targeted insult", "targeted threat")
# Symbols between the transducers: matches that were marked.
NEGATED, REPORTED, TARGETED_INSULT, TARGETED_THREAT = range(7, 11)
OUTCOME_OF = {INSULT: 0, THREAT: 1, NEGATED: 2, REPORTED: 3, TARGETED_INSULT: 4, TARGETED_THREAT: 5}
CLAUSE_ENDS = b".!?;:\n"
REACH = 3  # words that a negation reaches
COUNTS = "_outcome_counts"


@dataclass
class Transducer:
    """Deterministic: (state, symbol) to (next state, symbol out). What isn't listed keeps both."""

    start: object
    moves: dict[tuple, tuple] = field(default_factory=dict)

    def step(self, state: object, symbol: int) -> tuple[object, int]:
        return self.moves.get((state, symbol), (state, symbol))


def compose(first: Transducer, second: Transducer, symbols: range) -> Transducer:
    """The machine that feeds what the first writes to the second; states are pairs."""
    start = (first.start, second.start)
    moves, todo, seen = {}, [start], {start}
    while todo:
        one, two = todo.pop()
        for symbol in symbols:
            one_next, middle = first.step(one, symbol)
            two_next, out = second.step(two, middle)
            state = (one_next, two_next)
            moves[(one, two), symbol] = (state, out)
            if state not in seen:
                seen.add(state)
                todo.append(state)
    return Transducer(start, moves)


def negation() -> Transducer:
    """State: how many more words the last negation reaches; a restriction right after it ends it."""
    moves = {}
    for left in range(REACH + 1):
        for symbol in range(7):
            after = max(left - 1, 0)
            out = NEGATED if left and symbol in (INSULT, THREAT) else symbol
            moves[left, symbol] = (REACH, symbol) if symbol == NEGATION else (after, out)
    moves[REACH, RESTRICTION] = (0, RESTRICTION)
    return Transducer(0, moves)


def reported() -> Transducer:
    """After a verb of saying, the rest of the clause is somebody else's."""
    return Transducer(
        False,
        {
            (False, REPORT): (True, REPORT),
            (True, INSULT): (True, REPORTED),
            (True, THREAT): (True, REPORTED),
        },
    )


def targeted() -> Transducer:
    """A match that is read after a target of its clause."""
    return Transducer(
        False,
        {
            (False, TARGET): (True, TARGET),
            (True, INSULT): (True, TARGETED_INSULT),
            (True, THREAT): (True, TARGETED_THREAT),
        },
    )


@dataclass
class Grammar:
    """``forward`` reads a clause from the left; ``backward`` reads what it wrote from the right."""

    forward: Transducer
    backward: Transducer

    def write(self, clause: list[int]) -> list[int]:
        for machine in (self.forward, self.backward):
            state, out = machine.start, []
            for symbol in clause:
                state, written = machine.step(state, symbol)
                out.append(written)
            clause = out[::-1]
        return clause


def grammar() -> Grammar:
    symbols = range(11)
    return Grammar(compose(compose(negation(), reported(), symbols), targeted(), symbols), targeted())


def outcomes(machine: Grammar, clause: list[int]) -> list[int]:
    """How often each outcome is written for the symbols of one clause."""
    counts = [0] * len(OUTCOMES)
    for out in machine.write(clause):
        if out in OUTCOME_OF:
            counts[OUTCOME_OF[out]] += 1
    return counts


def _word_hashes(text: str) -> np.ndarray:
    return Words(pa.array([text]), LETTERS, lower=True).hashes()


def seed_classes() -> dict[int, np.ndarray]:
    named = {
        INSULT: INSULTS,
        THREAT: THREATS,
        TARGET: TARGETS,
        NEGATION: NEGATIONS,
        REPORT: REPORTS,
        RESTRICTION: RESTRICTIONS,
    }
    return {kind: np.unique(_word_hashes(text)) for kind, text in named.items()}


def _features(words: Words) -> Iterator[tuple[int, np.ndarray]]:
    """Whole words (0) and beginnings of longer ones, as (length, hash of each word)."""
    yield 0, words.hashes()
    size = words.end - words.start
    for length in STEMS:
        # A word that is no longer than the beginning has none; zero is dropped later.
        yield length, np.where(size > length, words.hashes(first_bytes=length), np.uint64(0))


def _term_counts(texts: DataFrame) -> DataFrame:
    """In how many toxic and other texts each word or beginning occurs; summed within a batch."""
    schema = T.StructType([
        T.StructField("length", T.IntegerType()),
        T.StructField("term", T.LongType()),
        T.StructField("toxic", T.LongType()),
        T.StructField("other", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            label = column(batch, "toxic").to_numpy() == 1
            words = Words(column(batch, "text"), LETTERS, lower=True)
            row = words.row
            for length, found in _features(words):
                kept = found != 0
                pairs = np.unique(np.stack([row[kept].astype(np.uint64), found[kept]]), axis=1)
                terms, at = np.unique(pairs[1], return_inverse=True)
                toxic = np.bincount(at, label[pairs[0].astype(np.int64)], len(terms))
                total = np.bincount(at, minlength=len(terms))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(terms), length, np.int32)),
                        pa.array(terms.view(np.int64)),
                        pa.array(toxic.astype(np.int64)),
                        pa.array((total - toxic).astype(np.int64)),
                    ],
                    names=schema.names,
                )

    counts = texts.select("text", "toxic").mapInArrow(run, schema)
    return counts.groupBy("length", "term").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other")
    )


class Lexicon:
    """Word classes as sorted hashes, insults by whole word or by beginning.

    ``harmless`` holds the seeds that the labelled texts speak against.
    """

    def __init__(self, terms: dict[int, np.ndarray], harmless: np.ndarray) -> None:
        self.terms = terms
        self.seeds = seed_classes()
        for kind in (INSULT, THREAT):
            self.seeds[kind] = np.setdiff1d(self.seeds[kind], harmless)

    def symbols(self, words: Words) -> np.ndarray:
        """The symbol of each word."""
        out = np.zeros(len(words), np.int8)
        whole = words.hashes()
        for kind in (RESTRICTION, REPORT, NEGATION, TARGET, THREAT, INSULT):
            out[np.isin(whole, self.seeds[kind])] = kind
        for length, found in _features(words):
            known = self.terms.get(length)
            if known is not None and len(known):
                out[np.isin(found, known)] = INSULT
        return out


def text_outcomes(texts: pa.Array, lexicon: Lexicon, machine: Grammar) -> np.ndarray:
    """Counts of outcomes for each text, over its matched clauses."""
    words = Words(texts, LETTERS, lower=True)
    counts = np.zeros((len(texts), len(OUTCOMES)), np.int64)
    if not len(words):
        return counts
    symbol = lexicon.symbols(words)
    matched = np.flatnonzero((symbol == INSULT) | (symbol == THREAT))
    if not len(matched):
        return counts
    # A clause begins with a text and after each mark that ends one.
    ends = np.isin(words.data, np.frombuffer(CLAUSE_ENDS, np.uint8))
    before = np.concatenate([[0], np.cumsum(ends)])[words.start]
    begins = np.ones(len(words), bool)
    begins[1:] = before[1:] != before[:-1]
    begins[words.first[:-1][words.count > 0]] = True
    clause = np.cumsum(begins) - 1
    first = np.append(np.flatnonzero(begins), len(words))
    row = words.row
    for c in np.unique(clause[matched]).tolist():
        low, high = first[c], first[c + 1]
        counts[row[low]] += outcomes(machine, symbol[low:high].tolist())
    return counts


def training_rows(labels: DataFrame, chosen: Column, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``doc_id`` and ``toxic`` of at most ``max_labelled`` labelled rows, one for each id.

    If an id has several labels, the largest counts.
    """
    known = labels.where("toxic is not null and doc_id is not null").where(chosen)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return smallest(known, F.xxhash64("doc_id"), ["doc_id"], max_labelled)


@dataclass
class Model:
    terms: dict[int, np.ndarray]
    harmless: np.ndarray
    weights: np.ndarray  # the constant first, then by outcome

    def scores(self, counts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.weights[0] + np.log2(1 + counts) @ self.weights[1:])))


def _as_hashes(values: list[int]) -> np.ndarray:
    return np.sort(np.array(values, np.int64).view(np.uint64))


def _learn_terms(texts: DataFrame) -> tuple[dict[int, np.ndarray], np.ndarray]:
    """Terms that mark toxic texts, by length, and seeds that don't.

    A term needs log odds of MIN_LOG_ODDS, MIN_PURITY and more evidence than the luckiest of all terms would
    have by chance: a log likelihood ratio over the logarithm of their number.
    """
    counts = stage(_term_counts(texts), "terms")
    toxic, other = texts.agg(
        F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0)),
        F.sum(F.when(F.col("toxic") == 1, 0).otherwise(1)),
    ).first()
    nothing = np.zeros(0, np.uint64)
    if not toxic or not other:
        return {}, nothing
    share = toxic / (toxic + other)
    t, o = F.col("toxic"), F.col("other")
    odds = F.log((t + 0.5) / F.lit(float(toxic))) - F.log((o + 0.5) / F.lit(float(other)))
    own = (t + 0.5) / (t + o + 1)
    evidence = t * F.log(own / F.lit(share)) + o * F.log((1 - own) / F.lit(1 - share))
    measured = counts.select(
        "length",
        "term",
        odds.alias("odds"),
        evidence.alias("evidence"),
        (t / (t + o)).alias("purity"),
    )
    # All of them are kept: each needs several of the labelled texts, whose number is bounded.
    strong = measured.where((F.col("odds") >= MIN_LOG_ODDS) & (F.col("purity") >= MIN_PURITY))
    strong = strong.where(F.col("evidence") >= float(np.log(max(counts.count(), 1))))
    found: dict[int, list[int]] = {}
    for row in strong.toLocalIterator():
        found.setdefault(row["length"], []).append(row["term"])
    seeds = seed_classes()
    listed = np.concatenate([seeds[INSULT], seeds[THREAT]]).view(np.int64).tolist()
    against = measured.where(F.col("length") == 0).where(F.col("term").isin(listed))
    against = against.where(F.col("odds") < MIN_LOG_ODDS / 2)
    harmless = _as_hashes([row["term"] for row in against.toLocalIterator()])
    return {k: _as_hashes(v) for k, v in found.items()}, harmless


def _fit(table: list[tuple]) -> np.ndarray:
    """Logistic regression on counted rows (outcome counts, toxic, other), by Newton's method.

    A count n speaks with log2(1 + n): one match counts as one, and no number of them is cut off.
    """
    x = np.array([[1.0, *np.log2(1 + np.array(row[0]))] for row in table]).reshape(-1, len(OUTCOMES) + 1)
    toxic = np.array([float(row[1]) for row in table])
    total = toxic + np.array([float(row[2]) for row in table])
    # Without labels: one match is enough, unless it is negated or reported.
    prior = np.array([-3.0, 4.0, 4.0, 1.0, 1.0, 5.0, 5.0])
    strength = np.ones(1 + len(OUTCOMES))  # as much as a few labels, so these alone don't undo the prior
    w = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (toxic - total * p) - strength * (w - prior)
        curve = (x * (total * p * (1 - p))[:, None]).T @ x + np.diag(strength)
        step = np.linalg.solve(curve, slope)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    # A match never speaks for a text.
    w[1:] = np.maximum(w[1:], 0)
    return w


def _with_outcomes(
    docs: DataFrame, terms: dict[int, np.ndarray], harmless: np.ndarray, keep: list[str]
) -> DataFrame:
    schema = T.StructType([
        *(docs.schema[name] for name in keep),
        T.StructField(COUNTS, T.ArrayType(T.LongType())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, machine = Lexicon(terms, harmless), grammar()
        for batch in text_slices(batches, "text"):
            counts = text_outcomes(column(batch, "text"), lexicon, machine)
            yield pa.RecordBatch.from_arrays(
                [*(column(batch, name) for name in keep), pa.array(counts.tolist(), pa.list_(pa.int64()))],
                names=schema.names,
            )

    needed = list(dict.fromkeys([*keep, "text"]))
    return docs.select(*needed).mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, chosen: Column, max_labelled: int = MAX_LABELLED) -> Model:
    """Learn from the rows of ``labels`` for which ``chosen`` holds. Without any, seeds remain."""
    rows = training_rows(labels, chosen, max_labelled)
    # At most max_labelled rows of two numbers are sent to the executors.
    texts = docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id").select("text", "toxic")
    texts = stage(texts, "labelled")
    terms, harmless = _learn_terms(texts)
    toxic = F.when(F.col("toxic") == 1, 1).otherwise(0)
    # Most texts share a few counts, and there are no more rows than labelled texts.
    counted = (
        _with_outcomes(texts, terms, harmless, ["toxic"])
        .groupBy(COUNTS)
        .agg(F.sum(toxic).alias("toxic"), F.sum(1 - toxic).alias("other"))
    )
    return Model(terms, harmless, _fit([tuple(r) for r in counted.toLocalIterator()]))


def _score(model: Model) -> Column:
    total = F.lit(float(model.weights[0]))
    for k, weight in enumerate(model.weights[1:].tolist()):
        total = total + F.log2(1 + F.col(COUNTS)[k]) * F.lit(weight)
    return 1 / (1 + F.exp(-total))


def score(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score``, 0 to 1. Only the text is looked at.

    Null, empty and wordless texts get the score of a text without matches. Equal texts get equal
    scores. ``keep`` names the columns to keep, all by default; one named ``score`` is replaced.
    """
    keep = [name for name in (docs.columns if keep is None else keep) if name != "score"]
    found = _with_outcomes(docs, model.terms, model.harmless, keep)
    return found.select(*keep, _score(model).alias("score"))


def in_training(doc_id: Column) -> Column:
    """Rows that labels may be learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1


def clean_documents(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD
) -> DataFrame:
    """The rows that score below the threshold, with all their columns."""
    model = fit(docs, labels, in_training(F.col("doc_id")))
    found = _with_outcomes(docs, model.terms, model.harmless, docs.columns)
    return found.where(_score(model) < threshold).select(*docs.columns)
