"""Toxicity by a weighted finite-state pattern grammar.

A text's words become symbols. A transducer over characters knows stems with the
endings that they take, and gives a form its symbol: THREAT (infinitives and first
persons), TOLD (other forms of such verbs), AIMED (with its object in the word), YOU
and ADDRESSED (second persons, as they stand alone and beside verbs), TARGET and
OBJECT (third ones), CLITIC, NEGATION, REPORT; induced insults are INSULT, the rest
OTHER. Punctuation and line ends part clauses. Five more transducers, written as
tables of arcs (state and input to output, weight and next state), read the symbols
of a clause in turn, each the output of the one before:

* reported speech: an insult or threat after a verb of saying is a quotation;
* negation: one shortly after a negation is taken back;
* threat: a threat word with somebody threatened within a few words, on either side;
  what is told of others (``it killed people``) is none, but told of who is addressed it is;
* target: an addressee beside the insult makes it an attack;
* insult: an insult that is left is affirmed, more than one repeated.

They are composed once to one transducer, which runs over each clause; the words'
one is composed with it as texts are read, a word at a time and remembered. A weight
is a vector of events, which add up along a path. A logistic regression fitted to
labelled rows gives each event its part in the score: so isolated words never
score alone, but matched clauses by the weights of their paths.

The threat, target, negation and report words are fixed lists; insults are induced
from labelled texts, as whole words or as stems: strings that labelled-toxic
texts use in many different contexts and clean texts (almost) never.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_small_batches, discard, fold_of, materialise, returning_memory, without_nulls

# Word lists of the grammar (English, German, French, Spanish). Forms by symbol: an
# object form is threatened on either side of the threat, a clitic, else an article, only right before it.
FORMS = {
    "THREAT": "umbringen schlagen",
    "TOLD": "shot umgebracht geschlagen erschossen getötet",
    "YOU": "you your youre ti toi usted ustedes",
    "TARGET": "they he she him her them people du ihr er tu il elle ils elles tú él ella ellos ellas",
    "ADDRESSED": "dich dir euch te vous os",
    "OBJECT": "sie ihn ihm ihnen",
    "CLITIC": "le la les lo los las se nous nos",
    "NEGATION": "not never no cannot nicht nie kein keine niemals ne pas jamais aucun nunca jamás tampoco",
    "REPORT": "said says wrote writes told tells sagt sagte sagten nannte nannten schrieb schrieben dit disait appelle écrit dijo dice dijeron escribió",
}
# Stems, and the endings that they take, by symbol; "-" is no ending.
STEMS_AND_ENDINGS = (
    ("kill destroy murder slaughter", {"THREAT": "-", "TOLD": "s ed ing"}),
    ("punish crush", {"THREAT": "-", "TOLD": "es ed ing"}),
    ("strangl", {"THREAT": "e", "TOLD": "es ed ing"}),
    ("hurt shoot", {"THREAT": "-", "TOLD": "s ing"}),
    ("stab", {"THREAT": "-", "TOLD": "s bed bing"}),
    ("töt vernicht", {"THREAT": "en e", "TOLD": "est et ete etest eten etet"}),
    ("erwürg zerstör", {"THREAT": "en e", "TOLD": "st t te test ten tet"}),
    ("erschieß", {"THREAT": "en e", "TOLD": "t"}),
    ("tu frapp écras étrangl massacr", {"THREAT": "er erai", "TOLD": "e es ons ez ent eras era erons erez eront ais ait aient é ée és ées"}),
    ("détrui", {"THREAT": "re rai", "TOLD": "s t sons sez sent ras ra rons rez ront sais sait saient ts te tes"}),
    ("mat golpe aplast", {"THREAT": "ar aré o", "TOLD": "as a amos an arás ará aremos arán é aste ó aron ado ando", "AIMED": "arte aros arlo arla arlos arlas"}),
    ("destru", {"THREAT": "ir iré yo", "TOLD": "yes ye imos yen irás irá irán í iste yó yeron ido yendo", "AIMED": "irte iros irlo irla irlos irlas"}),
    ("you", {"YOU": "'re 'll 've 'd"}),
    ("they he she", {"TARGET": "'re 's 'll 've 'd"}),
    ("t'", {"ADDRESSED": "ai as a avons avez ont aurai aura auront"}),
    ("is are was were do does did have has had wo would ca could should must", {"NEGATION": "n't"}),
    ("n'", {"NEGATION": "ai as a avons avez ont es est était"}),
    ("call claim report shout", {"REPORT": "s ed"}),
    ("quot", {"REPORT": "es ed"}),
    ("llam", {"REPORT": "a an ó aron"}),
)

#: Input symbols.
SYMBOLS = ("OTHER", "INSULT", "THREAT", "TOLD", "AIMED", "TARGET", "YOU", "OBJECT", "ADDRESSED", "CLITIC", "NEGATION", "REPORT")
#: Symbols of what makes an event.
MARKED = ("INSULT", "THREAT", "TOLD", "AIMED")
#: Symbols that transducers write for later ones.
INNER = ("DENIED", "QUOTED")
#: Events, in order: the components of a weight.
FEATURES = ("affirmed", "targeted", "denied", "reported", "threats", "clauses", "repeated")
#: Words over which a negation or a threat reaches; a report reaches twice as far.
REACH = 4

_TOKENS = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[.!?;:\n]").findall
_BREAKS = frozenset(".!?;:\n")

#: Labelled rows of each label that the lexicon and the regression are fitted on at most,
#: the ones with the smallest hashes of their ids.
FIT_ROWS = {1: 6_000, 0: 12_000}
#: Lengths of stems, shortest first.
STEMS = (4, 5, 6, 7, 8)
#: Different contexts in which toxic texts must use an insult.
MIN_CONTEXTS = 8
#: Clean texts that may use it, as a share of the toxic ones that do, each by share of its class.
MAX_CLEAN = 0.02
#: Words and their characters whose symbols a worker keeps.
MEMO_ENTRIES, MEMO_CHARS = 200_000, 40

#: Features that a task holds before it hands them on.
HELD_FEATURES = 500_000

Events = tuple[str, ...]


@dataclass(frozen=True)
class Transducer:
    """A deterministic transducer with weights: ``arcs[state, input] = (output, events, next state)``.

    State 0 is the start, at the beginning of each clause. A missing arc hands
    the input on, without events, and stays. ``final[state]``: events of a clause
    that ends there.
    """

    arcs: dict[tuple[int, str], tuple[str, Events, int]]
    final: dict[int, Events] = field(default_factory=dict)

    def step(self, state: int, symbol: str) -> tuple[str, Events, int]:
        return self.arcs.get((state, symbol), (symbol, (), state))

    def run(self, symbols: Iterable[str]) -> tuple[list[str], Counter]:
        """The output of one clause and its events."""
        state, out, events = 0, [], Counter()
        for symbol in symbols:
            written, own, state = self.step(state, symbol)
            out.append(written)
            events.update(own)
        events.update(self.final.get(state, ()))
        return out, events


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The transducer that does at once what ``second`` does with the output of ``first``."""
    number, todo = {(0, 0): 0}, [(0, 0)]
    arcs, final = {}, {}
    while todo:
        a, b = todo.pop()
        for symbol in SYMBOLS:
            between, events_a, next_a = first.step(a, symbol)
            out, events_b, next_b = second.step(b, between)
            if (next_a, next_b) not in number:
                number[next_a, next_b] = len(number)
                todo.append((next_a, next_b))
            arcs[number[a, b], symbol] = (out, events_a + events_b, number[next_a, next_b])
        if events := first.final.get(a, ()) + second.final.get(b, ()):
            final[number[a, b]] = events
    return Transducer(arcs, final)


def _shortly_after(mark: str, reach: int, changed: dict[str, tuple[str, Events]]) -> Transducer:
    """Within ``reach`` words after ``mark``, symbols are rewritten as ``changed`` says; state k: k words since the mark, and 0 for more."""
    arcs = {}
    for state in range(reach + 1):
        for symbol in (*SYMBOLS, *INNER):
            out, events = changed.get(symbol, (symbol, ())) if state else (symbol, ())
            arcs[state, symbol] = (out, events, (state + 1) % (reach + 1) if state else 0)
        arcs[state, mark] = ("OTHER", (), 1)
    return Transducer(arcs)


def reported_speech(reach: int = 2 * REACH) -> Transducer:
    return _shortly_after("REPORT", reach, dict.fromkeys(MARKED, ("QUOTED", ("reported",))) | {"TOLD": ("OTHER", ())})


def negation(reach: int = REACH) -> Transducer:
    return _shortly_after("NEGATION", reach, dict.fromkeys(MARKED, ("DENIED", ("denied",))) | {"TOLD": ("OTHER", ())})


def threat(reach: int = REACH) -> Transducer:
    """States: nothing; so many words since an object, one addressed, a threat, a told one; a clitic just before."""
    waiting = ("OBJECT", "ADDRESSED", "THREAT", "TOLD")
    number = {state: i for i, state in enumerate([("", 0), *((kind, k) for kind in waiting for k in range(1, reach + 1)), ("CLITIC", 1)])}
    victims = {"THREAT": ("TARGET", "YOU", "OBJECT", "ADDRESSED"), "TOLD": ("YOU", "ADDRESSED")}
    before = {"THREAT": ("OBJECT", "ADDRESSED", "CLITIC"), "TOLD": ("ADDRESSED",)}
    arcs = {}
    for (kind, k), state in number.items():
        later = number[kind, k + 1] if kind in waiting and k < reach else 0
        for symbol in (*SYMBOLS, *INNER):
            arcs[state, symbol] = (symbol, (), later)
        for symbol in ("TARGET", "YOU", "OBJECT", "ADDRESSED"):
            met = symbol in victims.get(kind, ())
            following = number[symbol, 1] if symbol in waiting else 0 if met else later
            arcs[state, symbol] = ("TARGET", ("threats",) if met else (), following)
        arcs[state, "CLITIC"] = ("OTHER", (), later or number["CLITIC", 1])
        for symbol, kinds in before.items():
            arcs[state, symbol] = ("OTHER", ("threats",), 0) if kind in kinds else ("OTHER", (), number[symbol, 1])
        arcs[state, "AIMED"] = ("OTHER", ("threats",), 0)
    return Transducer(arcs)


def target() -> Transducer:
    """States: 0 nothing, 1 an addressee, 2 an insult, 3 both."""
    return Transducer(
        {
            (0, "TARGET"): ("OTHER", (), 1),
            (1, "TARGET"): ("OTHER", (), 1),
            (2, "TARGET"): ("OTHER", ("targeted",), 3),
            (3, "TARGET"): ("OTHER", (), 3),
            (0, "INSULT"): ("INSULT", (), 2),
            (1, "INSULT"): ("INSULT", ("targeted",), 3),
        }
    )


def insult() -> Transducer:
    """States: 0 nothing, 1 denied or quoted ones, 2 one affirmed, 3 several."""
    return Transducer(
        {
            **{(0, symbol): ("OTHER", (), 1) for symbol in INNER},
            (0, "INSULT"): ("OTHER", ("affirmed",), 2),
            (1, "INSULT"): ("OTHER", ("affirmed",), 2),
            (2, "INSULT"): ("OTHER", ("affirmed", "repeated"), 3),
            (3, "INSULT"): ("OTHER", ("affirmed",), 3),
        },
        {1: ("clauses",), 2: ("clauses",), 3: ("clauses",)},
    )


#: The cascade, in the order in which the transducers read.
CASCADE: tuple[Callable[[], Transducer], ...] = (reported_speech, negation, threat, target, insult)


@lru_cache(maxsize=1)
def word_forms() -> tuple[Transducer, dict[int, str]]:
    """The transducer of the characters of words, and its end states' symbols: stems composed with their endings, so that states are beginnings of forms."""
    forms = {form: symbol for symbol, listed in FORMS.items() for form in listed.split()}
    for stems, endings in STEMS_AND_ENDINGS:
        for symbol, listed in endings.items():
            forms |= {stem + ending.strip("-"): symbol for stem in stems.split() for ending in listed.split()}
    number, arcs = {"": 0}, {}
    for form in forms:
        for n, letter in enumerate(form):
            state = number.setdefault(form[: n + 1], len(number))
            arcs[number[form[:n]], letter] = ("", (), state)
    return Transducer(arcs), {number[form]: symbol for form, symbol in forms.items()}


def symbol_of(word: str) -> str:
    """The symbol of a word's form; no arc leads on from what is no beginning of a form."""
    machine, ends = word_forms()
    state = 0
    for letter in word.replace("’", "'"):
        if (state, letter) not in machine.arcs:
            return "OTHER"
        state = machine.arcs[state, letter][2]
    return ends.get(state, "OTHER")


@lru_cache(maxsize=1)
def composed() -> tuple[list[list[tuple[np.ndarray | None, int]]], list[np.ndarray | None]]:
    """The composed cascade as tables: by state and symbol (weight, next state), and by state the final weight; no weight is None."""
    machine = reduce(compose, (make() for make in CASCADE))
    weight = lambda events: np.array([events.count(f) for f in FEATURES], float) if events else None
    states = 1 + max(state for state, _ in machine.arcs)
    arcs = [[(weight(machine.arcs[state, symbol][1]), machine.arcs[state, symbol][2]) for symbol in SYMBOLS] for state in range(states)]
    return arcs, [weight(machine.final.get(state, ())) for state in range(states)]


@dataclass
class Grammar:
    """The induced lexicon and the fitted weights of the events; small, and sent to all tasks."""

    words: frozenset[str] = frozenset()
    stems: frozenset[str] = frozenset()
    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(FEATURES)))
    bias: float = -4.0

    def insult(self, word: str) -> bool:
        return word in self.words or any(word[:n] in self.stems for n in STEMS if len(word) >= n)

    def symbol(self, word: str) -> str:
        return "INSULT" if self.insult(word) else symbol_of(word)


class Reader:
    """Runs the composed transducer over texts, with a bounded memo of words' symbols."""

    BREAK = len(SYMBOLS)

    def __init__(self, grammar: Grammar):
        self.grammar, self.memo = grammar, {}
        self.starts = {SYMBOLS.index(s) for s in MARKED}

    def _code(self, word: str) -> int:
        return self.BREAK if word in _BREAKS else SYMBOLS.index(self.grammar.symbol(word))

    def features(self, text: str) -> np.ndarray:
        """The summed weights of the paths of all clauses."""
        tokens = _TOKENS(text.lower())
        unseen = set(tokens).difference(self.memo)
        if len(self.memo) + len(unseen) > MEMO_ENTRIES:
            self.memo.clear()
            unseen = set(tokens)
        found = {word: self._code(word) for word in unseen}
        codes = [self.memo[t] if t in self.memo else found[t] for t in tokens] if self.memo else list(map(found.__getitem__, tokens))
        self.memo.update((w, c) for w, c in found.items() if len(w) <= MEMO_CHARS)
        if len(self.memo) > MEMO_ENTRIES:  # one text with more different words than that
            self.memo.clear()
        total = np.zeros(len(FEATURES))
        if self.starts.isdisjoint(codes):
            return total
        arcs, final = composed()
        state = 0
        for code in codes:
            if code == self.BREAK:
                weight, state = final[state], 0
            else:
                weight, state = arcs[state][code]
            if weight is not None:
                total += weight
        return total if final[state] is None else total + final[state]


def induce(rows: DataFrame, min_contexts: int = MIN_CONTEXTS, max_clean: float = MAX_CLEAN) -> tuple[frozenset[str], frozenset[str]]:
    """Insult words and stems from rows of (text, toxic).

    A candidate is a word or its first characters. It must stand in
    ``min_contexts`` different pairs of neighbours in toxic texts (copies of one
    text give one context), and the share of clean texts that use it must be
    under ``max_clean`` of the share of toxic ones. Stems that only repeat one
    kept word, and words that a kept stem covers, are left out.
    """
    def features_of(word: str) -> list[str]:
        return [word + "$", *(word[:n] for n in STEMS if len(word) >= n)]

    def in_contexts(batches):
        held: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                tokens, found = [t for t in _TOKENS(text.lower()) if t not in _BREAKS], {}
                for before, w, after in zip(["", *tokens], tokens, [*tokens[1:], ""]):
                    context = xxhash.xxh32_intdigest(f"{before} {w} {after}")
                    for c in features_of(w):
                        found.setdefault(c, context % 64)
                held.update(found.items())
                if len(held) > HELD_FEATURES:
                    yield _counts(held)
                    held = Counter()
        yield _counts(held)

    def _counts(held: Counter):
        keys = list(held)
        return pa.record_batch([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array([held[k] for k in keys], pa.int64())], names=["feature", "context", "n"])

    def among(wanted: frozenset[str]):
        def counted(batches):
            held: Counter = Counter()
            for batch in batches:
                for text in batch.column(0).to_pylist():
                    held.update({c for w in set(_TOKENS(text.lower())) for c in features_of(w)} & wanted)
            yield pa.record_batch([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["feature", "n"])

        return counted

    sizes = {bool(r[0]): r[1] for r in rows.groupBy("toxic").count().collect()}
    if not sizes.get(True) or not sizes.get(False):
        return frozenset(), frozenset()
    toxic, clean = (by_small_batches(rows.where(F.col("toxic") == label)).select("text") for label in (1, 0))
    table = toxic.mapInArrow(returning_memory(in_contexts), "feature string, context int, n long").groupBy("feature")
    table = table.agg(F.sum("n").alias("in_toxic"), F.countDistinct("context").alias("contexts")).where(F.col("contexts") >= min_contexts)
    # at most (words of FIT_ROWS toxic texts) x (lengths of stems) / min_contexts rows; so few texts of the clean class are counted
    support = {r["feature"]: r["in_toxic"] for r in table.select("feature", "in_toxic").collect()}
    counts = clean.mapInArrow(returning_memory(among(frozenset(support))), "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    in_clean = {r["feature"]: r["n"] for r in counts.collect()}
    support = {f: n for f, n in support.items() if in_clean.get(f, 0) / sizes[False] <= max_clean * n / sizes[True]}
    words = {f[:-1]: n for f, n in support.items() if f.endswith("$")}
    stems = {f for f in support if not f.endswith("$")}
    # a stem stands for itself only where it reaches clearly more texts than any one word
    best = Counter()
    for w, n in words.items():
        for k in STEMS:
            best[w[:k]] = max(best[w[:k]], n)
    stems = {s for s in stems if support[s] > 1.2 * best[s]}
    # of stems that reach the same texts, the longest
    longer: Counter = Counter()
    for s in stems:
        for k in STEMS:
            if k < len(s):
                longer[s[:k]] = max(longer[s[:k]], support[s])
    stems = {s for s in stems if longer.get(s, 0) < 0.97 * support[s]}
    stems = {s for s in stems if not any(s[:k] in stems for k in STEMS if k < len(s))}
    words = {w for w in words if not any(w[:k] in stems for k in STEMS if len(w) >= k)}
    return frozenset(words), frozenset(stems)


#: What the events weigh where labelled texts say nothing: a threat counts as toxic until they do.
PRIOR = np.array([6.0 if f == "threats" else 0.0 for f in FEATURES])


def _logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, ridge: float = 1.0, steps: int = 50) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton's method, its weights drawn to ``prior``."""
    x1 = np.column_stack([x, np.ones(len(x))])
    base, penalty = np.append(prior, 0.0), np.diag([ridge] * x.shape[1] + [1e-3])
    w = base.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        gradient = x1.T @ (p - y) + penalty @ (w - base)
        change = np.linalg.solve((x1 * (p * (1 - p))[:, None]).T @ x1 + penalty, gradient)
        w -= np.clip(change, -5, 5)
        if np.abs(change).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def fit_sample(docs: DataFrame, labels: DataFrame, fit_rows: dict[int, int] = FIT_ROWS) -> DataFrame:
    """(text, toxic) of labelled documents that aren't held out, at most ``fit_rows`` of each label.

    The ids with the smallest hashes are taken, alike each time. Only they, a
    bounded number, are sent to the documents.
    """
    marked = labels.where("toxic is not null").select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    marked = marked.where(fold_of(F.col("id")) != 2).groupBy("id").agg(F.max("toxic").alias("toxic"))
    picked = None
    for label, most in fit_rows.items():
        own = marked.where(F.col("toxic") == label).orderBy(F.xxhash64("id"), "id").limit(most)
        picked = own if picked is None else picked.unionByName(own)
    rows = docs.select(F.col("doc_id").alias("id"), without_nulls(F.col("text")).alias("text"))
    return rows.join(F.broadcast(picked), "id").select("text", "toxic")


def learn(docs: DataFrame, labels: DataFrame) -> Grammar:
    """A grammar from the labelled documents of ``fit_sample``."""
    rows = materialise(fit_sample(docs, labels), "labelled")
    words, stems = induce(rows)
    grammar = Grammar(words, stems)

    def read(batches):
        reader = Reader(grammar)
        for batch in batches:
            values = [reader.features(t).tolist() for t in batch.column(0).to_pylist()]
            yield pa.record_batch([pa.array(values, pa.list_(pa.float64())), batch.column(1)], names=["x", "toxic"])

    frame = by_small_batches(rows).mapInArrow(returning_memory(read), f"x array<double>, toxic {rows.schema['toxic'].dataType.simpleString()}").toPandas()
    if frame["toxic"].nunique() == 2:
        grammar.weights, grammar.bias = _logistic(_damped(np.array(frame["x"].tolist())), frame["toxic"].to_numpy(float), PRIOR)
    discard(rows)
    return grammar


def _damped(features: np.ndarray) -> np.ndarray:
    """Each further clause with the same event counts for less, so that long texts aren't judged by their length."""
    return np.log1p(features)


def score(rows: DataFrame, grammar: Grammar, text_column: str = "text", keep: list[str] | None = None, threshold: float = 0.3) -> DataFrame:
    """``rows``' columns ``keep`` (all, if None) with ``score``, ``predicted`` and ``clauses``; narrow."""
    keep = rows.columns if keep is None else keep

    def scored(batches):
        reader = Reader(grammar)
        for batch in batches:
            at = batch.schema.get_field_index(text_column)
            x = np.array([reader.features(t or "") for t in batch.column(at).to_pylist()]).reshape(-1, len(FEATURES))
            p = 1 / (1 + np.exp(-(_damped(x) @ grammar.weights + grammar.bias)))
            kept = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            out = [pa.array(p), pa.array((p >= threshold).astype(np.int32)), pa.array(x[:, FEATURES.index("clauses")].astype(np.int64))]
            yield pa.record_batch([*kept, *out], names=[*keep, "score", "predicted", "clauses"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return by_small_batches(rows).mapInArrow(returning_memory(scored), f"{kinds}, score double, predicted int, clauses long")


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Per row: doc_id, ``held_out``, ``score``, ``predicted`` (score of ``threshold`` or more), ``clauses``.

    Learns only from labelled rows whose id has a crc32 other than 2 modulo 4.
    Null and empty texts have no clause and get the score of a text without
    one. Without labels of both kinds nothing is learned and all scores are
    low. A document with labels of both kinds counts as toxic. Repeated rows are
    scored each; other columns are ignored. Texts are read whole, however long.
    """
    grammar = learn(docs, labels)
    rows = docs.select("doc_id", F.coalesce(fold_of(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"), without_nulls(F.col("text")).alias("text"))
    return score(rows, grammar, keep=["doc_id", "held_out"], threshold=threshold)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose score is under ``threshold``, with all their columns, whatever their names."""
    names = docs.columns
    own = [f"c{i}" for i in range(len(names))]
    found = score(docs.toDF(*own), learn(docs, labels), text_column=own[names.index("text")], threshold=threshold)
    return found.where("predicted = 0").select(*[F.col(c).alias(n) for c, n in zip(own, names)])
