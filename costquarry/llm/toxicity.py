"""Toxicity by a weighted finite-state grammar over the words of clauses.

A lexical transducer maps words to classes (insult, act, modal, target, negation, report, quotation mark).
Transducers for insults, threats, targets, negation and reported speech rewrite the stream of classes one
after another and are composed into one machine, whose arcs carry weights. What a hit is may depend on
words behind it ("kill you I will", "..., she said"), so arcs promise that a mark will come, or that none
will, and paths whose promise is broken end: of each clause exactly one path is accepted. A clause scores
the weights of the hits on its path, so an insult counts less under a negation or in reported speech and
more next to a target. A logistic layer over a text's clause scores gives its score.

Words and word beginnings of the insult class and their weights, and the weights of contexts, are learned
from labelled rows; contexts that labels say nothing of keep their built-in weights.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costquarry.llm import runtime

#: Labelled rows learned from, the first by hash of their id, and toxic ones among them; whole texts of them.
SAMPLE_ROWS, SAMPLE_TOXIC = 10_000, 2_500
PREDICT_AT = 0.3
LEAST_G = 22.0  #: log-likelihood ratio of a learned entry
LEAST_WEIGHT = 3.5  #: logarithm of how much more frequent it is in toxic rows
LEAST_NEW = 3  #: toxic rows that a learned beginning adds to the words chosen before it
STEMS = (3, 4, 5, 6, 7, 8)

OTHER, INSULT, ACT, MODAL, TARGET, NEGATION, LATE, REPORT, QUOTE, THREAT = "other", "insult", "act", "modal", "target", "negation", "late", "report", "quote", "threat"
# Classes of common words in the four languages; insults here have the least weight until labels say more.
CLASSES = {
    INSULT: "idiot moron stupid loser scum pathetic worthless disgusting dumb imbécile crétin abruti dummkopf trottel idiota estúpido imbécil",
    ACT: "kill hurt beat destroy murder attack töten töte schlagen schlage vernichten tuer tue frapper détruire matar mataré golpear destruir",
    MODAL: "will shall gonna werde werden vais allons voy vamos",
    TARGET: "you your u they du dich ihr tu toi vous tú usted ustedes",
    NEGATION: "not never no isn aren don kein keine jamais pas nunca jamás",
    LATE: "nicht nie",  # negations that may stand behind what they negate
    REPORT: "said says wrote called quote quoted sagte schrieb dit écrit dijo escribió",
}
PRIOR_WEIGHT = 1.0
#: Names of contexts in symbols, and their weights before anything is learned.
HEAPED, AIMED, NEGATED, REPORTED = "heaped", "aimed", "negated", "reported"
CONTEXTS = {HEAPED: 1.25, AIMED: 1.5, NEGATED: 0.5, REPORTED: 0.5}
THREAT_WEIGHT = 2.0
WORD = re.compile(r"[^\W\d_]+")
TOKEN = re.compile(r"[^\W\d_]+|[\"“”„«»]")
CLAUSE = re.compile(r"[.!?;\n]+")
REMEMBERED = 400_000


def symbol(kind: str, contexts: Iterable[str] = ()) -> str:
    return "+".join([kind, *(c for c in CONTEXTS if c in contexts)])


def within(context: str, of: str) -> str:
    """The symbol `of` in a further context."""
    kind, *rest = of.split("+")
    return symbol(kind, [*rest, context])


class Machine:
    """A transducer: arcs(state, symbol) gives (state, symbol out, weight) of each arc; final(state) tells where paths may end."""

    start: object

    def arcs(self, state: object, read: str) -> list[tuple[object, str, float]]:
        raise NotImplementedError

    def final(self, state: object) -> bool:
        raise NotImplementedError


class Near(Machine):
    """Hits with a mark up to `before` words before them or up to `after` words behind them are rewritten.

    States are (words for which the last mark still counts, words without a mark that have been promised, words
    up to a mark that has been promised); each hit takes one of two promises, of which the words behind it break one.
    """

    def __init__(self, marks: set[str], kinds: set[str], before: float, after: float, changed, weight: float = 1.0, plain=lambda s: s):  # noqa: ANN001
        self.marks, self.kinds, self.before, self.after = marks, kinds, before, after
        self.changed, self.plain, self.weight, self.start = changed, plain, weight, (0, 0, 0)

    def final(self, state: tuple[float, float, float]) -> bool:
        return state[2] == 0

    def arcs(self, state: tuple[float, float, float], read: str) -> list[tuple[object, str, float]]:
        seen, none, one = state
        if read in self.marks:
            return [] if none else [((self.before, 0, 0), read, 1.0)]
        if one == 1:
            return []
        none, one, left = max(0, none - 1), max(0, one - 1), max(0, seen - 1)
        if read.split("+")[0] not in self.kinds:
            return [((left, none, one), read, 1.0)]
        changed = self.changed(read)
        marked = (changed, 1.0 if changed == read else self.weight)
        if seen or one:
            return [((left, none, one), *marked)]
        out = [((left, max(none, self.after), 0), self.plain(read), 1.0)]
        if self.after > none:
            out.append(((left, none, self.after), *marked))
        return out


class Quoted(Machine):
    """Hits between quotation marks are rewritten; a mark that is not closed in the clause counts up to its end."""

    start = False

    def __init__(self, kinds: set[str], changed, weight: float):  # noqa: ANN001
        self.kinds, self.changed, self.weight = kinds, changed, weight

    def final(self, state: bool) -> bool:
        return True

    def arcs(self, state: bool, read: str) -> list[tuple[object, str, float]]:
        if read == QUOTE:
            return [(not state, read, 1.0)]
        if state and read.split("+")[0] in self.kinds and REPORTED not in read:
            return [(state, self.changed(read), self.weight)]
        return [(state, read, 1.0)]


class Composed(Machine):
    """The composition of two machines: what `first` gives out is read by `then`; weights multiply. Arcs are made when a path needs them."""

    def __init__(self, first: Machine, then: Machine):
        self.first, self.then, self.start = first, then, (first.start, then.start)

    def final(self, state: tuple[object, object]) -> bool:
        return self.first.final(state[0]) and self.then.final(state[1])

    def arcs(self, state: tuple[object, object], read: str) -> list[tuple[object, str, float]]:
        return [((a, b), out, f * g) for a, middle, f in self.first.arcs(state[0], read) for b, out, g in self.then.arcs(state[1], middle)]


class Made(Machine):
    """A machine whose arcs are remembered."""

    def __init__(self, machine: Machine, most: int = 200_000):
        self.machine, self.start, self.most, self.known = machine, machine.start, most, {}

    def final(self, state: object) -> bool:
        return self.machine.final(state)

    def arcs(self, state: object, read: str) -> list[tuple[object, str, float]]:
        got = self.known.get((state, read))
        if got is None:
            if len(self.known) >= self.most:
                self.known.clear()
            got = self.known[state, read] = self.machine.arcs(state, read)
        return got


def insults(weight: float) -> Machine:
    """An insult behind another one, up to two words off, is heaped on it."""

    class Insults(Machine):
        start = 0

        def final(self, state: int) -> bool:
            return True

        def arcs(self, state: int, read: str) -> list[tuple[object, str, float]]:
            if read != INSULT:
                return [(max(0, state - 1), read, 1.0)]
            return [(2, within(HEAPED, read), weight) if state else (2, read, 1.0)]

    return Insults()


def grammar(weights: dict[str, float] = CONTEXTS) -> Machine:
    """Insults, threats, targets, negation and reported speech as one machine."""
    hits = {INSULT, THREAT}
    add = lambda context: lambda s: within(context, s)
    out = insults(weights[HEAPED])
    for then in (
        Near({MODAL}, {ACT}, 4, 4, lambda s: THREAT, 1.0, lambda s: OTHER),
        Near({TARGET}, hits, 4, 4, add(AIMED), weights[AIMED]),
        # Of a negation that may stand on either side, "nicht", and of the others that stand before.
        Near({LATE}, hits, 3, 4, add(NEGATED), weights[NEGATED]),
        Near({NEGATION}, hits, 3, 0, lambda s: within(NEGATED, s), weights[NEGATED]),
        Near({REPORT}, hits, math.inf, math.inf, add(REPORTED), weights[REPORTED]),
        Quoted(hits, add(REPORTED), weights[REPORTED]),
    ):
        out = Composed(out, then)
    return Made(out)


def path(machine: Machine, reads: list[str]) -> list[tuple[str, float]]:
    """Symbols and weights of the accepted path; no path: none."""
    ways: dict[object, tuple] = {machine.start: None}
    for read in reads:
        after: dict[object, tuple] = {}
        for state, way in ways.items():
            for to, out, weight in machine.arcs(state, read):
                after[to] = (out, weight, way)
        ways = after
    way = next((w for state, w in ways.items() if machine.final(state)), None)
    out = []
    while way is not None:
        out.append((way[0], way[1]))
        way = way[2]
    return out[::-1]


class Lexicon(NamedTuple):
    words: dict[str, tuple[str, float]]  # word -> class, weight
    stems: dict[str, float]  # beginning of an insult -> weight


class Model(NamedTuple):
    lexicon: Lexicon
    coefficients: tuple[float, ...]
    weights: dict[str, float]  # of contexts


class Memo(dict):
    def __init__(self, lexicon: Lexicon):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> tuple[str, float] | None:
        got = self.lexicon.words.get(word)
        if got is None:
            weights = [w for n in STEMS if (w := self.lexicon.stems.get(word[:n])) is not None]
            got = (INSULT, max(weights)) if weights else None
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = got
        return got


def features(total: float, clauses: int) -> tuple[float, float]:
    """What the logistic layer sees of the sum of a text's clause scores: logarithms of it, and of it for ten clauses. Both are 0 if nothing matches."""
    return math.log1p(total), math.log1p(10 * total / clauses)


class Scorer:
    """Hits and clause scores of whole texts."""

    def __init__(self, lexicon: Lexicon, weights: dict[str, float] = CONTEXTS):
        self.memo, self.machine = Memo(lexicon), grammar(weights)

    def hits(self, clause: str) -> list[tuple[str, float, float]]:
        """Symbol, lexical weight and weight on the path of each hit of a clause."""
        known = [(QUOTE, 0.0) if len(t) == 1 and not t.isalpha() else self.memo[t] or (OTHER, 0.0) for t in TOKEN.findall(clause)]
        if not any(c in (INSULT, ACT) for c, _ in known):
            return []
        found = zip(known, path(self.machine, [c for c, _ in known]))
        return [(out, w if c == INSULT else THREAT_WEIGHT, factor) for (c, w), (out, factor) in found if out.split("+")[0] in (INSULT, THREAT)]

    def matched(self, text: str | None) -> tuple[list[tuple[str, float, float]], int]:
        """Hits of all clauses of a text, and how many clauses it has (not counted without hits)."""
        low = (text or "").lower()
        # Most texts have no word of a class that begins a hit.
        if not any(m and m[0] in (INSULT, ACT) for m in map(self.memo.__getitem__, WORD.findall(low))):
            return [], 1
        clauses = [c for c in CLAUSE.split(low) if not c.isspace()]
        return [h for c in clauses for h in self.hits(c)], max(1, len(clauses))

    def features(self, text: str | None) -> tuple[float, float]:
        hits, clauses = self.matched(text)
        return features(sum(w * factor for _, w, factor in hits), clauses)


def g_ratio(t: int, c: int, nt: int, nc: int) -> float:
    """Log-likelihood ratio of an entry in t of nt toxic and c of nc other rows; negative where it leans to the others."""
    whole, out = t + c, 0.0
    for seen, n in ((t, nt), (c, nc)):
        for k, share in ((seen, whole / (nt + nc)), (n - seen, 1 - whole / (nt + nc))):
            if k:
                out += 2 * k * math.log(k / (n * share))
    return out if t * nc > c * nt else -out


def entries(text: str) -> dict[str, str]:
    """Words, and beginnings of words marked by a star, each with the word before its first place."""
    words: dict[str, str] = {}
    before = ""
    for w in WORD.findall(text.lower()):
        if w not in words:
            words[w] = before
        before = w
    out = dict(words)
    for w, before in words.items():
        for n in STEMS:
            if len(w) > n:
                out.setdefault(w[:n] + "*", before)
    return out


def marks(words: Iterable[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)


def learn_lexicon(toxic: list[tuple[np.ndarray, np.ndarray]], clean_rows: int, clean: Callable[[np.ndarray], np.ndarray],
    names: Callable[[np.ndarray], dict[int, str]]) -> Lexicon:
    """toxic: for each toxic row the marks (hashes) of its entries, and of the words before them; clean: how many other rows have each of some marks; names: the entries of some marks."""
    words = {w: (c, PRIOR_WEIGHT) for c, ws in CLASSES.items() for w in ws.split()}
    stems: dict[str, float] = {}
    nt, nc = len(toxic), clean_rows
    if not nt or not nc:
        return Lexicon(words, stems)

    def weight(t: int, c: int) -> float:
        return min(6.0, math.log((t + 0.5) / (nt + 1)) - math.log((c + 0.5) / (nc + 1)))

    all_marks, all_before = np.concatenate([e for e, _ in toxic]), np.concatenate([b for _, b in toxic])
    row = np.repeat(np.arange(nt), [len(e) for e, _ in toxic])
    known, place, count = np.unique(all_marks, return_inverse=True, return_counts=True)
    often = count >= LEAST_NEW
    # Copies of a text repeat all its words in their places: an entry counts once for each word before it.
    pairs = np.unique(np.stack([all_marks, all_before], axis=1)[often[place]], axis=0)[:, 0]
    found, support = np.unique(pairs, return_counts=True)
    in_clean = clean(found)
    strong = {}
    for mark, t, c in zip(found.tolist(), support.tolist(), in_clean.tolist()):
        if weight(t, c) >= LEAST_WEIGHT and (g := g_ratio(t, c, nt, nc)) >= LEAST_G:
            strong[mark] = (g, t, c)
    name = names(np.array(sorted(strong), np.uint64))
    chosen: list[str] = []
    rows: dict[str, set[int]] = {}
    for g, _, _, x, mark in sorted((-strong[m][0], x[-1] == "*", -len(x), x, m) for m, x in name.items()):
        base, (_, t, c) = x.rstrip("*"), strong[mark]
        if any(base.startswith(y[:-1]) for y in chosen if y[-1] == "*"):
            continue  # a beginning of it is chosen
        here = np.flatnonzero(all_marks == np.uint64(mark))
        if x[-1] == "*":
            covered = set().union(*(rows[y] for y in chosen if y.startswith(base)))
            rest = len({b for i, b in zip(row[here].tolist(), all_before[here].tolist()) if i not in covered})
            if rest < LEAST_NEW or weight(rest, c) < LEAST_WEIGHT:
                continue  # the words that begin so are chosen
        chosen.append(x)
        rows[x] = set(row[here].tolist())
        if x[-1] == "*":
            stems[base] = weight(t, c)
        elif words.get(x, (INSULT,))[0] == INSULT:
            words[x] = (INSULT, weight(t, c))
    return Lexicon(words, stems)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Coefficients, the constant first, by Newton's method."""
    x = np.c_[np.ones(len(x)), x]
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * w
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), gradient)
    return w


def inputs(rows: list[tuple[list[tuple[str, float]], int]], weights: dict[str, float]) -> np.ndarray:
    """The features of each row from its hits (symbol, lexical weight) and clauses."""
    factor = {s: math.prod(weights[c] for c in s.split("+")[1:]) for hits, _ in rows for s, _ in hits}
    return np.array([features(sum(w * factor[s] for s, w in hits), n) for hits, n in rows])


def loss(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    z = w[0] + x @ w[1:]
    return float(np.sum(np.logaddexp(0, z) - y * z))


def learn_weights(rows: list[tuple[list[tuple[str, float]], int]], y: np.ndarray, spread: float = 0.35, steps: int = 9) -> tuple[dict[str, float], np.ndarray]:
    """Weights of contexts and the logistic layer: those of least loss, where a weight's logarithm is normal around the built-in one."""
    weights = dict(CONTEXTS)
    best = logistic(inputs(rows, weights), y)
    for _ in range(2):
        for context, built_in in CONTEXTS.items():
            if not any(context in s for hits, _ in rows for s, _ in hits):
                continue
            tried = []
            for off in np.linspace(-2, 2, steps):
                x = inputs(rows, weights | {context: built_in * math.exp(off * spread)})
                w = logistic(x, y)
                tried.append((loss(x, y, w) + off**2 / 2, abs(off), off, w))
            _, _, off, best = min(tried, key=lambda t: t[:3])
            weights[context] = built_in * math.exp(off * spread)
    return weights, best


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = SAMPLE_ROWS,
    toxic_rows: int = SAMPLE_TOXIC) -> Model:
    """Learn from at most `rows` labelled rows that are not held out, of which at most `toxic_rows` are toxic.

    Whole texts are learned from; executors reduce them to hashes of their entries, to counts and to hits, so
    no text reaches the driver. Null ids, texts and labels teach nothing; of several labels of an id the largest
    counts, of several texts of an id each is a row. Without rows of both kinds the model has the built-in words
    and weights and gives texts without a match a low score.
    """
    spark = docs.sparkSession
    runtime.ship(spark)
    usable = labels.select(labels[id_col].alias("_i"),
        labels[label].alias("_y")).where(F.col("_y").isNotNull() & F.col("_i").isNotNull() & ~runtime.held_out(F.col("_i")))
    one = usable.groupBy("_i").agg(F.max("_y").alias("_y"))
    chosen = runtime.smallest_hashes(one, F.col("_i"), rows).orderBy(F.xxhash64("_i", F.lit(0)), "_i").limit(rows).collect()
    toxic = {r._i for r in [r for r in chosen if r._y > 0][:toxic_rows]}
    # At most `rows` ids: small enough to send to every executor.
    chosen = spark.createDataFrame([(r._i, int(r._i in toxic)) for r in chosen if r._y <= 0 or r._i in toxic], "_i long, _y int")
    got = docs.select(docs[id_col].alias("_i"), docs[text].alias("_t")).where("_t is not null").join(F.broadcast(chosen), "_i")
    # Texts of one id beyond `rows` of them in all are left out, the last by hash.
    sample = got.select("_t", "_y", "_i", F.xxhash64("_t").alias("_h")).orderBy("_i", "_h").limit(rows).drop("_i")
    sample = runtime.stage(sample.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))), "labelled")
    bad, good = sample.where("_y > 0"), sample.where("_y <= 0")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[dict[str, str]]]]:
        for b in runtime.slices(batches, "_t"):
            yield b.column("_h"), [entries(t) for t in b.column("_t").to_pylist()]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, found in each(batches):
            yield pa.RecordBatch.from_arrays([h, pa.array([marks(e).tobytes() for e in found], pa.binary()),
                pa.array([marks(e.values()).tobytes() for e in found], pa.binary())], ["h", "marks", "befores"])

    def clean(wanted: np.ndarray) -> np.ndarray:
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n = np.zeros(len(wanted) + 1, np.int64)
            for _, found in each(batches):
                for e in found:
                    m = marks(e)
                    at = np.searchsorted(wanted, m)
                    n[at[np.append(wanted, 0)[at] == m]] += 1
            at = np.flatnonzero(n[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], ["at", "n"])

        out = np.zeros(len(wanted), np.int64)
        for r in good.mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toLocalIterator():
            out[r.at] = r.n
        return out

    def names(wanted: np.ndarray) -> dict[int, str]:
        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            some, known = set(wanted.tolist()), {}
            for _, found in each(batches):
                for e in found:
                    known |= {m: x for m, x in zip(marks(e).tolist(), e) if m in some}
            yield pa.RecordBatch.from_arrays([pa.array(list(known), pa.uint64()).view(pa.int64()), pa.array(list(known.values()), pa.string())], ["m", "x"])

        return {r.m % (1 << 64): r.x for r in bad.mapInArrow(look, "m long, x string").groupBy("m").agg(F.min("x").alias("x")).collect()}

    rows_of = sorted((r.h, bytes(r.marks), bytes(r.befores)) for r in bad.mapInArrow(hashed, "h long, marks binary, befores binary").collect())
    lexicon = learn_lexicon([(np.frombuffer(m, np.uint64), np.frombuffer(x, np.uint64)) for _, m, x in rows_of], good.count(), clean, names)
    del rows_of
    runtime.tidy()

    def matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(lexicon)
        for b in runtime.slices(batches, "_t"):
            found = [scorer.matched(t) for t in b.column("_t").to_pylist()]
            total = [Counter() for _ in found]
            for sum_of, (row, _) in zip(total, found):
                for s, w, _ in row:
                    sum_of[s] += w
            symbols, values = pa.array([list(c) for c in total], pa.list_(pa.string())), pa.array([list(c.values()) for c in total], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column("_h"), b.column("_y"), symbols, values, pa.array([n for _, n in found], pa.int64())],
                ["h", "y", "symbols", "sums", "clauses"])

    hits = sample.mapInArrow(matches, "h long, y int, symbols array<string>, sums array<double>, clauses long").collect()
    hits.sort(key=lambda r: (r.h, r.y))
    runtime.drop_staged(sample)
    y = np.array([float(r.y > 0) for r in hits])
    if not hits or not 0 < y.sum() < len(y):
        return Model(lexicon, (-3.0, 1.0, 2.0), dict(CONTEXTS))
    weights, coefficients = learn_weights([(list(zip(r.symbols, r.sums)), r.clauses) for r in hits], y)
    return Model(lexicon, tuple(coefficients.tolist()), weights)


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, held_out, score and predicted (score >= 0.3) for each row; null and empty texts score as texts without a match.

    Whole texts are read, however long. Ids may be null or repeat, and an empty table gives no rows; other columns are not read.
    """
    runtime.ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, w = Scorer(model.lexicon, model.weights), np.array(model.coefficients)
        for b in runtime.slices(batches, "_t"):
            x = np.array([(1.0, *scorer.features(t)) for t in b.column("_t").to_pylist()]).reshape(-1, len(w))
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column("_i"), b.column("_h"), pa.array(p), pa.array((p >= PREDICT_AT).astype(np.int32))],
                ["_i", "held_out", "score", "predicted"])

    kind = df.schema[id_col].dataType.simpleString()
    src = df.select(df[id_col].alias("_i"), df[text].alias("_t"), runtime.held_out(df[id_col]).alias("_h"))
    return src.mapInArrow(run, f"_i {kind}, held_out boolean, score double, predicted int").withColumnRenamed("_i", id_col)
