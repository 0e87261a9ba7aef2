"""Toxicity by a weighted finite-state pattern grammar.

Words and marks become symbols; letter transducers rewrite them in turn and are composed into
one table (states x symbols). The target machine raises an insult or a threat that follows a
target, the negation machine cancels a match that starts soon after a negation, the
reported-speech machine moves a match inside a report or quotation to a weaker output, and the
clause machine counts clauses with a match. A text's score is a logistic function of the
weighted matches of the composed machine.

The insult arcs are weighted by log odds of words over labelled training rows; the closed word
classes are those of four languages. Learning and scoring share one tokenizer, which splits at
apostrophes, so that the parts of an elided or possessive form are met.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded, utf8
from .scan import Words, columns, runs, scan

THRESHOLD = 0.7
#: Bound on labelled rows used to learn, a hash sample beyond it.
MAX_LABELLED = 20_000
MIN_DOCS, MIN_LOG_ODDS = 5, 2.5
TARGET_REACH, NEGATION_REACH = 6, 4

# Closed word classes of the grammar (English, German, French, Spanish).
THREAT = """kill hurt destroy beat burn shoot stab smash crush strangle
töten umbringen schlagen verletzen vernichten verbrennen erschießen zerstören
tuer frapper détruire brûler blesser écraser étrangler massacrer
matar golpear destruir quemar herir aplastar disparar estrangular"""
TARGET = """you your yours he she they them him her these those all
du dich dir euch ihr ihnen sie alle
tu toi te vous vos votre ils elles eux tous
tú ti usted ustedes vosotros ellos ellas todos"""
NEGATION = """not no never isn aren wasn weren don doesn didn without hardly
nicht nie niemals kein keine keinen ohne kaum
pas jamais aucun aucune sans guère
no nunca jamás ningún ninguna sin apenas"""
REPORTED = """said says say called calls wrote writes quoted quote claimed according reported
sagte sagt schrieb nannte behauptete zitierte laut
dit disait écrit appelé cité selon affirme
dijo dice escribió llamó citó según afirma"""

#: O other, I insult, J insult at a target, H threat word, K threat at a target, Y target, N negation,
#: R report, Q quotation mark, E end of a clause, X negated match, Z reported match, C end of a clause with a match.
SYMBOLS = "OIJHKYNRQEXZC"
NUMBER = {c: i for i, c in enumerate(SYMBOLS)}
FEATURES = "IJKXZC"
#: Marks that end clauses or quote; other typographic marks become spaces or plain marks.
MARKS = {b: "E" for b in b".!?;\n"} | {b'"'[0]: "Q"}
PLAIN = [("“", '"'), ("”", '"'), ("„", '"'), ("«", '"'), ("»", '"'), ("’", "'"), ("…", "."), ("—", " "), ("–", " "), (" ", " "), ("¡", " "), ("¿", " ")]


class Transducer:
    """One symbol in, one out: `step[state, symbol]` is the next state, `out` the symbol written."""

    def __init__(self, states: int):
        self.step = np.repeat(np.arange(states)[:, None], len(SYMBOLS), axis=1)
        self.out = np.repeat(np.arange(len(SYMBOLS))[None, :], states, axis=0)

    def on(self, state: int, symbols: str, to: int, write: str | None = None) -> None:
        for c in symbols:
            self.step[state, NUMBER[c]] = to
            if write:
                self.out[state, NUMBER[c]] = NUMBER[write]


def compose(a: Transducer, b: Transducer) -> Transducer:
    """The machine that hands what `a` writes to `b`; only reachable pairs of states are made."""
    pairs, todo = {(0, 0): 0}, [(0, 0)]
    rows = []
    for p, q in todo:
        row = []
        for c in range(len(SYMBOLS)):
            mid = a.out[p, c]
            to = (int(a.step[p, c]), int(b.step[q, mid]))
            if to not in pairs:
                pairs[to] = len(pairs)
                todo.append(to)
            row.append((pairs[to], b.out[q, mid]))
        rows.append(row)
    out = Transducer(len(rows))
    out.step[:], out.out[:] = np.array(rows)[:, :, 0], np.array(rows)[:, :, 1]
    return out


def target_machine(reach: int = TARGET_REACH) -> Transducer:
    """State: words for which a target still reaches."""
    t = Transducer(reach + 1)
    for s in range(reach + 1):
        t.on(s, "OINRH", max(0, s - 1))
        t.on(s, "Y", reach)
        t.on(s, "E", 0)
        if s:
            t.on(s, "I", s - 1, "J")
            t.on(s, "H", s - 1, "K")
        else:
            t.on(s, "H", 0, "O")  # a threat word without a target threatens nobody
    return t


def negation_machine(reach: int = NEGATION_REACH) -> Transducer:
    t = Transducer(reach + 1)
    for s in range(reach + 1):
        t.on(s, "OIJKYR", max(0, s - 1))
        t.on(s, "N", reach)
        t.on(s, "E", 0)
        if s:
            t.on(s, "IJK", s - 1, "X")
    return t


def report_machine() -> Transducer:
    """State: 1 after a word of report until the clause ends, plus 2 inside quotation marks."""
    t = Transducer(4)
    for s in range(4):
        t.on(s, "R", s | 1)
        t.on(s, "Q", s ^ 2)
        t.on(s, "E", s & 2)
        if s:
            t.on(s, "IJK", s, "Z")
    return t


def clause_machine() -> Transducer:
    t = Transducer(2)
    for s in range(2):
        t.on(s, "IJKXZ", 1)
        t.on(s, "E", 0, "C" if s else None)
    return t


def grammar() -> Transducer:
    out = target_machine()
    for m in (negation_machine(), report_machine(), clause_machine()):
        out = compose(out, m)
    return out


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 1


def tokens(texts: list[bytes]) -> Words:
    """Words of texts in lower case, typographic marks made plain."""
    plain = []
    for t in texts:
        t = t.decode().lower().encode()
        if not t.isascii():
            for mark, other in PLAIN:
                t = t.replace(mark.encode(), other.encode())
        plain.append(t)
    return scan(plain)


class Grammar:
    """The composed machine over words: the lexicon transducer gives symbols and weights."""

    def __init__(self, arcs: dict[str, float]):
        kinds = {w: c for c, ws in (("Y", TARGET), ("R", REPORTED), ("N", NEGATION), ("H", THREAT)) for w in ws.split()} | {w: "I" for w in arcs}
        lexicon = scan([w.encode() for w in kinds])
        order = np.argsort(lexicon.hash)
        self.known = lexicon.hash[order]
        self.symbol = np.array([NUMBER[c] for c in kinds.values()])[order]
        self.weight = np.array([arcs.get(w, 1.0) for w in kinds])[order]
        g = grammar()
        self.step, self.out = g.step.tolist(), g.out.tolist()
        # O read k times: reaches are spent after the longest of them.
        self.wait = [np.arange(len(g.step))]
        for _ in range(max(TARGET_REACH, NEGATION_REACH)):
            self.wait.append(g.step[self.wait[-1], NUMBER["O"]])
        self.wait = [w.tolist() for w in self.wait]
        self.mark = np.zeros(256, "int64")
        for b, c in MARKS.items():
            self.mark[b] = NUMBER[c]

    def features(self, w: Words) -> np.ndarray:
        """Weighted matches of each text: one row per text, a column per feature."""
        n, far = len(w.first) - 1, len(self.wait) - 1
        out = np.zeros((n, len(SYMBOLS)))
        at = np.minimum(np.searchsorted(self.known, w.hash), len(self.known) - 1)
        event = np.flatnonzero(self.known[at] == w.hash)
        sym = self.symbol[at[event]]
        doc = w.doc[event]
        live = np.zeros(n, bool)
        live[doc[(sym == NUMBER["I"]) | (sym == NUMBER["H"])]] = True  # no other text can match anything
        if not live.any():
            return out[:, [NUMBER[c] for c in FEATURES]]
        use = live[doc]
        event, sym, doc = event[use], sym[use], doc[use]
        data = np.frombuffer(w.raw, "uint8")
        mark = self.mark[data]
        spot = np.flatnonzero(mark)
        before = np.searchsorted(w.start, spot)
        mdoc = np.searchsorted(w.begin, spot, "right") - 1
        keep = live[mdoc]
        spot, before, mdoc = spot[keep], before[keep], mdoc[keep]
        place = np.r_[w.start[event], spot]
        order = np.argsort(place, kind="stable")
        word = np.r_[event, before][order].tolist()
        symbol = np.r_[sym, mark[spot]][order].tolist()
        weight = np.r_[self.weight[at[event]], np.ones(len(spot))][order].tolist()
        taken = np.r_[np.ones(len(event), int), np.zeros(len(spot), int)][order].tolist()
        docs = np.r_[doc, mdoc][order]
        cuts = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1], True])
        step, write, wait = self.step, self.out, self.wait
        end = NUMBER["E"]
        for a, b in zip(cuts[:-1], cuts[1:]):
            row, state, seen = out[docs[a]], 0, word[a]
            for i in range(a, b):
                state = wait[min(word[i] - seen, far)][state]
                row[write[state][symbol[i]]] += weight[i]
                state = step[state][symbol[i]]
                seen = word[i] + taken[i]
            row[write[state][end]] += 1.0
        return out[:, [NUMBER[c] for c in FEATURES]]


def learn_arcs(train: DataFrame) -> dict[str, float]:
    """Log odds of words over labelled training rows: texts of each label that hold a word,
    summed across partitions. `train`: text (bytes), toxic."""
    def count(batches):
        for b in batches:
            for lo, hi in runs(b.column("text")):
                part = b.slice(lo, hi - lo)
                w, toxic = tokens(part.column("text").to_pylist()), np.asarray(part.column("toxic").to_numpy(zero_copy_only=False), "int64")
                h, first, back = np.unique(w.hash, return_index=True, return_inverse=True)
                pair = np.unique(back * max(1, len(part)) + w.doc)
                word, label = pair // max(1, len(part)), toxic[pair % max(1, len(part))]
                yield pa.RecordBatch.from_arrays([pa.array([w.word(i) for i in first], pa.binary()), pa.array(np.bincount(word, label, len(h)).astype("int64")),
                                                  pa.array(np.bincount(word, 1 - label, len(h)).astype("int64"))], names=["w", "a", "b"])

    n1, n0 = train.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum(1 - F.col("toxic")), F.lit(0))).first()
    c = train.select("toxic", "text").mapInArrow(count, "w binary, a bigint, b bigint").groupBy("w").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    odds = F.log((F.col("a") + 0.5) / (n1 + 1.0)) - F.log((F.col("b") + 0.5) / (n0 + 1.0))
    rows = c.where(F.col("a") >= MIN_DOCS).select(F.col("w").cast("string").alias("w"), odds.alias("o")).where(F.col("o") >= MIN_LOG_ODDS).collect()
    return {r.w: float(r.o) for r in rows}


def _features(docs: DataFrame, arcs: dict[str, float]) -> DataFrame:
    grammar_ = Grammar(arcs)

    def run(batches):
        for b in batches:
            for lo, hi in runs(b.column("text")):
                part = b.slice(lo, hi - lo)
                yield columns(part, ["toxic"], {"x": pa.array(list(grammar_.features(tokens(part.column("text").to_pylist()))), pa.list_(pa.float64()))})

    return docs.select("toxic", "text").mapInArrow(run, "toxic int, x array<double>")


def fit_weights(rows: np.ndarray, y: np.ndarray, steps: int = 30):
    """Ridge logistic weights over log1p clause features, by Newton's method."""
    x = np.c_[np.log1p(rows), np.ones(len(rows))]
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + 0.05 * w
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(x.shape[1])
        w -= np.linalg.solve(h, g)
    return w


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, key: str | None = None, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Per row: doc_id, held_out, score (0 to 1), predicted, and `key` if a column of that name is given.

    At most about `max_labelled` labelled rows are learnt from, a sample by hash of the id, and of
    the row where ids are repeated.
    Null text counts as empty and gets the base score; a null id is not held out; repeated
    rows score alike; without usable labels the score is 0; several labels of one document
    count as toxic if any is. Extra columns are ignored."""
    pos = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).where(~held_out(F.col("doc_id")))
    n = pos.count()
    if n > max_labelled:
        pos = pos.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1e6 * max_labelled / n))
    # The sample is bounded, so it is sent to the documents and no other text moves.
    known = bounded(docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8()).join(F.broadcast(pos), "doc_id").select("text", "toxic"), max_labelled)
    arcs = learn_arcs(known)
    feats = _features(known, arcs).collect()
    w = fit_weights(np.array([r.x for r in feats]), np.array([r.toxic for r in feats], "float64")) if feats else None
    machine, own = Grammar(arcs), [key] if key else []

    def run(batches):
        for b in batches:
            for lo, hi in runs(b.column("text")):
                part = b.slice(lo, hi - lo)
                if w is None:
                    score = np.zeros(len(part))
                else:
                    z = np.c_[np.log1p(machine.features(tokens(part.column("text").to_pylist()))), np.ones(len(part))] @ w
                    score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                yield columns(part, ["doc_id", *own, "held_out"], {"score": pa.array(score), "predicted": pa.array((score >= threshold).astype("int32"))})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *own, F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), utf8())
    return rows.mapInArrow(run, ", ".join(["doc_id bigint", *[f"`{c}` bigint" for c in own], "held_out boolean, score double, predicted int"]))


def op7_toxicity(spark, sf_dir):
    """Every document scored; edge cases as in `score_toxicity`."""
    from .common import table

    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
