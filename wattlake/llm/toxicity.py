"""Toxicity of texts after undoing disguises, by a noisy channel and a learnt word list.

The channel writes a letter as a look-alike digit or symbol, repeats it, or sets its
word apart letter by letter.  Spans that may be so disguised are read as a lattice: each
place offers the letters it may stand for, and the most likely path under a trigram
model of characters, counted over all texts, is the restored spelling (Viterbi).

A word list is learnt from labelled rows: words and word beginnings that stand in toxic
texts far more often than in others, each with its log odds.  An entry needs ``count``
toxic rows and a likelihood ratio that chance hardly reaches, not a share of the rows;
beginnings that a longer entry explains are dropped before the list is cut.  A text's evidence is the
sum over the distinct entries its restored words hit, and a logistic curve fitted to
the same rows turns evidence into a score.

The model is fitted on at most ``sample`` labelled rows of each class, taken in order of
a hash of the id, so the word list and the rows used for fitting are bounded; character
counts and scores cover all texts.

Defined cases: NULL and empty texts have no evidence and the score that goes with it;
rows without a label are scored alike; several labels of one id count as toxic if any
is; without toxic or without clean labelled rows every score is 0; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake.llm.common import written

# Letters that a digit or symbol may stand for.
LOOKALIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l",
}
SUBSTITUTED, REPEATED, JOINED, KEPT, STRANGE = 1.5, 0.7, 0.4, 3.0, 6.0

SIZE = 27
# A letter or look-alike, perhaps repeated; three or more of them set apart by gaps of any length.
SPACED = re.compile(r"(?<![^\W_])(?:([^\W\d_]|[0-9@$!|+€£])\1*[ .\-_*/]+){2,}([^\W\d_]|[0-9@$!|+€£])\2*(?![^\W_])")
GAPS = re.compile(r"[ .\-_*/]+")
LETTERS = re.compile(r"[^\W\d_]+")
RUN = re.compile(r"(.)\1+")
GAP = re.compile(r"[\W\d_]+")
TRAIL = "!.,;:?)\"'$@|+*#%&-_"
BLANK, LETTER, LOOKS, JOINER, OTHER = range(5)


def _letters() -> np.ndarray:
    """Code points below 0x180 to 1-26 by their base letter, anything else to 0."""
    table = np.zeros(0x180, np.uint8)
    for code in range(0x180):
        base = unicodedata.normalize("NFD", chr(code).lower())[:1]
        if "a" <= base <= "z":
            table[code] = ord(base) - 96
    return table


def _kinds() -> np.ndarray:
    """What each code point below 0x250 may be in a disguise; all above are letters."""
    table = np.full(0x251, OTHER, np.uint8)
    for code in range(0x250):
        c = chr(code)
        if c.isspace():
            table[code] = BLANK
        elif c in LOOKALIKE:
            table[code] = LOOKS
        elif c.isalpha():
            table[code] = LETTER
        elif c in "*._-/":
            table[code] = JOINER
    table[0x250] = LETTER
    return table


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _fold(text: str, table: np.ndarray) -> np.ndarray:
    points = _points(text)
    return np.where(points < len(table), table[np.minimum(points, len(table) - 1)], 0)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Character trigrams of all texts of a task: one row for each.

    Runs of other characters are one boundary, and what stood before it is forgotten.
    """
    table, total = _letters(), np.zeros(SIZE**3, np.int64)
    for batch in batches:
        for text in batch.column(0).to_pylist():
            if text:
                c = np.concatenate(([0], _fold(text, table), [0])).astype(np.int32)
                c = c[np.append(True, (c[1:] > 0) | (c[:-1] > 0))]
                a = np.append(0, c[:-2])
                a[c[:-1] == 0] = 0
                total += np.bincount(a * SIZE * SIZE + c[:-1] * SIZE + c[1:], minlength=SIZE**3)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["gram", "n"])


def character_model(docs: DataFrame, text: str) -> np.ndarray:
    """Negative log probability of a letter after two others, from all texts.

    The alphabet is fixed, so what reaches the driver is at most 27**3 sums.
    """
    grams = docs.select(docs[f"`{text}`"]).mapInArrow(_count, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    counts = np.zeros(SIZE**3)
    for gram, n in grams.collect():
        counts[gram] = n
    cube = counts.reshape(SIZE, SIZE, SIZE)
    pairs = cube.sum(axis=0) + 0.5
    backed = pairs / pairs.sum(axis=1, keepdims=True)
    smooth = (cube + 20 * backed[None]) / (cube.sum(axis=2, keepdims=True) + 20)
    return -np.log(np.maximum(smooth, 1e-12)).reshape(-1)


class Decoder:
    """Most likely spelling of a disguised span."""

    def __init__(self, model: np.ndarray):
        self.cost = model.tolist()
        self.table, self.kinds = _letters(), _kinds()
        self.known: dict[tuple[str, int], str] = {}

    def letter(self, c: str) -> int:
        point = ord(c)
        return int(self.table[point]) if point < len(self.table) else 0

    def arcs(self, span: str, at: int, gap: int, tail: int) -> list[tuple[int, str, float]]:
        """(next place, letters written, cost) for each way to read on.

        ``gap`` is the length of the span's shortest gap; a longer one may part words.
        From ``tail`` on, the rest may be punctuation.
        """
        c = span[at]
        if c.isalpha():
            end = at + 1
            while end < len(span) and span[end] == c:
                end += 1
            out = [(at + 1, c, 0.0)]
            if end > at + 1:
                out += [(end, c, REPEATED)]
            if end > at + 2:
                out += [(end, c + c, REPEATED + 0.1)]
            return out
        apart = GAPS.match(span, at)
        if apart:
            end = apart.end()
            return [(end, " ", JOINED if end - at > gap else KEPT), (end, "", JOINED)]
        out = [(at + 1, " ", KEPT if c.isspace() or c in LOOKALIKE else STRANGE - KEPT)]
        if at >= tail:
            out.append((len(span), " ", JOINED))
        end = at + 1
        while end < len(span) and span[end] == c:
            end += 1
        if c in LOOKALIKE:
            out += [(stop, letter, SUBSTITUTED) for letter in LOOKALIKE[c] for stop in {at + 1, end}]
        else:
            out.append((at + 1, "", JOINED))
        return out

    def decode(self, span: str, tail: int | None = None) -> str:
        tail = len(span) if tail is None else tail
        if (span, tail) in self.known:
            return self.known[span, tail]
        gap = min((m.end() - m.start() for m in GAPS.finditer(span)), default=0)
        paths: list[dict[tuple[int, int], tuple[float, int, tuple[int, int] | None, str]]] = [{} for _ in range(len(span) + 1)]
        paths[0][(0, 0)] = (0.0, -1, None, "")
        for at in range(len(span)):
            if not paths[at]:
                continue
            for to, letters, price in self.arcs(span, at, gap, tail):
                for state, (cost, _, _, _) in paths[at].items():
                    a, b = state
                    total = cost + price
                    for c in letters:
                        n = self.letter(c)
                        total += self.cost[(a * SIZE + b) * SIZE + n]
                        a, b = b, n
                    seen = paths[to].get((a, b))
                    if seen is None or total < seen[0]:
                        paths[to][(a, b)] = (total, at, state, letters)
        state = min(paths[-1], key=lambda s: (paths[-1][s][0] + self.cost[(s[0] * SIZE + s[1]) * SIZE], s))
        at, out = len(span), []
        while at > 0:
            _, before, previous, letters = paths[at][state]
            out.append(letters)
            at, state = before, previous
        restored = "".join(reversed(out))
        if len(self.known) < 50_000 and len(span) < 64:
            self.known[span, tail] = restored
        return restored

    def closings(self, core: str, looks: str, entries: ahocorasick.Automaton) -> list[str]:
        """Entries that begin with ``core`` and end in look-alikes that follow it."""
        spelled, out, at = {core, RUN.sub(r"\1", core)}, [], 0
        while at < len(looks) and spelled:
            end = at + 1
            while end < len(looks) and looks[end] == looks[at]:
                end += 1
            spelled = {s + c * n for s in spelled for c in LOOKALIKE[looks[at]] for n in {1, min(2, end - at)}}
            spelled = {s for s in spelled if entries.match(s)}
            out += [s for s in sorted(spelled) if s in entries]
            at = end
        return out

    def token(self, token: str, heads: dict[str, set[str]] | None, entries: ahocorasick.Automaton | None) -> str:
        """A token with something odd in it, restored.

        Look-alikes at its end may be letters or punctuation: the likelier reading and
        entries of the word list that they complete stand beside the token without them.
        """
        core = token.rstrip(TRAIL)
        plain = self.plain(token, core, heads)
        looks = token[len(core) :]
        looks = looks[: len(looks) - len(looks.lstrip("".join(LOOKALIKE)))]
        if not core or not looks:
            return plain
        more = [self.decode(core + looks, len(core))]
        if entries:
            own = core if core.isalpha() else self.decode(core)
            more += self.closings(own.rsplit(" ", 1)[-1], looks, entries)
        return " ".join([plain, *(m for m in more if m.strip() != core)])

    def plain(self, token: str, core: str, heads: dict[str, set[str]] | None) -> str:
        """A token, restored, whose end is punctuation."""
        if core and not core.isalpha():
            return self.decode(core) + " " * (len(core) < len(token))

        def word(m: re.Match) -> str:
            given = m.group()
            if any(a == b == c for a, b, c in zip(given, given[1:], given[2:])):
                return self.decode(given)
            slim = RUN.sub(r"\1", given)
            near = heads.get(slim[:4]) if heads and len(slim) < len(given) else None
            if near and any(slim.startswith(n) for n in near):
                return f"{given} {slim}"
            return given

        return LETTERS.sub(word, token)

    def restore(self, text: str, heads: dict[str, set[str]] | None = None, entries: ahocorasick.Automaton | None = None) -> str:
        """Lower case, with all disguised spans of the whole text decoded.

        A letter that is merely doubled is common; such a word gets its spelling without
        doubles beside it if that begins as an entry of the word list does.
        """
        low = text.lower()
        points = _points(low)
        if len(points) < 3:
            return low
        kind = self.kinds[np.minimum(points, 0x250)]
        letter, looks, join = kind == LETTER, kind == LOOKS, kind == JOINER
        if self.apart(points, letter, looks):
            low = SPACED.sub(lambda m: self.decode(m.group()) if LETTERS.search(m.group()) else m.group(), low)
            points = _points(low)
            kind = self.kinds[np.minimum(points, 0x250)]
            letter, looks, join = kind == LETTER, kind == LOOKS, kind == JOINER
        odd = np.zeros(len(points), bool)
        odd[1:] |= (letter[:-1] & looks[1:]) | (looks[:-1] & letter[1:])
        solid = np.flatnonzero(~join)
        a, b = solid[:-1], solid[1:]
        odd[b] |= (b > a + 1) & (letter | looks)[a] & (letter | looks)[b] & (letter[a] | letter[b])
        same = (points[1:] == points[:-1]) & letter[1:]
        if heads is None:
            odd[2:] |= same[1:] & same[:-1]
        else:
            odd[1:] |= same
        places = np.flatnonzero(odd)
        if not len(places):
            return low
        blank = np.flatnonzero(kind == BLANK)
        which = np.unique(np.searchsorted(blank, places))
        edges = np.concatenate(([-1], blank, [len(points)]))
        out, done = [], 0
        for start, end in zip((edges[which] + 1).tolist(), edges[which + 1].tolist(), strict=True):
            out += [low[done:start], self.token(low[start:end], heads, entries)]
            done = end
        return "".join([*out, low[done:]])


    def apart(self, points: np.ndarray, letter: np.ndarray, looks: np.ndarray) -> bool:
        """Whether three runs of one letter or look-alike follow each other."""
        unit = np.concatenate(([False], letter | looks, [False]))
        starts = np.flatnonzero(unit[1:-1] & ~unit[:-2])
        ends = np.flatnonzero(unit[1:-1] & ~unit[2:])
        change = np.concatenate(([0], np.cumsum(points[1:] != points[:-1])))
        single = change[starts] == change[ends]
        return bool((single[2:] & single[1:-1] & single[:-2]).any())


BEGINNINGS = range(4, 8)


def entries_of(restored: str) -> set[str]:
    """A text's words, each with a blank behind it, and their beginnings."""
    words = {w for w in GAP.split(restored) if len(w) > 2}
    return {w + " " for w in words} | {w[:n] for w in words for n in BEGINNINGS if len(w) > n}


def _features(model: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(model)
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                found = [sorted(entries_of(decoder.restore(t or ""))) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(pa.string()))], ["toxic", "entries"])

    return run


def chosen_entries(found: dict[str, tuple[int, float]]) -> dict[str, float]:
    """Log odds of the entries that tell most: no beginning that one longer entry explains."""
    longer: dict[str, int] = {}
    for entry, (bad, _) in found.items():
        for n in range(1, len(entry)):
            longer[entry[:n]] = max(longer.get(entry[:n], 0), bad)
    kept = {e: math.log(odds) for e, (bad, odds) in found.items() if longer.get(e, 0) < 0.9 * bad}
    return {e: w for e, w in kept.items() if e[-1] != " " or e[:-1] not in kept}


def telling_entries(counted: DataFrame, bad_rows: int, good_rows: int, count: int, ratio: float, least_odds: float) -> DataFrame:
    """(entry, bad, odds) of entries (entry, bad, good) that tell toxic rows, without redundant ones.

    ``ratio`` is the least likelihood ratio (G) against chance; 20 is passed with
    probability 8e-6, so of 100,000 words without meaning about one.
    """
    bad, good = F.col("bad"), F.col("good")
    all_rows = bad_rows + good_rows
    expected = (bad + good) * (bad_rows / all_rows)
    rest = (bad + good) * (good_rows / all_rows)
    gain = 2 * (bad * F.log(bad / expected) + F.when(good > 0, good * F.log(good / rest)).otherwise(0.0))
    odds = ((bad + 0.1) / bad_rows) / ((good + 0.5) / good_rows)
    likely = counted.where(bad >= count).withColumn("gain", gain).withColumn("odds", odds)
    listed = written(likely.where((F.col("gain") >= ratio) & (F.col("odds") >= least_odds)).select("entry", "bad", "odds"), "toxic-entries")
    shorter = [F.when(F.length("entry") > n, F.substring("entry", 1, n)) for n in BEGINNINGS]
    longer = listed.select(F.explode(F.array_compact(F.array(*shorter))).alias("entry"), "bad").groupBy("entry").agg(F.max("bad").alias("longer"))
    kept = listed.join(longer, "entry", "left").where(F.coalesce("longer", F.lit(0)) < 0.9 * F.col("bad")).drop("longer")
    covered = kept.where(~F.col("entry").endswith(" ")).select(F.concat("entry", F.lit(" ")).alias("entry"))
    return kept.join(covered, "entry", "left_anti")


class WordList:
    """Log odds of words and beginnings; finds those in a restored text."""

    def __init__(self, weights: dict[str, float]):
        self.automaton = ahocorasick.Automaton()
        self.heads: dict[str, set[str]] = {}
        for entry, weight in weights.items():
            self.automaton.add_word(entry.strip(), (entry, len(entry.strip()), weight))
            slim = RUN.sub(r"\1", entry.strip())
            self.heads.setdefault(slim[:4], set()).add(slim)
        if weights:
            self.automaton.make_automaton()
        self.empty = not weights

    def evidence(self, restored: str) -> tuple[float, list[str]]:
        """Sum of the distinct entries' log odds, where of entries that begin alike the best counts."""
        if self.empty:
            return 0.0, []
        hits: dict[str, float] = {}
        for end, (entry, length, weight) in self.automaton.iter(restored):
            start = end - length + 1
            whole = entry[-1] == " " and end + 1 < len(restored) and restored[end + 1].isalpha()
            if not whole and not (start and restored[start - 1].isalpha()):
                hits[entry] = weight
        best: dict[str, float] = {}
        for entry, weight in hits.items():
            head = entry[:4]
            best[head] = max(best.get(head, 0.0), weight)
        return sum(best.values()), sorted(hits)


def _score(model: np.ndarray, weights: dict[str, float], curve: tuple[float, float] | None, fields: list[str]):
    """(carried columns..., text) to the carried columns, evidence, score and the entries found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder, listed = Decoder(model), WordList(weights)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                found = [listed.evidence(decoder.restore(t, listed.heads, listed.automaton)) if t else (0.0, []) for t in part.column(len(fields)).to_pylist()]
                x = np.array([f[0] for f in found], np.float64)
                score = np.zeros(len(x)) if curve is None else 1 / (1 + np.exp(-np.clip(curve[0] + curve[1] * np.log1p(x), -50, 50)))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(i) for i in range(len(fields))], pa.array(x), pa.array(score), pa.array([f[1] for f in found], pa.list_(pa.string()))],
                    [*fields, "evidence", "score", "found"],
                )

    return run


def _curve(x: np.ndarray, y: np.ndarray, heft: np.ndarray) -> tuple[float, float]:
    """Logistic regression on one variable, with a mild penalty on the slope."""
    z = np.log1p(x)
    a, b = 0.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a + b * z, -30, 30)))
        g = np.array([(heft * (y - p)).sum() - 1e-3 * a, (heft * (y - p) * z).sum() - 1e-3 * b])
        w = heft * p * (1 - p)
        h = np.array([[w.sum() + 1e-3, (w * z).sum()], [(w * z).sum(), (w * z * z).sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        step = np.clip(step, -2, 2)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(max(b, 0.0))


def held_out(id: Column) -> Column:
    return F.crc32(id.cast("string").cast("binary")) % 4 == 2


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    sample: int = 6000,
    count: int = 3,
    ratio: float = 20.0,
    least_odds: float = 8.0,
    keep: tuple[str, ...] = (),
    entries: int = 2000,
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, held_out, evidence, score, found.

    ``labels`` has (doc_id, toxic); rows whose id's checksum leaves 2 when divided by 4
    are held out and never learnt from.  ``keep`` names further columns to carry.
    """
    model = character_model(docs, text)
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    totals = {t: n for t, n in known.groupBy("toxic").count().collect()}
    order = W.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = written(known.withColumn("place", F.row_number().over(order)).where(F.col("place") <= sample).drop("place"), "toxic-sample")
    rows = docs.select(docs[f"`{id}`"].alias("doc_id"), docs[f"`{text}`"].alias("text"))
    # At most 2 * sample ids: small by construction.
    learnt = written(rows.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).dropDuplicates(["text"]).select("toxic", "text"), "toxic-learnt")
    have = {t: n for t, n in learnt.groupBy("toxic").count().collect()}
    weights: dict[str, float] = {}
    curve = None
    if have.get(0) and have.get(1):
        seen = learnt.mapInArrow(_features(model), "toxic int, entries array<string>").select("toxic", F.explode("entries").alias("entry"))
        bad, good = F.sum("toxic"), F.sum(1 - F.col("toxic"))
        counted = seen.groupBy("entry").agg(bad.alias("bad"), good.alias("good"))
        listed = telling_entries(counted, have[1], have[0], count, ratio, least_odds)
        strongest = listed.orderBy(F.col("bad").desc(), F.col("odds").desc(), "entry").limit(entries).collect()
        weights = chosen_entries({r["entry"]: (int(r["bad"]), float(r["odds"])) for r in strongest})
        schema = "toxic int, evidence double, score double, found array<string>"
        points = learnt.mapInArrow(_score(model, weights, None, ["toxic"]), schema).select("toxic", "evidence").collect()
        x, y = np.array([p[1] for p in points]), np.array([p[0] for p in points], float)
        heft = np.where(y == 1, totals.get(1, 1) / have[1], totals.get(0, 1) / have[0])
        curve = _curve(x, y, heft)
    kept = [docs[f"`{name}`"] for name in keep]
    carried = docs.select(docs[f"`{id}`"].alias("doc_id"), *kept, docs[f"`{text}`"].alias("toxic_text"))
    fields = carried.columns[:-1]
    added = T.StructType().add("evidence", "double").add("score", "double").add("found", T.ArrayType(T.StringType()))
    schema = T.StructType(carried.schema.fields[:-1] + added.fields)
    scored = carried.mapInArrow(_score(model, weights, curve, fields), schema)
    return scored.withColumn("held_out", F.coalesce(held_out(F.col("doc_id")), F.lit(False)))
