"""Secrets in texts: wide candidates, thinned by a random forest.

Candidates are runs of letters, digits and ``+ / _ - .`` (with ``=`` at the end) that
hold letters and digits and are long, or are assigned to a name such as ``token``.  A
random forest, trained on labelled findings, tells secrets from checksums, addresses,
identifiers and placeholders.  It sees the length, how likely the character
transitions are in ordinary text, how far dictionary words cover the value, changes of
character class, the path, and the words before and after.

The transitions and the dictionary are counted over all texts; the alphabet of the one
is fixed and the other is cut at ``dictionary`` words, so both are small.  The forest is
fitted on the labelled findings given, of which there may be any number; the registered
query uses findings made by a rule (:func:`labelled_findings`), because no given table
labels secrets.  Whole texts are scanned; values are reported by place and digest.

Defined cases: NULL and empty texts have no candidates; a NULL path is empty; equal
values are reported at each place; repeated rows are reported each; without findings of
both classes every score is 0.5; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm.common import text_chunks, written
from wattlake.llm.toxicity import SIZE, character_model

# Words that speak for and against a secret, and path parts likewise.
FOR = frozenset("token secret password passwd pwd apikey api key auth bearer credential credentials access private client".split())
AGAINST = frozenset("commit sha md5 sha1 sha256 checksum digest hash example sample placeholder dummy test uuid id version revision mail http https www com".split())
QUIET = frozenset("test tests example examples doc docs sample samples fixture fixtures mock vendor".split())

LEAST, LEAST_ASSIGNED, AROUND = 16, 6, 48
ASSIGNED = re.compile(r"([A-Za-z][A-Za-z0-9_\-]*)[\"']?\s{0,2}(?:[:=]|=>|:=)\s{0,2}[\"']?$")
NAMES = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
FEATURES = (
    "length", "transitions", "coverage", "switches", "digits", "upper", "distinct", "entropy",
    "hex", "dots", "named", "quoted", "for_before", "against_before", "for_after", "against_after", "quiet_path",
)

_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *b"+/_-."]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def candidates(data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
    """(text, from, to) of every candidate in a run of texts, in bytes of ``data``."""
    inside = _INSIDE[data]
    first = inside.copy()
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first[1:] &= ~inside[:-1] | edge[1:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return []
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    ends = np.flatnonzero(last) + 1
    lengths = ends - starts
    digits, letters = (np.concatenate(([0], np.cumsum(m[data]))) for m in (_DIGIT, _LETTER))
    mixed = (digits[ends] > digits[starts]) & (letters[ends] > letters[starts])
    long = mixed & (lengths >= LEAST)
    operator = (data == 0x3D) | (data == 0x3A)
    near = np.zeros(len(starts), bool)
    for back in range(1, 5):
        at = starts - back
        near |= (at >= 0) & operator[np.maximum(at, 0)]
    near &= (lengths >= LEAST_ASSIGNED) & ~long
    raw = data.tobytes()
    owner = np.searchsorted(offsets, starts, "right") - 1
    out = []
    for i in np.flatnonzero(long | near).tolist():
        a, b, low = int(starts[i]), int(ends[i]), int(offsets[owner[i]])
        while b > a and raw[b - 1] in b".-/":
            b -= 1
        if near[i]:
            name = ASSIGNED.search(raw[max(low, a - AROUND) : a].decode("utf-8", "replace"))
            if not name or not FOR & {w.lower() for w in NAMES.findall(name.group(1))}:
                continue
        elif b - a < LEAST:
            continue
        high = int(offsets[owner[i] + 1])
        while b < high and raw[b] == 0x3D and b - a >= LEAST:
            b += 1
        out.append((int(owner[i]), a, b))
    return out


def describe(value: str, before: str, after: str, path: str, cost: list[float], known: frozenset[str]) -> list[float]:
    """The features of a candidate, in the order of ``FEATURES``."""
    low = value.lower()
    codes = [ord(c) - 96 if "a" <= c <= "z" else 0 for c in low]
    a = b = 0
    total = 0.0
    for c in [*codes, 0]:
        total += cost[(a * SIZE + b) * SIZE + c]
        a, b = (0 if c == 0 else b), c
    covered = [0] * (len(low) + 1)
    for i in range(len(low)):
        covered[i + 1] = max(covered[i + 1], covered[i])
        for n in range(4, min(12, len(low) - i) + 1):
            if low[i : i + n] in known:
                covered[i + n] = max(covered[i + n], covered[i] + n)
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "o" for c in value]
    n = len(value)
    counts = Counter(value)
    words_before = [w.lower() for w in NAMES.findall(before)][-4:]
    words_after = [w.lower() for w in NAMES.findall(after)][:3]
    return [
        math.log(n),
        total / (n + 1),
        max(covered) / n,
        sum(x != y for x, y in zip(kinds, kinds[1:])) / n,
        kinds.count("d") / n,
        kinds.count("u") / n,
        len(counts) / min(n, 64),
        -sum(k / n * math.log2(k / n) for k in counts.values()),
        float(all(c in "0123456789abcdef" for c in low)),
        value.count(".") / n,
        float(bool(ASSIGNED.search(before))),
        float(before[-1:] in ("'", '"')),
        float(bool(FOR & set(words_before))),
        float(bool(AGAINST & set(words_before))),
        float(bool(FOR & set(words_after))),
        float(bool(AGAINST & set(words_after))),
        float(bool(QUIET & set(re.split(r"[^a-z]+", path.lower())))),
    ]


FOUND = "doc_id long, start long, stop long, digest string, features array<double>"


def _find(cost: list[float], known: frozenset[str]):
    """(doc_id, text, path) to one row for each candidate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in text_chunks(batch.column(1)):
                out: list[tuple] = []
                paths = batch.column(2).slice(first, len(offsets) - 1)
                ids = batch.column(0).slice(first, len(offsets) - 1)
                for row, a, b in candidates(data, offsets):
                    low, high = int(offsets[row]), int(offsets[row + 1])
                    value = data[a:b].tobytes()
                    before = data[max(low, a - AROUND) : a].tobytes().decode("utf-8", "replace")
                    after = data[b : min(high, b + AROUND)].tobytes().decode("utf-8", "replace")
                    about = describe(value.decode(), before, after, paths[row].as_py() or "", cost, known)
                    out.append((ids[row].as_py(), a - low, b - low, hashlib.sha256(value).hexdigest(), about))
                if out:
                    types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.float64()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                        ["doc_id", "start", "stop", "digest", "features"],
                    )

    return run


def word_list(docs: DataFrame, text: str, words: int) -> frozenset[str]:
    """The most frequent words of 4 to 12 letters a-z in all texts, at most ``words``."""
    each = F.explode(F.regexp_extract_all(F.col("body"), F.lit("(?<![A-Za-z0-9])[A-Za-z]{4,12}(?![A-Za-z0-9])"), F.lit(0)))
    counted = docs.select(docs[f"`{text}`"].alias("body")).select(each.alias("word")).groupBy("word").count()
    merged = counted.groupBy(F.lower("word").alias("word")).agg(F.sum("count").alias("n")).where("n >= 3")
    return frozenset(r[0] for r in merged.orderBy(F.col("n").desc(), "word").limit(words).collect())


def labelled_findings(spark: SparkSession, words: list[str], count: int = 3000, seed: int = 3) -> DataFrame:
    """Findings made by a rule: (value, before, after, path, secret).

    Secrets are random strings of usual alphabets in assignments; the others are
    checksums, addresses, numbers, identifiers built of words, and placeholders.
    """
    rng = np.random.default_rng(seed)
    words = words or ["word"]
    hexes, base, upper = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"

    def draw(alphabet: str, n: int) -> str:
        return "".join(alphabet[i] for i in rng.integers(0, len(alphabet), n))

    def word() -> str:
        return words[int(rng.integers(0, len(words)))]

    def one(options: list):
        return options[int(rng.integers(0, len(options)))]

    rows = []
    for i in range(count):
        before, after = f"{word()} {word()} ", f" {word()} {word()}"
        path = one(["src/app/settings.py", "config/prod.env", "source", "main/server.go", "deploy/values.yaml"])
        if i % 2 == 0:
            value = one([lambda: draw(hexes, 40), lambda: draw(hexes, 32), lambda: draw(base, 40), lambda: draw(base, 24) + "==", lambda: "AKIA" + draw(upper, 16), lambda: "ghp_" + draw(base, 36), lambda: draw(hexes, 40).upper()])()
            name = one(["token", "secret", "password", "api_key", "auth_token", "client_secret", "TOKEN", "access_key"])
            mark = one([" = ", "=", ": "])
            quote = one(['"', "'", '"'])
            before, after = before + name + mark + quote, quote + after
            if rng.random() < 0.1:
                before, after = f"{word()} bearer ", f" {word()}"
            secret = 1
        else:
            kind = int(rng.integers(0, 7))
            value = (
                lambda: draw(hexes, 40),
                lambda: draw(hexes, 64),
                lambda: f"{word()}{rng.integers(0, 99)}.{one(['example', 'mail', word()])}.{one(['com', 'org', 'net'])}",
                lambda: f"{draw(hexes, 8)}-{draw(hexes, 4)}-{draw(hexes, 4)}-{draw(hexes, 4)}-{draw(hexes, 12)}",
                lambda: "".join(word().capitalize() for _ in range(3)) + str(rng.integers(0, 99)),
                lambda: one(["changeme123456789", "your_token_here_123", "xxxxxxxxxxxxxxxx1234", "placeholder12345678", "0000000000000000abcd", "example_password_1"]),
                lambda: f"{word()}/{word()}/{word()}_{rng.integers(0, 9999)}.{one(['py', 'html', 'png'])}",
            )[kind]()
            if kind in (0, 1):
                before += one(["commit ", "sha1 ", "checksum: ", "sha256 = ", "digest ", "revision "])
            elif kind == 3:
                before += one(["uuid ", "id: ", "id = \"", ""])
            elif kind == 4:
                before += one(["class ", "def ", "", "import "])
            elif kind == 5:
                before += one(['token = "', "password: ", 'api_key = "'])
            elif kind == 2:
                before += one(["mail ", f"{word()}@", "http ", ""])
            if rng.random() < 0.3:
                path = one(["tests/test_app.py", "docs/index.md", "examples/demo.sh", "vendor/lib.js"])
            secret = 0
        rows.append((value, before, after, path, secret))
    return spark.createDataFrame(rows, "value string, before string, after string, path string, secret int")


def secret_scan(
    docs: DataFrame,
    findings: DataFrame | None = None,
    id: str = "doc_id",
    text: str = "text",
    path: str | None = "source",
    trees: int = 40,
    depth: int = 8,
    dictionary: int = 20_000,
    seed: int = 7,
) -> DataFrame:
    """One row for each candidate: doc_id, start, stop (UTF-8 bytes), digest, score, secret.

    ``findings`` has (value, before, after, path, secret 0/1); the rule's if none is given.
    """
    spark = docs.sparkSession
    cost = character_model(docs, text).tolist()
    known = word_list(docs, text, dictionary)
    if findings is None:
        findings = labelled_findings(spark, sorted(known))
    described = F.udf(lambda v, b, a, p: describe(v, b or "", a or "", p or "", cost, known), "array<double>")
    learnt = written(
        findings.where("length(value) > 0 AND secret IN (0, 1)").select(
            F.col("secret").cast("double").alias("secret"), array_to_vector(described("value", "before", "after", "path")).alias("vector")
        ),
        "secret-learnt",
    )
    rows = docs.select(
        docs[f"`{id}`"].cast("long").alias("doc_id"),
        docs[f"`{text}`"].alias("text"),
        (docs[f"`{path}`"].cast("string") if path else F.lit("")).alias("path"),
    )
    found = rows.mapInArrow(_find(cost, known), FOUND)
    if learnt.select("secret").distinct().count() < 2:
        return found.select("doc_id", "start", "stop", "digest", F.lit(0.5).alias("score"), F.lit(True).alias("secret"))
    forest = RandomForestClassifier(
        featuresCol="vector", labelCol="secret", predictionCol="guess", probabilityCol="chance", rawPredictionCol="votes",
        numTrees=trees, maxDepth=depth, seed=seed,
    ).fit(learnt)
    scored = forest.transform(found.withColumn("vector", array_to_vector("features")))
    score = vector_to_array("chance")[1]
    return scored.select("doc_id", "start", "stop", "digest", score.alias("score"), (score >= 0.5).alias("secret"))
