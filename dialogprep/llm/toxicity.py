"""Toxicity: disguised words are decoded by a noisy channel, and the restored text is scored."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogprep.llm.common import chunks, held_out, texts
from dialogprep.sources.storage import stage

#: Signs that stand for letters. "*" hides a vowel.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "*": "aeiou", "€": "e", "£": "l"}
BETWEEN = " \n._-*~'/\\"
#: Costs of the channel in nats: a sign for a letter, a separator put in, a letter repeated, a sign that is just that.
SIGN_COST, HIDDEN_COST, SEPARATOR_COST, REPEAT_COST, PLAIN_COST = 1.0, 2.0, 0.5, 0.5, 3.0
#: Letters that a part of a word split in two has at least, and the weight from which a word is looked for in parts.
PART, PART_WEIGHT = 2, 0.5

_SIGN = "[" + re.escape("".join(LEET)) + "]"
_LETTER = r"[^\W\d_]"
#: A sign between letters or before one, at a word's start or behind a quote; a letter three times, or two letters twice.
SIGNS = re.compile(rf"{_LETTER}{_SIGN}+{_LETTER}|(?<![^\W_]){_SIGN}+{_LETTER}")
REPEATS = re.compile(rf"({_LETTER})\1\1|({_LETTER})\2{_LETTER}*?({_LETTER})\3")
#: Signs behind a word's last letter, but for those that end sentences: they may be what they are.
ENDINGS = re.compile(rf"{_LETTER}[0134578@$€£]+(?![^\W_])")
#: Letters set apart by up to three separators each.
SPACED = re.compile(rf"(?<!\w)(?:{_LETTER}|{_SIGN})(?:[ \n._~*'/\\-]{{1,3}}(?:{_LETTER}|[0134578@$!])(?![^\W_])){{2,}}(?!\w)")
#: Words in parts that a sign joins.
JOINED = re.compile(r"[-/._*~'\\]+")

#: Symbols of the character model: 0 a word's edge, then a-z, the small letters of Latin-1, and any other letter.
LATIN = [chr(c) for c in range(0x61, 0x7B)] + [chr(c) for c in range(0xDF, 0x100) if c != 0xF7]
SYMBOL = {c: i + 1 for i, c in enumerate(LATIN)}
OTHER = len(LATIN) + 1
SIZE = OTHER + 1
_TABLE = np.zeros(0x100, dtype=np.int64)
for _c, _i in SYMBOL.items():
    _TABLE[ord(_c)] = _i

#: The classifier learns from about so many labelled rows, chosen by a hash, whatever the input's size.
LABELLED_ROWS = 20_000
HASHES = 1 << 60
#: Word features kept, with the least number of documents and the least chi-square for each.
FEATURES, LEAST_DOCS, LEAST_CHI2 = 4000, 8, 12.0
REMEMBERED = 1 << 18
PUNCTUATION = ".,;:!?\"'()[]{}<>|-_*#$%&/\\"


@dataclass
class CharacterModel:
    """Costs in nats of a symbol after two others, from smoothed counts over all documents."""

    cost: np.ndarray

    def plain(self, token: str) -> float:
        """The cost of the token as it is written: signs end words, and each has a cost of its own."""
        total, a, b = 0.0, 0, 0
        for char in token + " ":
            s = SYMBOL.get(char, OTHER if char.isalpha() else 0)
            total += self.cost[a, b, s] + (PLAIN_COST if char in LEET else 0.0)
            a, b = b, s
        return float(total)

    def decode(self, token: str) -> str:
        return self.read(token)[0]

    def read(self, token: str) -> tuple[str, float]:
        """The cheapest reading of the token, of all paths through its lattice, and its cost.

        A character is read as a letter that it may stand for, or left out as a separator or a repetition. The
        state of the Viterbi search is the last two symbols read; time is linear in the token's length.
        """
        cost = self.cost
        alive: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for char in token:
            options = [(char, 0.0)] if char.isalpha() else [(x, HIDDEN_COST if char == "*" else SIGN_COST) for x in LEET.get(char, "")]
            skip = SEPARATOR_COST if char in BETWEEN else None
            if not options and skip is None:
                options = [(char, 0.0)]
            now: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (spent, path) in alive.items():
                if skip is not None and now.get((a, b), (np.inf,))[0] > spent + skip:
                    now[a, b] = (spent + skip, path)
                for letter, extra in options:
                    s = SYMBOL.get(letter, OTHER if letter.isalpha() else 0)
                    total = spent + extra + cost[a, b, s]
                    if now.get((b, s), (np.inf,))[0] > total:
                        now[b, s] = (total, (path, letter))
                    if s == b and s and path and path[1] == letter and now.get((a, b), (np.inf,))[0] > spent + extra + REPEAT_COST:
                        now[a, b] = (spent + extra + REPEAT_COST, path)
            alive = now
        spent, path = min(((c + cost[a, b, 0], p) for (a, b), (c, p) in alive.items()), key=lambda x: x[0])
        out = []
        while path:
            path, letter = path
            out.append(letter)
        return "".join(reversed(out)), float(spent)


def symbols(many: list[str]) -> np.ndarray:
    """All characters of the texts as symbols, with edges around each text."""
    points = np.frombuffer("\n\n".join(["", *many, ""]).lower().encode("utf-32-le"), dtype=np.uint32)
    out = _TABLE[np.minimum(points, 0xFF)]
    high = points > 0xFF
    if high.any():
        kinds, back = np.unique(points[high], return_inverse=True)
        out[high] = np.array([OTHER if chr(c).isalpha() else 0 for c in kinds])[back]
    return out


def learn_characters(docs: DataFrame) -> CharacterModel:
    """Counts of three symbols over the whole texts of all rows; the table has SIZE**3 cells for any input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE**3, dtype=np.int64)
        for batch in chunks(batches):
            s = symbols(texts(batch))
            total += np.bincount((s[:-2] * SIZE + s[1:-1]) * SIZE + s[2:], minlength=SIZE**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["gram", "n"])

    rows = docs.select("text").mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    tri = np.zeros(SIZE**3)
    tri[rows["gram"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.float64)
    tri = tri.reshape(SIZE, SIZE, SIZE)
    two = tri.sum(axis=0)
    one = two.sum(axis=0)
    share = lambda x: x / np.maximum(x.sum(axis=-1, keepdims=True), 1)
    p = 0.8 * share(tri) + 0.17 * share(two)[None] + 0.02 * share(one)[None, None] + 0.01 / SIZE
    return CharacterModel(-np.log(p))


def disguised(text: str) -> list[tuple[int, int]]:
    """Spans of lower-case text that may hide a word, apart from each other, in order."""
    spans = [m.span() for m in SPACED.finditer(text)]
    for m in (*SIGNS.finditer(text), *REPEATS.finditer(text), *ENDINGS.finditer(text)):
        a, b = m.span()
        while a and not text[a - 1].isspace():
            a -= 1
        while b < len(text) and not text[b].isspace():
            b += 1
        spans.append((a, b))
    out: list[tuple[int, int]] = []
    for a, b in sorted(set(spans)):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


@dataclass
class Scorer:
    """Weights of words and beginnings of words, over restored texts."""

    characters: CharacterModel
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -10.0
    known: dict[str, float] = field(default_factory=dict)
    read: dict[str, str] = field(default_factory=dict)
    parts: dict[tuple[str, str], str] = field(default_factory=dict)
    firsts: set[str] = field(default_factory=set)

    def weigh(self, weights: dict[str, float]) -> None:
        """Take the weights, and the parts that words of some weight may be split in, where the whole is the likelier reading."""
        self.weights = weights
        for word, weight in weights.items():
            if weight >= PART_WEIGHT and word.isalpha():
                whole = self.characters.plain(word) + SEPARATOR_COST
                for i in range(PART, len(word) - PART + 1):
                    if whole < self.characters.plain(word[:i]) + self.characters.plain(word[i:]):
                        self.parts[word[:i], word[i:]] = word
        self.firsts = {a for a, _ in self.parts}

    def restore(self, text: str) -> str:
        """The text in lower case, with each disguised span decoded.

        A span whose only signs stand at its end stays as it is where that is the likelier reading.
        """
        text = text.lower()
        out, at = [], 0
        for a, b in disguised(text):
            token = text[a:b]
            plain = self.read.get(token)
            if plain is None:
                plain, cost = self.characters.read(token)
                if not (SIGNS.search(token) or SPACED.search(token)) and ENDINGS.search(token) and cost >= self.characters.plain(token):
                    plain = token
                if len(self.read) < REMEMBERED and len(token) < 64:
                    self.read[token] = plain
            out += [text[at:a], plain]
            at = b
        return "".join([*out, text[at:]])

    def words(self, text: str) -> set[str]:
        """The words of the restored text, and those that stand in it in two parts."""
        tokens = self.restore(text).split()
        own = {w.strip(PUNCTUATION) for w in set(tokens)}
        if self.parts:
            if not self.firsts.isdisjoint(own):
                clean = [w.strip(PUNCTUATION) for w in tokens]
                own.update([self.parts[pair] for pair in set(zip(clean, clean[1:], strict=False)) if pair in self.parts])
            for word in [w for w in own if not w.isalpha()]:
                pieces = JOINED.split(word)
                if len(pieces) > 1 and "".join(pieces) in self.weights:
                    own.add("".join(pieces))
        return own

    def score(self, text: str) -> float:
        known, total = self.known, self.bias
        for word in self.words(text):
            w = known.get(word)
            if w is None:
                w = sum(self.weights.get(f, 0.0) for f in features(word))
                if len(known) < REMEMBERED:
                    known[word] = w
            total += w
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def features(word: str) -> list[str]:
    return ([word] if word else []) + [f"{word[:n]}~" for n in (4, 5, 6) if len(word) > n]


def learn(docs: DataFrame, labels: DataFrame) -> Scorer:
    """The character model of all texts, and a classifier of about LABELLED_ROWS labelled rows not held out.

    A null label teaches nothing; of several labels of one id, the greatest counts. The ids of the chosen rows
    are broadcast, as their number is bounded, and the rows are written once, as they are read three times. Features are first chosen by chi-square from counts of
    documents, summed before they are shuffled; only those that speak for a label of 1 are kept, so a long
    text is not taken for clean because it is long. Without labels every score is near 0.
    """
    scorer = Scorer(learn_characters(docs))
    wanted = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    share = LABELLED_ROWS / max(1, wanted.count())
    chosen = wanted.where(F.pmod(F.xxhash64("doc_id"), F.lit(HASHES)) < int(HASHES * min(1.0, share)))
    chosen = chosen.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic").dropDuplicates(["text", "toxic"])
    rows = stage(rows.repartition(max(2, min(64, docs.sparkSession.sparkContext.defaultParallelism))), "labelled")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, limit=8 << 20):
            found: dict[str, list[int]] = {}
            for text, toxic in zip(texts(batch), batch.column("toxic").to_pylist(), strict=True):
                for f in {f for w in scorer.words(text) for f in features(w)}:
                    found.setdefault(f, [0, 0])[toxic > 0] += 1
            columns = [pa.array(list(found), pa.string()), *(pa.array([v[i] for v in found.values()], pa.int64()) for i in (0, 1))]
            yield pa.RecordBatch.from_arrays(columns, ["feature", "clean", "toxic"])

    sizes = {bool(r["t"]): r["n"] for r in rows.groupBy((F.col("toxic") > 0).alias("t")).agg(F.count("*").alias("n")).collect()}
    clean, toxic = sizes.get(False, 0), sizes.get(True, 0)
    if not clean or not toxic:
        return scorer
    n = clean + toxic
    a, b = F.col("toxic"), F.col("clean")
    apart = (a * (clean - b) - b * (toxic - a)).cast("double")
    chi2 = F.lit(float(n)) * apart * apart / ((a + b) * F.lit(float(toxic)) * F.lit(float(clean)) * (F.lit(n) - a - b + F.lit(0.5)))
    found = rows.mapInArrow(count, "feature string, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    likelier = a * clean > b * toxic
    found = found.where(likelier & (a + b >= LEAST_DOCS) & (chi2 >= LEAST_CHI2)).orderBy(chi2.desc(), "feature").limit(FEATURES)
    names = sorted(r["feature"] for r in found.select("feature").collect())
    index = {f: i for i, f in enumerate(names)}

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            own = [sorted(index[f] for w in scorer.words(t) for f in features(w) if f in index) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.list_(pa.int32())), batch.column("toxic")], ["own", "toxic"])

    seen = rows.mapInArrow(look, "own array<int>, toxic int").toPandas().sort_values("toxic", kind="stable")
    weights, scorer.bias = _logistic([np.asarray(o, dtype=np.int64) for o in seen["own"]], (seen["toxic"] > 0).to_numpy(dtype=np.float64), len(names))
    scorer.weigh(dict(zip(names, weights.tolist(), strict=True)))
    return scorer


def _logistic(rows: list[np.ndarray], y: np.ndarray, width: int, ridge: float = 1e-6, steps: int = 600) -> tuple[np.ndarray, float]:
    """Logistic regression by accelerated gradient steps, without negative weights."""
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.concatenate([*rows, np.empty(0, np.int64)])
    w, b, vw, vb, n = np.zeros(width), 0.0, np.zeros(width), 0.0, len(y)
    sw, sb = np.full(width, 1e-8), 1e-8
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(b + np.bincount(row, weights=w[column], minlength=n), -30, 30)))
        gw = np.bincount(column, weights=(p - y)[row], minlength=width) / n + ridge * w
        gb = float((p - y).mean())
        vw, vb = 0.9 * vw + 0.1 * gw, 0.9 * vb + 0.1 * gb
        sw, sb = 0.99 * sw + 0.01 * gw**2, 0.99 * sb + 0.01 * gb**2
        rate = 0.05 * np.sqrt(1 - 0.99**t) / (1 - 0.9**t)
        w, b = np.maximum(w - rate * vw / np.sqrt(sw), 0), b - rate * vb / np.sqrt(sb)
    return w, b


def score_documents(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """(doc_id, score, predicted) of each row: 0 to 1, and 1 where it is at least 0.5.

    The whole text is restored and scored; null is the empty text, which gets the score of no word. Rows are not
    moved, repeated rows get equal scores, other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(scorer)  # a table of fixed size and FEATURES weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in chunks(batches):
            score = np.array([own.score(t) for t in texts(batch)], dtype=np.float64)
            columns = [batch.column("doc_id"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "predicted"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double, predicted int")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with their columns; the decision is made in the row's task."""
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, labels))

    @F.pandas_udf("boolean")
    def clean(text):  # noqa: ANN001, ANN202
        return text.fillna("").map(lambda t: shared.value.score(t) < 0.5).astype(bool)

    return docs.where(clean("text"))
