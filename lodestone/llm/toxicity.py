"""Toxicity: noisy-channel deobfuscation, then scoring.

A character trigram model (counts over every text of the table) is the source; the channel
writes letters as look-alikes (of one mark or several, or of another script), spreads a word out with separators and repeats letters. A token
that shows such marks becomes a lattice (keep, substitute, drop), and Viterbi finds the most
likely letters. A token without marks has a lattice of one path, itself, and isn't decoded.
A separator between letters may also stand for a word break: a second lattice joins or parts
the letters there, by the words of the labelled texts and the trigrams of words unknown to
them. Tokens and runs of spaced-out letters are decoded whole, and all their words are scored.
The restored text is scored by a logistic model over its words and their stems (prefixes),
picked and weighted on all labelled texts outside fold 0: what each task counts is summed, and
Spark's logistic regression passes over the texts' features.

Cases: a null or empty text has no word and gets the score of the bias. Without labels of
both kinds every score is the share of toxic labels, or 0.5; so it is where these labels have no
texts, or texts without a common word. Repeated ids in the labels are averaged, a tie counts as toxic;
of an id's rows each text counts once. Very long texts are read whole.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator
from itertools import groupby
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_scratch, fold, map_texts, scratch, text_chunks

FEATURES = 1_500
STEMS = (4, 5, 6, 7)
#: Weight of the squared norm, to be divided by the number of texts: evidence adds up over them, the norm doesn't. From 0.12 to 0.24 the loss is the same within 1 % in four-fold cross-validation over the labelled texts of sf0.1 outside fold 0.
DECAY = 0.15

# --- source model: letters in 64 classes -------------------------------------------------
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
OTHER = 63
_CLASS = np.zeros(0x250, np.uint32)
for _i, _c in enumerate(LETTERS, 1):
    _CLASS[ord(_c)] = _i
    if len(_c.upper()) == 1 and ord(_c.upper()) < 0x250:
        _CLASS[ord(_c.upper())] = _i
for _i in range(0x100, 0x250):
    _CLASS[_i] = OTHER
_INDEX = {c: i for i, c in enumerate(LETTERS, 1)}


def trigram_counts(df: DataFrame, text_col: str = "text") -> np.ndarray:
    """Counts of the 64^3 trigrams over all texts; each task adds up its own before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 18, np.int64)
        for batch in batches:
            for _, texts in text_chunks(batch, 0):
                points = np.frombuffer("\n".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
                c = _CLASS[np.minimum(points, 0x24F)]
                c[(points >= 0x3000)] = OTHER
                if len(c) > 2:
                    total += np.bincount(c[:-2] << 12 | c[1:-1] << 6 | c[2:], minlength=1 << 18)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["code", "n"])

    counted = df.select(F.col(f"`{text_col}`").cast("string").alias("t")).mapInArrow(run, "code int, n long").groupBy("code").agg(F.sum("n").alias("n"))
    out = np.zeros(1 << 18, np.int64)
    for row in counted.toPandas().itertuples():  # at most 64^3 rows
        out[row.code] = row.n
    return out


def log_probabilities(counts: np.ndarray) -> np.ndarray:
    """-log P(c | a, b), interpolated with lower orders."""
    tri = counts.reshape(64, 64, 64).astype(np.float64)
    bi, uni = tri.sum(axis=0), tri.sum(axis=(0, 1)) + 1.0
    p1 = uni / uni.sum()
    p2 = (bi + 5 * p1) / (bi.sum(axis=1, keepdims=True) + 5)
    p3 = (tri + 5 * p2[None]) / (tri.sum(axis=2, keepdims=True) + 5)
    return -np.log(p3).astype(np.float32)


# --- channel -----------------------------------------------------------------------------
#: What may stand for a letter (fixed values).
HOMOGLYPHS = {"а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x"}
SEVERAL = {"|\\/|": "m", "/\\/\\": "m", "\\/\\/": "w", "|\\|": "n", "/\\": "a", "\\/": "v", "|<": "k", "|)": "d", "|3": "b", "()": "o", "[]": "o", "vv": "w"}
LOOKALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
#: Wide forms of a-z.
HOMOGLYPHS |= {chr(0xFF41 + i): chr(97 + i) for i in range(26)}
SUBSTITUTE, KEEP_MARK, DROP_SEPARATOR, DROP_REPEAT = 1.5, 14.0, 1.0, 0.7
#: Cost of a word that isn't known, beside its trigrams.
UNKNOWN = 4.0
#: Words of the labelled texts that are known at most, of up to 64 letters.
LEXICON = 50_000
_SEPARATORS = set(" .-_*~'`^,:;/\\#")
#: Three letters or more spaced out, over several tokens, and the space before them.
_SPACED = re.compile(r"\s(\w[ .\-_*]\w[ .\-_*]\w(?:[ .\-_*]\w)*)(?![^\s])")
#: A token with look-alikes or separators between letters, or three of a letter.
_SUSPECT = re.compile(r"[^\W\d_][0-9@$!|+(€£.\-_*~^]{1,4}[^\W\d_]|[0-9@$!|€£][.\-_*~^]?[^\W\d_]|[^\W\d_][0-9@$!|+]*[0-9@$+](?:[.,!?;:]|$)|([^\W\d_])\1\1")
#: Letters of several marks; letters of two scripts in a token.
_SEVERAL = re.compile("[^\\W\\d_](?:%s)|(?:%s)[^\\W\\d_]" % (("|".join(map(re.escape, sorted((x for x in SEVERAL if not x.isalpha()), key=len, reverse=True))),) * 2))
_MIXED = re.compile("[a-z][%s]|[%s][a-z]|[\uff41-\uff5a]{3}" % (("".join(HOMOGLYPHS),) * 2))
#: Punctuation around a token: runs of one mark, or long ones.
_EDGES = re.compile(r"^(?:([^\w\s])\1+|\W{3,})|(?:([^\w\s])\2+|\W{3,})$")
_WORD = re.compile(r"[^\W\d_]+")
#: A word with marks around it that stand for no letter: what most tokens are. None of the patterns above finds anything in it, but for three of a letter.
_PLAIN = re.compile(r"[\"'(]*([a-zß-öø-ÿ]+)[.,;:!?\"')]*")
_THRICE = re.compile(r"(.)\1\1")
_STARTS = {x[0] for x in SEVERAL}


class Restorer:
    """Viterbi decoding of marked tokens; decoded tokens are kept in a table of bounded size."""

    #: Characters of a token above which its decoding isn't kept, and of a path above which what all paths share is put aside.
    KEPT, AHEAD = 128, 64

    def __init__(self, cost: np.ndarray, lexicon: dict[str, float] | None = None):
        self.cost, self.lexicon = cost, lexicon or {}
        self.longest = max(map(len, self.lexicon), default=0)
        self.known: dict[str, str] = {}

    def decode(self, token: str) -> str:
        if token in self.known:
            return self.known[token]
        if len(token) > self.KEPT:
            return self.viterbi(token)
        if len(self.known) > 200_000:
            self.known.clear()
        out = self.known[token] = self.viterbi(token)
        return out

    def viterbi(self, token: str) -> str:
        """The most likely letters behind a token, and its words, parted by spaces."""
        cost, done, ahead = self.cost, [], 0
        # a state is the last two classes and the last observed letter; its value the cost and the path
        states: dict[tuple[int, int, str], tuple[float, str]] = {(0, 0, ""): (0.0, "")}
        # only a character that stands three times or more, but for separators, may be a repetition
        runs = [(c, len(list(g))) for c, g in groupby(c for c in token if c not in _SEPARATORS)]
        often = iter([n >= 3 for _, n in runs for _ in range(n)])
        # states of characters further on, where letters of several marks end
        later: dict[int, dict[tuple[int, int, str], tuple[float, str]]] = {}
        for i, ch in enumerate(token):
            for x, letter in SEVERAL.items() if ch in _STARTS else ():
                if token.startswith(x, i):
                    k, ends = _INDEX[letter], later.setdefault(i + len(x), {})
                    for (a, b, _), (c, path) in states.items():
                        key, now = (b, k, letter), (c + SUBSTITUTE + float(cost[a, b, k]), path + letter)
                        if key not in ends or now < ends[key]:
                            ends[key] = now
            repeated = ch not in _SEPARATORS and next(often)
            mark = " " if ch in _SEPARATORS else ""
            moves: list[tuple[str | None, float]] = []  # letter (None: nothing is written), channel cost
            if ch in _INDEX or ch.isalpha():
                moves.append((ch, 0.0))
                if ch in HOMOGLYPHS:
                    moves.append((HOMOGLYPHS[ch], SUBSTITUTE))
            else:
                moves += [(x, SUBSTITUTE) for x in LOOKALIKES.get(ch, "")]
                moves.append((None, DROP_SEPARATOR) if ch in _SEPARATORS else (None, KEEP_MARK))
            then: dict[tuple[int, int, str], tuple[float, str]] = {}
            for (a, b, last), (c, path) in states.items():
                for letter, price in moves:
                    if letter is None:
                        key, now = (a, b, last), (c + price, path + mark)
                        if key not in then or now < then[key]:
                            then[key] = now
                        continue
                    k = _INDEX.get(letter, OTHER)
                    key, now = (b, k, letter), (c + price + float(cost[a, b, k]), path + letter)
                    if key not in then or now < then[key]:
                        then[key] = now
                    if repeated and letter == last:
                        key, now = (a, b, last), (c + price + DROP_REPEAT, path)
                        if key not in then or now < then[key]:
                            then[key] = now
            for key, now in later.pop(i + 1, {}).items():
                if key not in then or now < then[key]:
                    then[key] = now
            states, ahead = then, ahead + 1
            if ahead >= self.AHEAD and not later:
                # no later character changes what all paths begin with
                shared, ahead = commonprefix([path for _, path in states.values()]), 0
                done.append(shared)
                states = {key: (c, path[len(shared) :]) for key, (c, path) in states.items()}
        ends = [(c + float(cost[a, b, 0]), path) for (a, b, _), (c, path) in states.items()]
        groups = [g for g in "".join([*done, min(ends)[1]]).split(" ") if g]
        return self.parted(groups) if len(groups) > 1 else "".join(groups)

    def parted(self, groups: list[str]) -> str:
        """Groups of letters as the most likely words, each of one group or more."""
        cost, lexicon = self.cost, self.lexicon
        classes = [[_INDEX.get(x, OTHER) for x in g] for g in groups]
        best, back = [0.0], [0]
        # unknown words that are still open: of one letter, of more; each with its cost, first group and last two classes
        opened: list[tuple[float, int, int, int]] = []
        for i, group in enumerate(classes):
            then: dict[bool, tuple[float, int, int, int]] = {}
            for c, start, a, b in [(best[i] + UNKNOWN, i, 0, 0), *opened]:
                for k in group:
                    c, a, b = c + float(cost[a, b, k]), b, k
                now = (c, start, a, b)
                if (a > 0) not in then or now < then[a > 0]:
                    then[a > 0] = now
            opened = list(then.values())
            least = min((c + float(cost[a, b, 0]), start) for c, start, a, b in opened)
            word = ""
            for j in range(i, -1, -1):
                word = groups[j] + word
                if len(word) > self.longest:
                    break
                if word in lexicon:
                    least = min(least, (best[j] + lexicon[word], j))
            best.append(least[0])
            back.append(least[1])
        words, i = [], len(groups)
        while i:
            words.append("".join(groups[back[i] : i]))
            i = back[i]
        return " ".join(reversed(words))

    def words_of(self, token: str) -> list[str]:
        """The words of a token of a lower-case text, decoded if it is marked."""
        plain = _PLAIN.fullmatch(token)
        if plain and not _THRICE.search(plain[1]):
            return [plain[1]]
        if _SEVERAL.search(token) or _MIXED.search(token):
            return _WORD.findall(self.decode(token))
        if _SUSPECT.search(token):
            core = _EDGES.sub("", token)
            if core and _SUSPECT.search(core):
                return _WORD.findall(self.decode(core))
        return _WORD.findall(token)

    def tokens(self, text: str) -> set[str]:
        """The distinct tokens of a text in lower case; letters spaced out are a token too, without what parts them."""
        text = text.lower()
        out = set(text.split())
        for m in _SPACED.finditer(" " + text):
            if any(c.isalpha() for c in m[1]):
                out.add("\0" + m[1])
        return out

    def words(self, text: str) -> set[str]:
        out: set[str] = set()
        for token in self.tokens(text):
            out.update(self.parts(token))
        return out

    def parts(self, token: str) -> list[str]:
        return _WORD.findall(self.decode(token[1:])) if token[0] == "\0" else self.words_of(token)


# --- score -------------------------------------------------------------------------------
def with_stems(word: str) -> list[str]:
    return [word, *[word[:k] + "~" for k in STEMS if len(word) > k]]


def features(words: set[str]) -> set[str]:
    return {f for word in words for f in with_stems(word)}


class Model:
    def __init__(self, cost: np.ndarray, vocabulary: list[str], weights: np.ndarray, bias: float, lexicon: dict[str, float] | None = None):
        self.cost, self.weights, self.bias, self.lexicon = cost, weights, bias, lexicon
        self.index = {f: i for i, f in enumerate(vocabulary)}

    def scorer(self) -> "Scorer":
        return Scorer(self)


class Scorer:
    def __init__(self, model: Model):
        self.model, self.restorer = model, Restorer(model.cost, model.lexicon)
        #: Features of tokens, and tokens without any, which are most.
        self.hits: dict[str, tuple[int, ...]] = {}
        self.nothing: set[str] = set()
        #: What all words begin with that hold a feature of the model.
        self.starts = {f[: STEMS[0]] for f in model.index}

    def indexes(self, text: str) -> set[int]:
        """The model's features in a text."""
        hits, nothing, index, starts, out = self.hits, self.nothing, self.model.index, self.starts, set()
        if len(hits) + len(nothing) > 400_000:
            hits.clear()
            nothing.clear()
        for token in self.restorer.tokens(text) - nothing:
            found = hits.get(token)
            if found is None:
                found = tuple({index[f] for word in self.restorer.parts(token) if word[: STEMS[0]] in starts for f in with_stems(word) if f in index})
                if len(token) <= Restorer.KEPT:
                    if found:
                        hits[token] = found
                    else:
                        nothing.add(token)
            out.update(found)
        return out

    def score(self, text: str) -> float:
        z = self.model.bias + sum(self.model.weights[i] for i in self.indexes(text))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


#: Features that a task counts, and times that it finds one, before it sends counts on; tokens whose features it keeps.
COUNTED, FOUND, TOKENS = 300_000, 10_000_000, 100_000


def holders(seen: DataFrame, make: Callable[[], Restorer]) -> DataFrame:
    """(f, p, q): the numbers of toxic and other texts that hold a feature; each task adds up its own before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # features are numbered; found are the numbers of each text of a label, one text after another
        restorer, known, number, found = make(), {}, {}, (array("i"), array("i"))

        def counted() -> pa.RecordBatch:
            q, p = (np.bincount(np.frombuffer(x, np.int32), minlength=len(number)) for x in found)
            return pa.RecordBatch.from_arrays([pa.array(list(number), pa.string()), pa.array(p, pa.int64()), pa.array(q, pa.int64())], names=["f", "p", "q"])

        for batch in batches:
            labels = batch.column(0).to_pylist()
            for start, texts in text_chunks(batch, 1):
                for y, text in zip(labels[start:], texts):
                    if len(known) > TOKENS:
                        known.clear()
                    tokens = restorer.tokens(text)
                    new = tokens.difference(known)
                    for token in new:
                        known[token] = tuple([number.setdefault(f, len(number)) for word in restorer.parts(token) for f in with_stems(word)])
                    found[y].extend(set().union(*map(known.__getitem__, tokens)))
                    for token in new:
                        if len(token) > Restorer.KEPT:
                            del known[token]
                    if len(number) > COUNTED or len(found[0]) + len(found[1]) > FOUND:
                        yield counted()
                        known, number, found = {}, {}, (array("i"), array("i"))
        yield counted()

    return seen.select("__y", F.col("__t").cast("string")).mapInArrow(run, "f string, p long, q long").groupBy("f").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))


def fit_logistic(rows: DataFrame, vocabulary: list[str], weight: dict[int, float], decay: float, steps: int = 100) -> tuple[np.ndarray, float]:
    """Weights and bias from rows (__y, f) of a label and the features held."""
    x = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="f", outputCol="x").setBinary(True).transform(rows)
    x = x.select("x", F.col("__y").cast("double").alias("y"), F.when(F.col("__y") == 1, weight[1]).otherwise(weight[0]).alias("w"))
    fitted = LogisticRegression(featuresCol="x", labelCol="y", weightCol="w", maxIter=steps, regParam=decay, standardization=False).fit(x)
    return fitted.coefficients.toArray(), float(fitted.intercept)


def labelled(df: DataFrame, known: DataFrame, id_col: str, text_col: str, sample: dict[int, int] | None) -> DataFrame:
    """(__y, __t): the texts of known ids (__id, __y), of an id's rows each text once; with `sample` of each kind as many at most."""
    if sample:
        picked = [known.where(F.col("__y") == y).orderBy(F.xxhash64("__id"), "__id").limit(k) for y, k in sample.items()]
        known = picked[0].unionByName(picked[1])
    texts = df.where(fold(id_col) != 0).select(F.col(f"`{id_col}`").alias("__doc"), F.col(f"`{text_col}`").alias("__t"), F.xxhash64(F.col(f"`{text_col}`")).alias("__h"))
    of_ids = texts.join(known, F.col("__doc") == F.col("__id"))
    if sample:
        each = of_ids.select("__doc", "__h", "__y").distinct()
        chosen = [each.where(F.col("__y") == y).orderBy(F.xxhash64("__doc", "__h"), "__doc", "__h").limit(k) for y, k in sample.items()]
        of_ids = of_ids.join(F.broadcast(chosen[0].unionByName(chosen[1]).select("__doc", "__h")), ["__doc", "__h"], "left_semi")
    return of_ids.dropDuplicates(["__doc", "__h"]).select("__y", "__t")


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: dict[int, int] | None = None, size: int = FEATURES) -> Model:
    """Source model from all texts; features and weights from all labelled texts outside fold 0 (a caller may bound them by `sample`)."""
    spark = df.sparkSession
    cost = log_probabilities(trigram_counts(df, text_col))
    known = labels.where(fold(id_col) != 0).groupBy(F.col(id_col).alias("__id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("__y"))
    known = known.where("__y IS NOT NULL")
    n = {r["__y"]: r["count"] for r in known.groupBy("__y").count().collect()}
    share = 0.5 if not n else n.get(1, 0) / sum(n.values())
    flat = Model(cost, [], np.zeros(0), float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    if not n.get(0) or not n.get(1):
        return flat
    at, held_at = scratch(spark, "toxicity-labelled"), scratch(spark, "toxicity-features")
    labelled(df, known, id_col, text_col, sample).write.parquet(at)
    seen = spark.read.parquet(at)
    m = {r["__y"]: r["count"] for r in seen.groupBy("__y").count().collect()}
    if not m.get(0) or not m.get(1):
        return flat
    split = F.explode(F.regexp_extract_all(F.lower("__t"), F.lit(r"(\p{L}+)"), 1)).alias("w")
    spoken = seen.select(split).groupBy("w").count().where("count > 1 AND length(w) <= 64").orderBy(F.desc("count"), "w").limit(LEXICON).collect()
    total = sum(r["count"] for r in spoken)
    lexicon = {r.w: float(np.log(total / r["count"])) for r in spoken}
    shared = spark.sparkContext.broadcast((cost, lexicon))
    a, b = float(m[1]), float(m[0])
    # words of toxic texts: what only others hold says little
    rate = (F.col("p") / a - F.col("q") / b) / F.sqrt((F.col("p") + F.col("q") + 2) / (a + b) / min(a, b))
    vocabulary = [r.f for r in holders(seen, lambda: Restorer(*shared.value)).where("p + q >= 4").orderBy(rate.desc(), "f").limit(size).collect()]
    if not vocabulary:
        return flat
    model = Model(cost, vocabulary, np.zeros(len(vocabulary)), 0.0, lexicon)
    held = spark.sparkContext.broadcast(model)
    # the fit passes over these rows, not over the texts
    map_texts(seen, ["__y"], "__t", "f array<string>", lambda texts, s: [([vocabulary[i] for i in sorted(s.indexes(t))],) for t in texts], lambda: held.value.scorer()).write.parquet(held_at)
    weight = {y: n[y] / m[y] * (m[0] + m[1]) / (n[0] + n[1]) for y in (0, 1)}
    model.weights, model.bias = fit_logistic(spark.read.parquet(held_at), vocabulary, weight, DECAY / (m[0] + m[1]))
    for path in (at, held_at):
        drop_scratch(spark, path)
    return model


def classify(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """id, held_out, score, predicted."""
    shared = df.sparkSession.sparkContext.broadcast(train(df, labels, id_col, text_col))
    out = map_texts(df, [id_col], text_col, "score double", lambda texts, s: [(s.score(t),) for t in texts], lambda: shared.value.scorer())
    return out.select(id_col, (fold(id_col) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
