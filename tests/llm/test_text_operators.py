"""Secrets, toxicity, quality, BPE, decontamination, sharding and media."""

import base64
import hashlib
import random
import re
import struct
import time
import zlib
from types import SimpleNamespace

import duckdb
import numpy as np
import pytest
import public_tokenizers as P
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestone.llm import bpe, decontaminate, media, quality, queries, secrets, sharding, toxicity
from lodestone.llm.common import fold

SF = "/root/testdata/sf0.01"
LONG = "word " * 60_000


def docs(spark, rows):
    """With columns whose names clash with inner ones."""
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, x int, score string")


# --- secrets
def spans(text):
    return {(k, text[a:b]) for k, a, b in secrets.scan_text(text)[1]}


def test_lexing():
    assert ("lexed", "Zk29slLw02Kd81ma") in spans('"client_secret": "Zk29slLw02Kd81ma"')
    assert ("lexed", "9f8a7Kd02mNq83Lz") in spans("export DB_PASSWORD=9f8a7Kd02mNq83Lz")
    assert {("propagated", "a8Kd93jLq0"), ("lexed", "zz91KqP0")} <= spans('BASE = "a8Kd93jLq0"\nx = BASE\npassword = x + "zz91KqP0"')
    assert spans('password = "changeme"') == spans('colour = "Zk29slLw02Kd81ma"') == spans("The token of the church") == set()


@pytest.mark.parametrize("pair", ['tok_en = "x8Kd93jfLQ02mzPq7"', 'pw_d = "x8Kd93jfLQ02mzPq7"', 'client.secret = "x8Kd93jfLQ02mzPq7"', "API-KEY: 'x8Kd93jfLQ02mzPq7'"])
@settings(max_examples=40, deadline=None)
@given(before=st.text(alphabet="ab monkey\n.", max_size=20), after=st.text(alphabet="ab key\n", max_size=20))
def test_what_stands_around_a_pair_changes_nothing(pair, before, after):
    own = lambda text, a: {(k, x - a, y - a) for k, x, y in secrets.lexed_spans(text) if a <= x and y <= a + len(pair)}
    assert own(pair, 0) and own(before + "\n" + pair + "\n" + after, len(before) + 1) == own(pair, 0)


def test_comments_are_blank_outside_and_texts_inside():
    assert ("lexed", "x8Kd93jfLQ02mzPq7") in spans('password /* a */ = /* "b */ "x8Kd93jfLQ02mzPq7"') & spans('/* password = "x8Kd93jfLQ02mzPq7" */ x') & spans('g = "src/*.py"; password = "x8Kd93jfLQ02mzPq7"; h = "*/"')


@pytest.mark.parametrize("unit", ["key x /* ", 'key = " ', "key = ` ", 'key="""', "key: |\n ", "*/ /*", "key = " + "'" * 3 + "\\", 'key = ("a" + '])
def test_lexing_is_linear(unit):
    def seconds(n):
        began = time.process_time()
        secrets.scan_text(unit * n)
        return time.process_time() - began

    assert seconds(80_000) < 40 * max(0.05, seconds(8_000))  # ten times the text; a square would be a hundred


def test_long_chains_and_names():
    pieces = [f"{i:03}Kq" for i in range(200)]
    chain = "x = ''\n" + "".join(f"x = x + '{p}'\n" for p in pieces)
    assert spans(chain + "password = x") == {("propagated", p) for p in pieces}
    assert spans("x = " + " + ".join(f"'{p}'" for p in pieces) + "\ny = x\npassword = y + 'tail'") == {("propagated", p) for p in pieces} | {("lexed", "tail")}
    assert secrets.redact(chain + "password = x", secrets.scan_text(chain + "password = x")[1]).count("[SECRET]") == 200
    assert spans("a_" * 200 + "pwd = 'Zk29slLw02Kd81ma'") == {("lexed", "Zk29slLw02Kd81ma")}
    assert spans("n" * 300 + " = 'Zk29slLw02Kd81ma'\npwd = " + "n" * 300) == {("propagated", "Zk29slLw02Kd81ma")}
    assert spans("x = 'aK3x9Q'\n" + "x = x + x\n" * 20_000 + "password = x") == {("propagated", "aK3x9Q")} == spans("x = 'aK3x9Q'\n" + "x = x + x\n" * 3 + "password_key = x")
    assert len(spans("".join(f"key_token = key_token + '{i:05}Kq9x'\n" for i in range(20_000)))) >= 20_000


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "password", "key"]), st.lists(st.sampled_from(["a", "b", "password", "'k9Q'", "'Zk29slLw'", "''", "xx", "'<'", "'>'", "'your_'"]), min_size=1, max_size=4)), max_size=8))
def test_values_against_joined_literals(lines):
    text = "api secret\n" + "\n".join(f"{n} = {' + '.join(v)}" for n, v in lines)
    at, found, begun, want = len("api secret\n"), {}, set(), {}
    places = []
    for n, v in lines:
        at += len(n) + 3
        places.append([])
        for x in v:
            places[-1].append((at, at + len(x)))
            at += len(x) + 3
        at += 1 - 3

    def value(k):
        """Pieces (begin, end, text, of another name) of a line."""
        if k in begun:
            return found.get(k, [])
        begun.add(k)
        out = []
        for x, (a, b) in zip(lines[k][1], places[k], strict=True):
            own = [j for j, (n, _) in enumerate(lines) if n == x]
            before, after = [j for j in own if j < k], [j for j in own if j > k and lines[k][0] != x]
            if before or after:
                out += [(*p[:3], True) for p in value(before[-1] if before else after[0])]
            elif not own or k in own:
                out.append((a + 1, b - 1, x[1:-1], False) if x[0] == "'" else (a, b, x, False))
        found[k] = out
        return out

    for k, (n, _) in enumerate(lines):
        if secrets.name_weight(n) * secrets.randomness("".join(x[2] for x in value(k))) >= 0.45:
            for a, b, _, moved in value(k):
                if a < b and want.get((a, b)) != "lexed":
                    want[a, b] = "propagated" if moved else "lexed"
    assert {(a, b): k for k, a, b in secrets.lexed_spans(text)} == want


def test_lexing_of_several_lines_and_orders():
    key, tail = "Zk3vQ9xP2mL8wR5t", "Hh7Jj2Kk9Ll4Mm1N"
    for text in (
        f'SECRET_KEY = """{key}"""', f"secret_key = '''{key}'''", f'password /* of the db */ = /* now */ "{key}"', f'api_token = r"{key}"',
        f"signing_secret: |\n    {key}\n", f'db_password = (\n    "{key}"\n)', f"access_token: `{key}`",
    ):
        assert ("lexed", key) in spans(text), text
    assert {("lexed", key), ("lexed", tail)} <= spans(f'auth_token = "{key}" \\\n    "{tail}"') and {("lexed", key), ("lexed", tail)} <= spans(f'auth_token = "{key}" +\n  "{tail}"')
    # a constant that is defined below its use, through another one; of several the last before the use
    assert ("propagated", key) in spans(f'connect(password=BASE)\nBASE = OTHER\nOTHER = "{key}"')
    found = spans(f'BASE = "{tail}"\nBASE = "{key}"\npassword = BASE\nBASE = "{tail}"')
    assert ("propagated", key) in found and ("propagated", tail) not in found
    assert spans("password = a\na = b\nb = a") == set() and spans("secret = secret") == set()
    chain = "\n".join([f"password = n0", *(f"n{k} = n{k + 1}" for k in range(5000)), f'n5000 = "{key}"'])
    assert ("propagated", key) in spans(chain)
    long = "p" * 200 + "_password"
    assert ("lexed", key) in spans(f'{long} = "{key}"')
    pieces = "\n".join([*(f'v{k} = "{key[k % 9:]}{k}"' for k in range(70)), "password = " + " + ".join(f"v{k}" for k in range(70))])
    assert sum(k == "propagated" for k, _ in spans(pieces)) == 70


def test_base_patterns():
    t = "API_KEY = 'abcdefghijkl' x=tokens: short; AKIA" + "A" * 14 + " deadbeefdeadbeef AKIAX ffff password='a/b+c=d_e-f.g' pasſword=abcdefghijklm"
    base = secrets.base_spans(t)
    assert sorted((k, t[a:b]) for k, a, b in base) == sorted([("assign", "API_KEY = 'abcdefghijkl"), ("access", "AKIA" + "A" * 14), ("hex", "deadbeefdeadbeef"), ("assign", "password='a/b+c=d_e-f.g")])
    assert secrets.base_spans("token: secret = abcdefghijklmnop") == []  # the short match takes the word that would begin another


def test_redaction():
    t = 'é "token": "9f8a7Kd02mNq83Lz" end'
    assert secrets.redact(t, secrets.scan_text(t)[1]) == 'é "[SECRET]" end'


def test_scan(spark):
    rows = [(1, None), (2, ""), (None, "token = abcdefghijklmn"), (3, "token = abcdefghijklmn"), (3, "token = abcdefghijklmn"), (4, LONG + "token = abcdefghijklmn")]
    out = {(r.doc_id, r.n_assign): r for r in secrets.scan(docs(spark, rows)).collect()}
    assert out[1, 0].base_sha256 == hashlib.sha256(b"").hexdigest() and out[3, 1].spans.startswith("assign:0:22") and out[4, 1].spans.startswith(f"assign:{len(LONG)}:")
    assert secrets.scan(docs(spark, rows).limit(0)).count() == 0
    red = secrets.redacted(docs(spark, rows))
    assert red.columns == ["doc_id", "text", "x", "score"] and {r.text for r in red.where("doc_id < 4 OR doc_id IS NULL").collect()} == {None, "", "[SECRET]"}


# --- toxicity and quality
def held_out(spark, name, label, sf=SF):
    r = queries.QUERIES[name](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").toPandas()
    return (r.predicted == r[label]).mean(), r


def test_accuracy(spark):
    """Of either label at least nine in ten held-out texts are told."""
    for name, label in (("op6_quality", "quality"), ("op4_toxicity", "toxic")):
        accuracy, rows = held_out(spark, name, label, "/root/testdata/sf0.1")
        assert accuracy > 0.96 and rows[rows[label] == 1].predicted.mean() > 0.9 and rows[rows[label] == 0].predicted.mean() < 0.1, name


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_classifiers_on_odd_rows(spark, module, label):
    rows = [(i, "the good text of a kind of day " * 3 + f"n{i}") for i in range(40)] + [(i, "### $$$ ### idiot&&& " * 5 + f"{i}") for i in range(40, 80)] + [(100, None), (101, ""), (None, "x"), (102, LONG), (0, "the good text of a kind of day")]
    labels = spark.createDataFrame([(i, int((i < 40) == (label == "quality"))) for i in range(80)] + [(0, 0), (None, 1)], f"doc_id long, {label} int")
    out = module.classify(docs(spark, rows), labels).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert module.classify(docs(spark, rows).limit(0), labels).count() == 0
    assert all(0 <= r.score <= 1 for r in module.classify(docs(spark, rows), labels.limit(0)).collect())


def test_fold(spark):
    ids = [0, 7, 123456, None]
    got = spark.createDataFrame([(i,) for i in ids], "doc_id long").select(fold("doc_id").alias("f")).collect()
    assert [r.f for r in got] == [zlib.crc32(str(i).encode()) % 5 if i is not None else 0 for i in ids]


def test_viterbi():
    text = "you are an idiot and such trash said the loser in the street of the town " * 30
    c = toxicity._CLASS[np.frombuffer(("\n" + text).encode("utf-32-le"), "<u4")]
    counts = np.bincount(c[:-2] << 12 | c[1:-1] << 6 | c[2:], minlength=1 << 18)
    r = toxicity.Restorer(toxicity.log_probabilities(counts))
    for token, word in (("1d1ot", "idiot"), ("tr@sh", "trash"), ("idiiiiot", "idiot"), ("i d i o t", "idiot"), ("l-o-s-e-r", "loser"), ("l0$er", "loser"), ("id10+", "idiot"), ("$.a.i.d", "said"), ("s*t*r*e*e*t", "street")):
        assert word in r.words(f"an {token} here"), token
    for token, word in (("tr/\\sh", "trash"), ("i|)iot", "idiot"), ("l()ser", "loser"), ("lоser", "loser"), ("ｔｒａｓｈ", "trash"), ("/\\nd", "and")):
        assert word in r.words(f"an {token} here"), token
    assert r.words("plain words stay") == {"plain", "words", "stay"} and r.words("and/or") == {"and", "or"}
    assert "the" in r.words("see t h e") and "said" in r.words("." .join("said" * 1)) and "idiot" in r.words("1d10t" + "!" * 3)
    marked = "st0pthetr@shinthestreet" * 7
    assert "stopthetrashinthestreet" * 7 in r.words(marked)


def test_runs_are_decoded_whole_and_parted():
    text = "you are an idiot and such a stupid trash said the loser in the street of the town " * 30
    c = toxicity._CLASS[np.frombuffer(("\n" + text).encode("utf-32-le"), "<u4")]
    cost = toxicity.log_probabilities(np.bincount(c[:-2] << 12 | c[1:-1] << 6 | c[2:], minlength=1 << 18))
    for r in (toxicity.Restorer(cost), toxicity.Restorer(cost, {w: 3.0 for w in text.split()})):
        assert "stupid" in r.words("such a s t u p i d dog") and {"you", "idiot"} <= r.words("y o u i d i o t") and {"you", "idiot"} <= r.words("y.o.u.1.d.i.0.t")
        assert r.decode("such-trash") == "such trash" and r.decode("$tupid-l0ser") == "stupid loser"
        long = "inthestreetofthetown" * 10 + "youidiot"
        assert {"street", "town", "idiot"} <= r.words(" ".join(long)) and "idiot" in r.words(".".join(long))
        assert "idiot" in r.words("in-the-street-of-the-town-" * 4 + "1d10t") and "st" + "u" * 3 not in r.words("stu" + "u" * 90 + "pid")


def test_plain_words_pass_the_patterns_of_marks_by(monkeypatch):
    """Most tokens are words that nothing hides; they aren't searched for marks, and the others give the same words as without this."""
    asked, own = [], toxicity._SEVERAL
    monkeypatch.setattr(toxicity, "_SEVERAL", SimpleNamespace(search=lambda token: asked.append(token) or own.search(token)))
    flat = np.ones((64, 64, 64), np.float32)
    r = toxicity.Restorer(flat)
    got = r.words("Such (plain) \"words,\" hide größer, things; a well-made 1d10t stooop l()ser !no")
    assert {"such", "plain", "words", "hide", "größer", "things", "a"} <= got and sorted(asked) == sorted(["well-made", "1d10t", "stooop", "l()ser", "!no"])
    draw = random.Random(3)
    tokens = ["".join(draw.choices("abvvß4.,()|\\/<\"'!?:;-\u0430", k=draw.randint(1, 7))) for _ in range(20_000)]
    tokens += [draw.choice(["", "(", "'(", "!", "["]) + "".join(draw.choices("abvé", k=5)) + "".join(draw.choices(".,;:!?\"')]|+", k=draw.randint(0, 3))) for _ in range(20_000)]
    short = [r.words_of(token) for token in tokens]
    monkeypatch.setattr(toxicity, "_PLAIN", re.compile("(?!)"))
    assert short == [toxicity.Restorer(flat).words_of(token) for token in tokens]


def test_features_of_texts_whatever_was_seen_before():
    """What a scorer keeps of tokens, with and without features, changes nothing."""
    model = toxicity.Model(np.ones((64, 64, 64), np.float32), ["idiot", "stup~", "stupid~", "of", "y"], np.zeros(5), 0.0)
    s = model.scorer()
    for text in ("Stupidity of an idiot.", "nothing at all", "", "stupid, STUPIDLY; y", "i d i o t", "nothing of 1d10ts") * 2:
        assert s.indexes(text) == {model.index[f] for f in toxicity.features(s.restorer.words(text)) if f in model.index}
    assert s.indexes("Stupidity of an idiot.") == {0, 1, 2, 3} and {"nothing", "an"} <= s.nothing and not s.nothing & set(s.hits)


def test_spaced_out_toxic_words_are_scored(spark):
    rows = [(i, f"the good text of a kind of day n{i}") for i in range(40)] + [(i, f"you are such a stupid idiot n{i}") for i in range(40, 80)]
    plain = ["of such a stupid day", "the you idiot day", "the " + "good text of a day " * 10 + "stupid idiot", "the good text of a kind"]
    spread = ["of such a s t u p i d day", "the y o u i d i o t day", "the " + " ".join("goodtextofaday" * 10 + "stupididiot"), " ".join("thegoodtextofakind")]
    rows += [*enumerate(plain, 100), *enumerate(spread, 200)]
    labels = spark.createDataFrame([(i, int(i >= 40)) for i in range(80)], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.classify(docs(spark, rows), labels).collect()}
    assert all(abs(got[100 + i] - got[200 + i]) < 1e-9 for i in range(4)) and min(got[200 + i] for i in range(3)) > 2 * got[203]


def test_trigram_counts_are_of_all_texts(spark):
    rows = [(i, t) for i, t in enumerate(["abc abd", None, "", "éa𝒬"])]
    got = toxicity.trigram_counts(docs(spark, rows).repartition(1))
    assert got.sum() == len("\nabc abd\n\n\néa𝒬\n") - 2 and got[1 << 12 | 2 << 6 | 3] == 1


def test_nonnegative_risk():
    r = np.random.default_rng(0)
    good, bad = r.normal(0, 1, (800, 4)), r.normal(3, 1, (400, 4))
    u = np.concatenate([good[400:], bad])
    cuts = np.quantile(u, quality.QUANTILES, axis=0, method="nearest").T
    m = quality.fit(quality.coded(good[:400], cuts), quality.Design(quality.coded(u, cuts)), cuts)
    assert abs(m.prior - 0.5) < 0.2 and (m.score(good) > 0.5).mean() > 0.9 and (m.score(bad) < 0.5).mean() > 0.9


def test_lbfgs():
    a = np.diag([1.0, 10.0, 100.0])
    w = quality.minimise(lambda w: (0.5 * w @ a @ w - w.sum(), a @ w - 1), 3, 40)
    assert np.abs(a @ w - 1).max() < 1e-2
    # never where the function says infinity
    seen = quality.minimise(lambda w: (np.inf if w[0] > 0.5 else (w[0] - 1) ** 2, 2 * (w - 1)), 1, 40)
    assert 0.3 < seen[0] <= 0.5


def test_passes_over_codes_are_sums(spark):
    r = np.random.default_rng(3)
    codes = r.integers(0, quality.BINS, (500, 3)).astype(np.uint8)
    df = spark.createDataFrame([(bytearray(c.tobytes()),) for c in codes], "code binary").repartition(5)
    here, there = quality.Design(codes), quality.Codes(df, 500, 3)
    w = r.normal(size=here.size)
    (a, g), (b, h) = here.negative(w), there.negative(w)
    assert abs(a - b) < 1e-12 and np.abs(g - h).max() < 1e-12
    cuts = np.array([-2.0, 0.0, 1.0])
    assert np.allclose(here.above(w, cuts), there.above(w, cuts)) and np.allclose(here.above(w, cuts), [(here.margins(w) >= c).mean() for c in cuts])


class Fetched:
    """Counts the rows that come to the driver."""

    def __init__(self, monkeypatch):
        from pyspark.sql.classic.dataframe import DataFrame

        self.most = 0
        own = DataFrame.collect

        def collect(df):
            rows = own(df)
            self.most = max(self.most, len(rows))
            return rows

        monkeypatch.setattr(DataFrame, "collect", collect)
        whole = DataFrame.toPandas

        def to_pandas(df):
            rows = whole(df)
            self.most = max(self.most, len(rows))
            return rows

        monkeypatch.setattr(DataFrame, "toPandas", to_pandas)


@pytest.mark.parametrize("labelled", [7, None])
def test_fits_fetch_no_more_than_their_sample(spark, monkeypatch, labelled):
    """30,000 rows of one labelled id, or without id: the sample bounds rows, and what is unlabelled is never empty."""
    good, bad = "The quick brown fox walked over to the old mill by the river. ", "### $$$ %%%% 777 "
    rows = spark.range(30_000).select(F.lit(labelled).cast("long").alias("doc_id"), F.concat(F.when(F.col("id") % 2 == 0, good).otherwise(bad), F.col("id").cast("string")).alias("text"))
    more = spark.createDataFrame([(k, good + "and sat there. " * (k % 5)) for k in range(100, 160)] + [(k, bad * (k % 7)) for k in range(200, 260)], "doc_id long, text string")
    labels = spark.createDataFrame([(7, 1, 1), (None, 1, 0)] + [(k, int(k < 200), int(k >= 200)) for k in range(100, 260)], "doc_id long, quality int, toxic int")
    fetched = Fetched(monkeypatch)
    model = quality.train(rows.unionByName(more), labels, sample=100)
    assert fetched.most <= 100 and model.weights.any() and model.score(np.array([quality.statistics(good)]))[0] > 0.5
    fetched.most = 0
    toxicity.train(rows.unionByName(more), labels, sample={1: 20, 0: 20}, size=50)
    assert fetched.most <= max(50, toxicity.LEXICON) and fetched.most < 30_000


def test_toxicity_learns_from_every_labelled_text(spark, monkeypatch):
    """What only two hundred toxic texts of twelve thousand hold is learned, wherever they stand in an order of the ids; a bound given by a caller holds."""
    ids = spark.range(1, 30_001).select(F.col("id").alias("doc_id"), F.xxhash64("id").alias("h")).where(fold("doc_id") != 0).orderBy("h", "doc_id").limit(12_000).toPandas().doc_id.tolist()
    late = set(ids[-200:])
    text = lambda k, i: ("you zounderkite and " if i in late else "you idiot and ") * 2 + f"a day n{k}" if k % 2 or i in late else f"the good text of a kind of day n{k}"
    rows = docs(spark, [(i, text(k, i)) for k, i in enumerate(ids)] + [(99_999, "such a zounderkite"), (99_998, "the good text"), (99_997, "such an idiot")])
    labels = spark.createDataFrame([(i, int(k % 2 or i in late)) for k, i in enumerate(ids)], "doc_id long, toxic int")
    fitted = []
    own = toxicity.fit_logistic
    monkeypatch.setattr(toxicity, "fit_logistic", lambda seen, *more: fitted.append(seen.count()) or own(seen, *more))
    got = {r.doc_id: r.score for r in toxicity.classify(rows, labels).where("doc_id > 99000").collect()}
    assert fitted == [12_000] and got[99_999] > 0.5 and got[99_997] > 0.5 and got[99_998] < 0.5
    toxicity.train(rows, labels, sample={1: 30, 0: 40}, size=20)
    assert fitted[1:] == [70]


def test_counts_of_features_are_of_all_texts(spark, monkeypatch):
    """Also where a task sends its counts on in parts; an id's repeated text counts once, labels without texts not at all."""
    monkeypatch.setattr(toxicity, "COUNTED", 5)
    rows = [(i, f"word{'abcde'[i % 5]} here and {'there' * (i % 2)}") for i in range(50)]
    known = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(0, 80, 2)], "__id long, __y int")
    seen = toxicity.labelled(docs(spark, rows * 2), known, "doc_id", "text", None)
    told = [(i, int(i % 3 == 0)) for i in range(0, 50, 2) if zlib.crc32(str(i).encode()) % 5]
    assert seen.count() == len(told)
    got = {r.f: (r.p, r.q) for r in toxicity.holders(seen.repartition(3), lambda: toxicity.Restorer(np.zeros((64, 64, 64), np.float32))).collect()}
    want = {}
    for i, y in told:
        for f in toxicity.features(set(toxicity._WORD.findall(rows[i][1]))):
            p, q = want.get(f, (0, 0))
            want[f] = (p + y, q + 1 - y)
    assert got == want


def test_toxicity_without_texts_of_a_label(spark):
    rows = docs(spark, [(i, f"the good text n{i}") for i in range(30)])
    labels = spark.createDataFrame([(i, int(i >= 30)) for i in range(60)], "doc_id long, toxic int")
    told = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5]
    share = sum(i >= 30 for i in told) / len(told)
    assert {round(r.score, 2) for r in toxicity.classify(rows, labels).collect()} == {round(share, 2)}


# --- BPE
@pytest.fixture(scope="module")
def codecs():
    import tiktoken

    path = P.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return bpe.codec(bpe.read_ranks(path), P.PATTERN), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=150, deadline=None)
@given(text=st.text(max_size=60))
def test_bpe(codecs, text):
    mine, theirs = codecs
    raw = mine.encode([text])[0]
    assert list(struct.unpack(f"<{len(raw) // 4}I", raw)) == theirs.encode_ordinary(text) and mine.decode(raw) == text.encode()


def test_bpe_of_long_pieces_and_small_tables(codecs, monkeypatch):
    mine, theirs = codecs
    monkeypatch.setattr(bpe, "CACHE", 3)
    r = random.Random(2)
    for n in (1, 2, 3, 64, 65, 5000):
        text = "".join(r.choice("abcdeé") for _ in range(n)) + "<|endoftext|>"
        assert np.frombuffer(mine.encode([text, text])[1], "<u4").tolist() == theirs.encode_ordinary(text)


def test_bpe_rows(spark):
    rows = [(1, None), (2, ""), (None, "é x"), (3, LONG), (3, LONG)]
    path = P.path("byte_bpe_50k.tiktoken")
    out = {r.doc_id: r for r in bpe.digests(docs(spark, rows), path, P.PATTERN).collect()}
    assert out[1].n_tokens == 0 and out[2].ids_sha256 == hashlib.sha256(b"").hexdigest() and out[3].decoded_sha256 == hashlib.sha256(LONG.encode()).hexdigest()
    back = bpe.decoded(bpe.encoded(docs(spark, rows), path, P.PATTERN), path, P.PATTERN)
    assert back.columns == ["doc_id", "x", "score", "input_ids", "n_tokens", "decoded"] or "decoded" in back.columns
    assert {r.decoded for r in back.collect()} == {"", "é x", LONG}


# --- decontamination
def test_wand():
    r = random.Random(1)
    vocabulary = [f"w{i}" for i in range(60)] + [f"c{i}" for i in range(8)] * 6
    items = [(i, [r.choice(vocabulary) for _ in range(r.randint(1, 20))], [r.choice(vocabulary) for _ in range(r.randint(0, 9))]) for i in range(120)]
    names = {w: k for k, w in enumerate(sorted({w for _, q, a in items for w in (*q, *a)}))}
    index = decontaminate.Index(items, decontaminate.Statistics.of(items), names)
    for _ in range(300):
        query = sorted({int(index.local[names[w]]) for w in r.sample(sorted(names), r.randint(1, 40))})
        score = np.zeros(len(items))
        for t in query:
            own = slice(index.begin[t], index.begin[t + 1])
            score[index.docs[own]] += index.impacts[own]
        for threshold in (0.3, 0.6):
            got = dict(index.search(query, threshold))
            assert set(got) == set(np.flatnonzero(score >= threshold - 1e-6).tolist()) and all(abs(got[k] - score[k]) < 1e-9 for k in got)


def test_decontamination(spark):
    r = random.Random(2)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    items = [(i, " ".join(word() for _ in range(r.choice([8, 20, 40])))) for i in range(30)] + [(50, None), (51, ""), (None, "x y"), (1000, " ".join(word() for _ in range(30)))]
    items.append((1001, items[-1][1]))
    rows = [(i, " ".join(word() for _ in range(300))) for i in range(20)]
    want = set()
    for i in range(20, 50):
        k, t = items[i - 20]
        rows.append((i, " ".join(word() for _ in range(r.randrange(200))) + " " + t.upper() + ". " + " ".join(word() for _ in range(150))))
        want.add((i, k))
    rows += [(60, None), (61, ""), (62, items[-1][1]), (62, items[-1][1]), (63, items[10][1].rsplit(" ", len(items[10][1].split()) // 2)[0])]
    want |= {(62, 1000), (62, 1001)}
    table = spark.createDataFrame(items, "item_id long, text string")
    for size in (10**6, 150):
        got = [(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs(spark, rows), table, postings=size).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    kept = decontaminate.clean(docs(spark, rows), table)
    assert kept.columns == ["doc_id", "text", "x", "score"] and {r.doc_id for r in kept.collect()} == {*range(20), 60, 61, 63}
    assert decontaminate.contaminated(docs(spark, rows).limit(0), table).count() == 0 and decontaminate.contaminated(docs(spark, rows), table.limit(0)).count() == 0


def test_question_and_answer_columns(spark):
    items = spark.createDataFrame([(1, "what is the capital of the far land", "the old town of bells")], "item_id long, q string, a string")
    rows = [(1, "what is the capital of the far land ? the old town of bells"), (2, "what is the capital of the far land ? nobody knows it at all")]
    found = decontaminate.contaminated(docs(spark, rows), items, question_col="q", answer_col="a", threshold=0.4)
    assert [r.doc_id for r in found.collect()] == [1]


def test_scores_do_not_depend_on_shards(spark):
    r = random.Random(5)
    vocabulary = [f"c{i}" for i in range(12)] * 4 + [f"w{i}" for i in range(300)]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(r.choice([3, 8, 20, 60])))) for i in range(60)]
    rows = []
    for i, (_, t) in enumerate(items):
        w = t.split()
        rows.append((i, " ".join(["before"] * r.randrange(60) + w[: len(w) * r.randint(5, 10) // 10] + ["after"] * 20 + [t for t in w if r.random() < 0.6])))
    table = spark.createDataFrame(items, "item_id long, text string")
    one, many = ({(x.doc_id, x.item_id): (round(x.score, 9), x.question_overlap, x.answer_overlap, x.start_word) for x in decontaminate.contaminated(docs(spark, rows), table, postings=n).collect()} for n in (10**6, 150))
    assert one == many and any(v[0] < 0.95 for v in one.values())


def test_long_items_and_benchmarks_of_many_words(spark):
    """Neither is refused, and an item matches the same, whatever others there are."""
    own = [(i, " ".join(f"w{i}x{k}" for k in range(80))) for i in range(1000)]
    short = [(2000, "seven short words make up this item"), (2001, "another item of quite a few short words")]
    long = [(3000, " ".join(f"long{k}" for k in range(30_000)))]
    rows = [(i, f"before {t} after") for i, t in own[::100]] + [(5000, short[0][1]), (5001, " ".join(["seven short", *["x"] * 90, "words make", *["y"] * 90, "up this item"])), (5002, long[0][1]), (5003, "x"), (None, short[1][1])]
    one = {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminated(docs(spark, rows), spark.createDataFrame(short, "item_id long, text string")).collect()}
    assert set(one) == {(5000, 2000), (None, 2001)}
    for size in (10**6, 20_000):
        got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs(spark, rows), spark.createDataFrame(own + short + long, "item_id long, text string"), postings=size).collect()}
        assert got == {(i, i) for i, _ in own[::100]} | {(5002, 3000)} | set(one)
        kept = decontaminate.clean(docs(spark, rows), spark.createDataFrame(own + short + long, "item_id long, text string"), postings=size).collect()
        assert {r.doc_id for r in kept} == {5001, 5003}


def test_items_and_answers_of_few_words(spark):
    texts = ["alpha", "bravo carol", "delta echo fox", "golf hotel india jazz", "kilo lima mike nora oscar"]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    rows = [*enumerate(texts), *((10 + i, f"some words before {t.title()}, and after") for i, t in enumerate(texts)), (20, "carol bravo"), (21, "echo of delta and fox"), (22, "india"), (23, "kilo lima mike")]
    found = decontaminate.contaminated(docs(spark, rows), items).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(i + k, i) for i in range(5) for k in (0, 10)}
    assert all(r.score > 0.999 and r.question_overlap == r.answer_overlap == 1 for r in found)
    items = spark.createDataFrame([(1, "what is the capital of the far land", "Belltown"), (2, "who wrote the book of tides", "Ann Marsh"), (3, "who", "me")], "item_id long, q string, a string")
    rows = [(1, "what is the capital of the far land ? belltown !"), (2, "Who wrote the book of tides? Ann Marsh."), (3, "who wrote the book of tides ? marsh , not ann"), (4, "what is the capital of the far land ?"), (5, "who? me")]
    found = decontaminate.contaminated(docs(spark, rows), items, question_col="q", answer_col="a").collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 1), (2, 2), (5, 3)}


# --- sharding
def plain_shards(rows, limit):
    """(id, n) -> {id: depth, prefix} by splitting a directory."""
    h = {i: int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16) for i, _ in rows}
    out = {}

    def split(members, depth):
        if sum(n for _, n in members) <= limit or len({h[i] for i, _ in members}) == 1:
            out.update({i: (depth, h[i] >> (60 - depth)) for i, _ in members})
            return
        for bit in (0, 1):
            part = [m for m in members if h[m[0]] >> (59 - depth) & 1 == bit]
            if part:
                split(part, depth + 1)

    split(rows, 0)
    return out


@pytest.mark.parametrize("limit", [10**6, 4000, 900, 60])
def test_sharding(spark, limit):
    rows = [(i, "x" * (i % 97)) for i in range(200)]
    want = plain_shards([(i, len(t)) for i, t in rows], limit)
    out = sharding.shard(docs(spark, rows), limit).collect()
    assert {r.doc_id: (r.depth, r.prefix) for r in out} == want and all(r.shard_bytes <= limit or r.over_limit and r.page == -1 for r in out)


def test_sharding_of_what_no_bit_splits(spark):
    rows = [(5, "y" * 40)] * 50 + [(None, "zz")] * 30 + [(7, "w" * 500), (8, None), (9, "")]
    out = sharding.shard(docs(spark, rows).repartition(4), 200).collect()
    assert len(out) == len(rows)
    shards: dict = {}
    for r in out:
        shards.setdefault((r.depth, r.prefix, r.page), []).append(r)
    for group in shards.values():
        total = sum(r.n_bytes for r in group)
        assert all(r.shard_bytes == total for r in group) and (total <= 200 or len(group) == 1 and group[0].over_limit)
    assert sharding.shard(docs(spark, rows).limit(0), 200).count() == 0


def test_written_shards(spark, tmp_path):
    rows = [(5, "y" * 40)] * 50 + [(None, "zz")] * 30 + [(7, "w" * 500), (8, None), (9, "")] + [(i, "x" * (i % 30)) for i in range(100, 300)]
    df = docs(spark, rows).repartition(4)
    sharding.write(df, str(tmp_path / "s"), 200)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.columns == ["doc_id", "text", "x", "score", "shard"]
    got = back.collect()
    assert sorted(repr((r.doc_id, r.text)) for r in got) == sorted(repr(r) for r in rows)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(len(r.text or ""))
    assert len(by) > 10 and all(sum(n) <= 200 or len(n) == 1 for n in by.values())
    sharding.write(df, str(tmp_path / "whole"), 500, size=sharding.row_bytes(df))
    sizes = spark.read.parquet(str(tmp_path / "whole")).groupBy("shard").agg(F.sum(F.octet_length(F.to_json(F.struct("doc_id", "text", "x", "score")))).alias("n"), F.count("*").alias("k")).collect()
    assert all(r.n <= 500 or r.k == 1 for r in sizes)
    sharding.write(df.limit(0), str(tmp_path / "none"), 200)


def test_sharding_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    cur = con.execute(queries.ORACLE_SQL["op9_sharding"])
    columns = [c[0] for c in cur.description]
    got = queries.QUERIES["op9_sharding"](spark, SF).select(columns).collect()
    assert len({(r.depth, r.prefix) for r in got}) > 50 and any(r.over_limit and r.page for r in got)
    assert sorted(map(tuple, got)) == sorted(cur.fetchall())


# --- media
def test_round_trip(spark, tmp_path):
    rows = [(1, "é" * 150), (2, None), (3, ""), (None, "a"), (4, LONG), (4, LONG), (5, "x" * 192)]
    out = media.round_trip(docs(spark, rows)).collect()
    assert len(out) == len(rows)
    want = {i: (t or "").encode() for i, t in rows}
    for r in out:
        raw = want[r.doc_id]
        p = raw.ljust(max(192, -(-len(raw) // 192) * 192))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:]))
    assert len({(r.media_sha256, r.feature) for r in out if r.doc_id == 4}) == 1
    assert media.round_trip(docs(spark, rows).limit(0)).count() == 0


def test_appending_and_overwriting(spark, tmp_path):
    path = str(tmp_path / "m")
    for k in range(3):
        media.store(docs(spark, [(k, f"text {k}")]), path)
    assert sorted(r.id for r in media.load(spark, path).collect()) == [0, 1, 2]
    media.store(docs(spark, [(7, "other")]), path, overwrite=True)
    assert [r.id for r in media.load(spark, path).collect()] == [7]
    assert len(list((tmp_path / "m").glob("*.zip"))) == 1
    with pytest.raises(Exception, match="no archive was written"):
        media.load(spark, str(tmp_path / "none")).collect()


def test_opening_is_retried(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "m")
    media.store(docs(spark, [(k, f"text {k}") for k in range(9)]).coalesce(1), path)
    reader, whole, calls = media.ArchiveReader({"path": path}), media._Retry._open, []
    (part,) = reader.partitions()

    def flaky(self):
        calls.append(1)
        if len(calls) < 3:
            raise OSError("not yet")
        return whole(self)

    monkeypatch.setattr(media._Retry, "_open", flaky)
    monkeypatch.setattr(media.time, "sleep", lambda s: None)
    assert sum(b.num_rows for b in reader.read(part)) == 9 and len(calls) >= 3


def test_byte_ranges_and_retries(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "m")
    media.store(docs(spark, [(i, f"text {i} " * 30) for i in range(50)]).coalesce(1), path, archive_bytes=2000)
    for step in (100, 1500, 1 << 20):
        assert sorted(r.id for r in media.load(spark, path, step).collect()) == list(range(50))
    # files that no manifest names aren't read
    (tmp_path / "m" / "part-lost.zip").write_bytes(b"junk")
    assert media.load(spark, path).count() == 50
    reader = media.ArchiveReader({"path": path, "rangebytes": "1000000"})
    part = reader.partitions()[0]
    calls, whole = [], media._Retry._open

    class Flaky:
        def __init__(self, f):
            self.f = f

        def __getattr__(self, name):
            return getattr(self.f, name)

        def read(self, *a):
            calls.append(1)
            if len(calls) % 5 == 3:
                raise OSError("gone")
            return self.f.read(*a)

    flaky = lambda self: Flaky(whole(self))
    want = [b.num_rows for b in reader.read(part)]
    source = media._Retry(part.uri, pause=0)
    import zipfile

    members = zipfile.ZipFile(whole(source)).infolist()
    monkeypatch.setattr(media._Retry, "_open", flaky)
    source = media._Retry(part.uri, pause=0)
    assert sum(want) == len([source.member(m) for m in members])


def test_damage_is_found():
    png = bytearray(media.to_png(b"a" * 384))
    assert media.from_png(bytes(png)) == b"a" * 384
    png[50] ^= 1
    with pytest.raises(ValueError):
        media.from_png(bytes(png))


def test_media_paths_belong_to_the_default_file_system(spark, tmp_path):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    try:
        assert media.qualified(spark, "/x/y") == "file:/x/y" and media.qualified(spark, f"file://{tmp_path}/a").endswith("/a")
        conf.set("fs.viewfs.mounttable.own.link./in", f"file://{tmp_path}")
        conf.set("fs.defaultFS", "viewfs://own/")
        assert media.qualified(spark, "/in/y") == "viewfs://own/in/y" and media.qualified(spark, "file:/x") == "file:/x"
    finally:
        conf.set("fs.defaultFS", before)
