"""Language identification, whitening and periodic runs, against plain computations."""

import hashlib
import math
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridmix.llm import language_id, periodic_runs, queries, whitening
from gridmix.llm.common import configure


@pytest.fixture(scope="module", autouse=True)
def _configured(spark):
    configure(spark)


# Periodic runs


def brute_runs(a, least=12):
    n, known = len(a), {}
    for q in range(1, n // 2 + 1):
        j = 0
        while j < n - q:
            end = j
            while end < n - q and a[end] == a[end + q]:
                end += 1
            if end > j and end - j + q >= max(least, 2 * q):
                known.setdefault((j, end + q), q)
            j = max(end, j + 1)
    return sorted((s, e - s, q) for (s, e), q in known.items())


def brute_collapse(words, runs):
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in drop]


def sequences(count, seed):
    rng = random.Random(seed)
    for _ in range(count):
        kind, letters, n = rng.randrange(5), rng.choice([1, 2, 3, 30]), rng.randrange(1, 240)
        if kind == 0:
            yield [rng.randrange(letters) for _ in range(n)]
        elif kind == 1:  # several repeated parts
            out = []
            while len(out) < n:
                out += [rng.randrange(letters) for _ in range(rng.randrange(1, 60))] * rng.randrange(1, 5)
            yield out
        elif kind == 2:  # long small-period runs inside a longer period
            yield ([0] * rng.randrange(1, 70) + [1]) * rng.randrange(1, 6) + [0] * rng.randrange(30)
        elif kind == 3:  # both halves have a smaller period, with the break between them
            yield [1] * rng.randrange(2) + ([0, 1] * 60)[:rng.randrange(1, 100)] * rng.randrange(1, 4) + ([0, 1] * 20)[:rng.randrange(40)]
        else:  # Fibonacci words hold many runs
            x, y = [0], [0, 1]
            while len(y) < n:
                x, y = y, y + x
            yield y[:n]


def test_runs_equal_brute_force():
    for a in sequences(1500, 11):
        assert periodic_runs.find_runs(np.array(a, dtype=np.int64)) == brute_runs(a), a


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40), st.integers(1, 6), st.lists(st.integers(0, 2), max_size=60), st.integers(2, 14))
def test_runs_property(part, times, rest, least):
    a = part * times + rest + part
    assert periodic_runs.find_runs(np.array(a, dtype=np.int64), least) == brute_runs(a, least)


def test_pairs_are_looked_at_in_parts(monkeypatch):
    monkeypatch.setattr(periodic_runs, "PAIRS", 7)
    for a in sequences(150, 12):
        assert periodic_runs.find_runs(np.array(a, dtype=np.int64)) == brute_runs(a), a


def test_long_texts_stay_near_linear():
    ones = np.zeros(300_000, np.int64)
    assert periodic_runs.find_runs(ones) == [(0, 300_000, 1)]
    rng = np.random.default_rng(1)
    part = rng.integers(0, 5000, 70_001)
    assert (0, 210_003, 70_001) in periodic_runs.find_runs(np.tile(part, 3))


def test_minimizers_are_the_least_of_some_window():
    rng = np.random.default_rng(2)
    for _ in range(200):
        grams, width = rng.integers(1, 6, rng.integers(1, 40)).astype(np.uint64), int(rng.integers(1, 9))
        if len(grams) < width:
            continue
        want = sorted({i for j in range(len(grams) - width + 1) for i in range(j, j + width) if grams[i] == grams[j:j + width].min()})
        assert periodic_runs.minimizers(grams, width).tolist() == want


def test_runs_of_a_table(spark):
    texts = [None, "", " \n\t", "a " * 40, "x y z " * 7, "the quick  brown\nfox " * 5 + "jumps", "no run here", "a " * 40, "é ß " * 9]
    rows = [(i if i != 6 else None, t, "k", 1) for i, t in enumerate(texts)] + [(3, texts[5], "k", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string, n_words int")
    found = periodic_runs.periodic_runs(df).collect()
    assert len(found) == len(rows)
    def plain(doc_id, text):
        words = [w for w in (text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
        runs = brute_runs(words)
        return (doc_id, len(words), tuple(runs), " ".join(brute_collapse(words, runs)))
    want = sorted((plain(i, t) for i, t, *_ in rows), key=str)
    got = sorted(((r["doc_id"], r["n_words"], tuple((x["start"], x["length"], x["period"]) for x in r["runs"]), r["collapsed"]) for r in found), key=str)
    assert got == want
    assert periodic_runs.periodic_runs(df.limit(0)).count() == 0
    odd = df.withColumn("TEXT", F.lit("a"))
    assert periodic_runs.periodic_runs(odd).count() == len(rows)
    one = {r["doc_id"]: r for r in periodic_runs.digests(periodic_runs.periodic_runs(df.where("doc_id in (1, 4)"))).collect()}
    assert one[1]["n_runs"] == 0 and one[1]["start"] is None and one[1]["runs_sha256"] == hashlib.sha256(b"").hexdigest()
    assert (one[4]["start"], one[4]["length"], one[4]["period"], one[4]["exponent_milli"]) == (0, 14, 2, 7000)
    assert one[4]["runs_sha256"] == hashlib.sha256(b"0,14,2\n").hexdigest()


def test_op13_equals_brute_force(spark, tmp_dir):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("a b c d e f g h".split()) for _ in range(rng.randrange(0, 150)))) for i in range(150)]
    rows += [(150, None), (151, "   "), (None, "a " * 20), (-7, "b c " * 20)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    found = {r["doc_id"]: r for r in queries.QUERIES["op13_periodic_runs"](spark, tmp_dir).collect()}
    assert len(found) == len(rows)
    planted = 0
    for doc_id, text in rows:
        words = (text or "").split()
        n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        if h % 10 == 0 and n:
            planted += 1
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = brute_runs(words)
        r = found[doc_id]
        assert r["n_runs"] == len(runs)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        assert (r["start"], r["length"], r["period"]) == best
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(" ".join(brute_collapse(words, runs)).encode()).hexdigest()
    assert planted > 5


# Whitening


def plain_whitening(rows, k):
    x = {i: np.floor(64 * np.array(v, dtype=float)).astype(np.int64) + 1_000_000 for i, v in rows}
    fit = np.unique(np.array(list(x.values())), axis=0)
    n, total = len(fit), fit.sum(axis=0)
    centre = fit - total / n
    values, units = np.linalg.eigh(centre.T @ centre / n)
    values, units = values[::-1], units[:, ::-1]
    k = min(k, int((values > 1e-9 * values[0]).sum()))
    return {i: ((v - total / n) @ units[:, :k] / np.sqrt(values[:k]), int(((n * v - total) ** 2).sum())) for i, v in x.items()}, n, values[:k] / values.sum()


def test_whitening_equals_plain_eigenvectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=6) * [3, 2, 1.5, 1, 0.7, 0.5]).tolist()) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(90)]  # one vector that repeats counts once
    sound = list(rows)
    odd = [(300, None), (301, [math.nan] * 6), (302, [math.inf] + [0.0] * 5), (303, [None] + [1.0] * 5), (304, []), (305, [1.0, 2.0]),
           (306, [1e300] + [0.0] * 5)]
    df = spark.createDataFrame([(i, v, 7, "x") for i, v in rows + odd], "vec_id long, embedding array<double>, n int, component string")
    got = whitening.whitened(df, 4).collect()
    want, n, explained = plain_whitening(sound, 4)
    assert sorted({r["vec_id"] for r in got}) == sorted(want) and len(got) == 4 * len(want)
    by = {(r["vec_id"], r["component"]): r for r in got}
    for c in range(4):
        sign = np.sign(sum(by[i, c + 1]["whitened"] * want[i][0][c] for i in want))
        for i in want:
            r = by[i, c + 1]
            assert r["whitened"] * sign == pytest.approx(want[i][0][c], abs=1e-9)
            assert r["deviation"] == want[i][1] and r["n"] == n and r["explained"] == pytest.approx(explained[c], rel=1e-10)
            assert r["identity_error"] < 1e-9
    assert whitening.whitened(df.limit(0)).count() == 0
    assert whitening.whitened(df.where("vec_id >= 200 and vec_id < 300")).count() == 0  # one distinct vector


def test_whitening_leaves_out_flat_directions_and_keeps_equal_ones(spark):
    # Three axes with equal spread, a fourth that never varies, and rows without an id.
    rows = [(None if i == 0 else i, [float(s) if a == j else 0.0 for a in range(3)] + [2.5])
            for i, (j, s) in enumerate((j, s) for j in range(3) for s in (-1, 1))]
    got = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    rows = got.collect()
    assert {r["component"] for r in rows} == {1, 2, 3} and len(rows) == 18
    assert all(r["identity_error"] < 1e-9 and r["explained"] == pytest.approx(1 / 3) for r in rows)


def test_large_entries_stay_exact():
    rng = np.random.default_rng(6)
    y = rng.integers(-(1 << 40), 1 << 40, (50, 3))
    assert (whitening.cross(y) == sum(np.outer(r, r) for r in y.astype(object))).all()
    model = whitening.Model(1 << 30, [1 << 50, 0, -5], np.eye(3), [1.0] * 3, [0.3] * 3)
    assert whitening.centred(y, model).tolist() == [[(1 << 30) * int(a) - s for a, s in zip(r, model.sums)] for r in y]


def test_characteristic_polynomial_and_roots(spark):
    rng = np.random.default_rng(7)
    b = rng.integers(-9, 10, (5, 7)).astype(object)
    a = b @ b.T
    coefficients = whitening.characteristic_polynomial(spark, a)
    for x in range(-3, 4):  # det(x - a), by fractions
        m = [[Fraction(int((i == j) * x - a[i, j])) for j in range(5)] for i in range(5)]
        det = Fraction(1)
        for k in range(5):
            r = next((i for i in range(k, 5) if m[i][k]), None)
            if r is None:
                det = Fraction(0)
                break
            if r != k:
                m[k], m[r], det = m[r], m[k], -det
            det *= m[k][k]
            for i in range(k + 1, 5):
                f = m[i][k] / m[k][k]
                m[i] = [u - f * v for u, v in zip(m[i], m[k])]
        assert det == sum(c * x ** i for i, c in enumerate(coefficients))
    roots = whitening.largest_roots(coefficients, 5)
    want = np.linalg.eigvalsh(a.astype(float))[::-1]
    assert [float(r) for r, _ in roots] == pytest.approx(want.tolist(), rel=1e-9)
    # (x - 7) (x - 5)^2 (x - 3) x
    poly = np.poly1d([1])
    for root in (7, 5, 5, 3, 0):
        poly *= np.poly1d([1, -root])
    assert [(round(float(r), 12), m) for r, m in whitening.largest_roots([int(c) for c in poly.c[::-1]], 16)] == [(7, 1), (5, 2), (3, 1)]


def test_primes():
    found = whitening.primes_below(1000, 20)
    assert found == [p for p in range(999, 1, -1) if all(p % q for q in range(2, p))][:20]


# Language identification


TONGUES = {"xa": "thing with other shall whether then".split(), "yb": "schein für über zeit nicht mögen".split(),
           "zc": "año niño está qué señor corazón".split()}


def corpus(n, seed=0):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(sorted(TONGUES))
        out.append((i, " ".join(rng.choice(TONGUES[lang]) for _ in range(rng.choice([1, 3, 20, 200]))), lang))
    return out


def test_network_learns_and_holds_out(spark):
    rows = corpus(600)
    # A held-out row's label must not matter.
    swapped = [(i, t, "xa" if zlib.crc32(str(i).encode()) % 4 == 2 else g) for i, t, g in rows]
    more = [(9001, None, "xa"), (9002, "", "yb"), (9003, "12 %% 34", None), (None, rows[5][1], rows[5][2]), (5, rows[5][1], rows[5][2]),
            (9004, rows[7][1].upper(), None)]
    schema = "doc_id long, text string, lang string, score int, TEXT string"
    tables = [spark.createDataFrame([(*r, 1, "clash") for r in own + more], schema) for own in (rows, swapped)]
    nets = [language_id.fit(t) for t in tables]
    assert nets[0].languages == ["xa", "yb", "zc"] and np.array_equal(nets[0].out, nets[1].out)
    found = language_id.predictions(tables[0], nets[0]).collect()
    assert len(found) == len(rows) + len(more) and all(0 <= r["score"] <= 1 for r in found)
    truth = {i: g for i, _, g in rows}
    held = [(r["lang_pred"], truth[r["doc_id"]]) for r in found if r["doc_id"] in truth and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert len(held) > 100 and sum(a == b for a, b in held) / len(held) >= 0.97
    by = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in found}
    assert by[9001] == by[9002] == by[9003] == ("und", 0.0)
    assert by[9004][0] == rows[7][2]
    assert language_id.predictions(tables[0].limit(0), nets[0]).count() == 0


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    net = language_id.fit(df)
    assert net.languages == [] and language_id.predictions(df, net).collect()[0][1:] == ("und", 0.0)
    alone = language_id.fit(spark.createDataFrame([(4, "some words", "en")], "doc_id long, text string, lang string"))
    assert alone.languages == ["en"] and alone.predict(["other words", "1"]) == [("en", 1.0), ("und", 0.0)]


def test_sample_is_bounded_and_even(spark):
    rows = [(i, f"text {i}" if i % 3 else "the same text", "many" if i % 10 else "few") for i in range(3000)]
    got = language_id.sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 100).collect()
    assert len(got) <= 100 and len({tuple(r) for r in got}) == len(got)
    assert 25 <= sum(r["lang"] == "few" for r in got) <= 75


def test_chances_equal_a_plain_network():
    """The blocked network against one written out byte by byte."""
    net = language_id.Network.fresh(["a", "b", "c"], seed=3)
    text = "Ein Satz, größer als ein Fenster von Bytes. " * 9
    data = text.lower().encode()
    step, total, weight = language_id.WINDOW - 3, np.zeros(3), 0
    for at in range(0, max(1, len(data) - 3), step):
        window = data[at:at + language_id.WINDOW].ljust(language_id.WINDOW, b"\0")
        pooled = []
        for w, width in enumerate(language_id.WIDTHS):
            for f in range(language_id.FILTERS):
                unit = w * language_id.FILTERS + f
                best = max(sum(float(net.embedding[b] @ net.filters[o * 8:o * 8 + 8, unit]) for o, b in enumerate(window[p:p + width]))
                           for p in range(len(window)))
                pooled.append(max(best + float(net.bias[unit]), 0.0))
        z = np.array(pooled + [1.0]) @ net.out
        own = sum(97 <= b <= 122 or b >= 128 for b in window)
        total += own * np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        weight += own
    total /= weight
    assert net.predict([text])[0][0] == net.languages[int(total.argmax())]
    assert net.predict([text])[0][1] == pytest.approx(total.max(), rel=1e-4)


def test_windows_cover_every_run_of_bytes():
    for n in (0, 1, 3, 127, 128, 129, 253, 254, 1000):
        data = bytes(i % 251 + 1 for i in range(n))
        rows = language_id.windows(data)
        for at in range(n - 3):
            assert any(data[at:at + 4] in r.tobytes() for r in rows)
        assert sum(len(r.tobytes().rstrip(b"\0")) for r in rows) >= n
