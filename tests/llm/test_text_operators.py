"""Operators over documents, held against plain brute force."""

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from gridmix.llm import byte_bpe, hilbert_sharding, packing, quality_rules, simhash_dedup, token_counts
from gridmix.llm.common import configure, file_bytes, vocabulary
from gridmix.llm.word_bpe import WordBpe

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, TEXT string, start string, ids long, curve long"
LONG = " ".join(f"word{i % 977} und Éa{i}" for i in range(20_000))
ODD = ["a\x1cb c", "ΑΣ ΣΑΣ. Σ", "<|endoftext|> x", "é É  \x85z q", "don't  I'LL x y", " lead", "trail ", "\n", "東京 😀!"]


@pytest.fixture(scope="module")
def docs(spark):
    configure(spark)
    rows = [(1, None), (2, ""), (3, LONG), (None, "no id here"), (4, "same row"), (4, "same row")]
    rows += [(10 + i, t) for i, t in enumerate(ODD)]
    rows += [(100 + i, "the very same text of a hot group\nof copies") for i in range(60)]
    rows += [(200 + i, " ".join(f"w{(i * 31 + k * k) % 97}" for k in range(i))) for i in range(60)]
    return spark.createDataFrame([(i, t, None if k % 5 == 0 else "en", f"src{k % 3}", k % 7 or None, "clash", "clash", 7, 8)
                                  for k, (i, t) in enumerate(rows)], SCHEMA).repartition(5)


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", df.columns[1]).toDF("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def plain(spark, docs):
    return [(r[0], r[1]) for r in docs.collect()]


def test_best_fit_equals_one_by_one():
    rng = np.random.default_rng(3)
    for window, number in ((10, 60), (64, 300), (16, 1), (7, 40)):
        lengths = rng.integers(1, window + 1, number).tolist()
        runs = packing.best_fit(Counter(lengths), window)
        lengths.sort(reverse=True)
        got: dict[int, int] = {}
        for rank, length in enumerate(lengths):
            sequence, offset = packing.run_of(runs, rank)
            assert got.get(sequence, 0) == offset
            got[sequence] = offset + length
        bins: list[int] = []
        for length in lengths:
            fit = [i for i, b in enumerate(bins) if window - b >= length]
            if fit:
                bins[max(fit, key=bins.__getitem__)] += length
            else:
                bins.append(length)
        assert sorted(got.values()) == sorted(bins) and sorted(got) == list(range(len(bins)))


def test_word_bpe_equals_library(plain):
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = [t or "" for _, t in plain]
    some = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", " ", "hello", "É", "é", "\u0558", "\ua7cb", "x", "1", "\n", "'s", "Σ", "\x1c"]
    rng = random.Random(1)
    texts += ["".join(rng.choice(some) for _ in range(rng.randrange(12))) for _ in range(3000)]
    small = WordBpe(file_bytes(path), cache_words=50)  # a cache that is always full
    for _ in range(2):
        assert [list(np.frombuffer(x, "<u4")) for x in small.encode(texts)] == [
            e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_word_bpe_equals_library_on_every_character():
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), WordBpe(file_bytes(path))
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    for at in range(0, len(points), 1 << 16):
        texts = [f"A{chr(c)}b {chr(c)}{chr(c)}1" for c in points[at:at + (1 << 16)]]
        assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)] == [
            e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_packing_keeps_every_id_once(docs, plain):
    pieces = packing.cut_documents(docs, vocabulary("word_bpe_49k.json"), window=64)
    found = packing.assign_windows(pieces, window=64, block=7).collect()
    want = Counter()
    coder = WordBpe(file_bytes(vocabulary("word_bpe_49k.json")))
    for (i, t), ids in zip(plain, coder.encode([t or "" for _, t in plain])):
        ids += (2).to_bytes(4, "little")
        for at in range(0, len(ids), 256):
            want[i, at // 4, bytes(ids[at:at + 256])] += 1
    assert Counter((r["doc_id"], r["start"], bytes(r["ids"])) for r in found) == want
    at: dict[int, int] = {}
    for r in sorted(found, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == at.get(r["sequence_id"], 0)
        at[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(at.values()) <= 64 and sorted(at) == list(range(len(at)))
    assert len(at) <= -(-sum(at.values()) // 64) + 1


def test_quality_counts(docs, plain):
    def brute(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
        times = Counter(windows)
        repeated = {k for i, x in enumerate(windows) if times[x] > 1 for k in range(i, i + 5)}
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated))

    extra = [(500, "a b c d e f a b c d e"), (501, "x x x x x x x x"), (502, "one | two | # $\none | two | # $\n\n \n"), (503, "a b c d e")]
    more = docs.sparkSession.createDataFrame([(i, t, None, None, None, "", "", 0, 0) for i, t in extra], SCHEMA)
    got = quality_rules.judge(docs.union(more)).collect()
    want = Counter((i, *brute(t)) for i, t in plain + extra)
    assert Counter(tuple(r)[:6] for r in got) == want
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert r["kept"] == (not r["base_failed"] and not r["failed_rules"])
    both = docs.union(more)
    unique = both.toDF(*["doc_id", "text", *[f"x{i}" for i in range(7)]])  # the clash is pick's matter
    assert Counter(r["doc_id"] for r in quality_rules.without_poor(unique).collect()) == Counter(r["doc_id"] for r in got if r["kept"])


def test_stop_words_count_where_the_language_has_a_list(spark):
    plain = " ".join(f"wort{i}" for i in range(120))  # no stop word
    rows = [(1, plain, "en"), (2, plain, "pl"), (3, plain, None), (4, plain, "DE-at"), (5, " ".join(plain.split()[:60]), "en"),
            (6, plain + " the and of to", "fr")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: (r["kept"], list(r["failed_rules"])) for r in quality_rules.judge(df).collect()}
    assert got == {1: (False, ["stop_words"]), 2: (True, []), 3: (True, []), 4: (False, ["stop_words"]), 5: (True, []), 6: (True, [])}
    assert {r["doc_id"] for r in quality_rules.without_poor(df).collect()} == {2, 3, 5, 6}
    bare = df.drop("lang")
    assert quality_rules.without_poor(bare).count() == quality_rules.judge(bare).where("kept").count() == 6


def test_simhash_against_all_pairs(spark, docs, plain):
    def brute(text):
        w = (text or "").encode().lower().split()
        if not w:
            return 0
        h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    some = [(i, t) for i, t in plain if t != LONG]
    for _, t in some:
        assert simhash_dedup.fingerprint(t or "") % (1 << 64) == brute(t)
    found = simhash_dedup.groups(docs).collect()
    assert len(found) == len(plain)
    check_classes([(r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in found])


def check_classes(rows):
    fps = sorted({fp for _, fp, _ in rows})
    root = {f: f for f in fps}

    def up(f):
        while root[f] != f:
            f = root[f]
        return f

    for a, b in combinations(fps, 2):
        if (a ^ b).bit_count() <= 2:
            root[up(a)] = up(b)
    least: dict = {}
    for i, fp, _ in rows:
        if i is not None:
            least[up(fp)] = min(i, least.get(up(fp), i))
    assert all(c == least.get(up(fp)) for _, fp, c in rows)


@pytest.mark.parametrize("limit", [2, 16])
def test_links_of_clusters(spark, limit):
    """Random values and a dense cluster, by short lists and by values in between."""
    from gridmix.llm.components import components

    rng = np.random.default_rng(5)
    centre = int(rng.integers(1 << 62))
    values = [int(x) for x in rng.integers(0, 1 << 63, 50)]
    values += [centre ^ sum(1 << int(b) for b in rng.choice(63, int(rng.integers(0, 5)), replace=False)) for _ in range(250)]
    values = sorted(set(values) | {-v - 1 for v in values[-40:]})
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    edges = simhash_dedup.links(df, 2, limit)
    assert edges.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > 2).isEmpty()
    root = {r["node"]: r["root"] for r in components(edges).collect()}
    found = [(v, v % (1 << 64), root.get(v, v)) for v in values]
    by_root: dict = {}
    for v, _, r in found:
        by_root.setdefault(r, []).append(v)
    check_classes([(v, fp, min(by_root[r])) for v, fp, r in found])


def test_components(spark):
    """A path, a star, a cycle, loops, repeated and null ends; least node as root."""
    from gridmix.llm.components import components

    path = [(i, i + 1) for i in range(100, 160)]
    star = [(-5, n) for n in range(1000, 1400)] + [(1000, -5)]
    cycle = [(50, 40), (40, 60), (60, 50)]
    odd = [(7, 7), (8, None), (None, 9), (2, 1), (1, 2), (2, 1)]
    edges = spark.createDataFrame(path + star + cycle + odd, "a long, b long")
    found = components(edges).collect()
    want = {n: 100 for n in range(100, 161)} | {n: -5 for n in [-5, *range(1000, 1400)]}
    want |= {40: 40, 50: 40, 60: 40, 1: 1, 2: 1}
    assert {r["node"]: r["root"] for r in found} == want and len(found) == len(want)
    assert components(edges.limit(0)).columns == ["node", "root"] and components(edges.limit(0)).isEmpty()


def test_sharding_law(docs, plain):
    found = hilbert_sharding.shards(docs, 7).collect()
    assert len(found) == len(plain)
    sizes = Counter(r["shard"] for r in found)
    assert set(sizes) == set(range(7)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        own = sorted((r for r in found if r["shard"] == shard), key=lambda r: r["slot"])
        assert [r["slot"] for r in own] == list(range(n)) and [r["curve"] for r in own] == sorted(r["curve"] for r in own)
    want = Counter((i, len((t or "").encode()) + 1) for i, t in plain)
    assert Counter((r["doc_id"], r["size"]) for r in found) == want


@pytest.mark.parametrize("dims, bits", [(2, 3), (3, 2), (3, 4)])
def test_curve_steps_to_neighbours(spark, dims, bits):
    cells = sorted((r["curve"], r["cell"]) for r in hilbert_sharding.curve_cells(spark, dims, bits).collect())
    assert [c for c, _ in cells] == list(range(1 << dims * bits))
    at = [[cell >> bits * i & ((1 << bits) - 1) for i in range(dims)] for _, cell in cells]
    assert all(sum(abs(x - y) for x, y in zip(a, b)) == 1 for a, b in zip(at, at[1:]))


def test_byte_bpe_equals_tiktoken(docs, plain):
    import tiktoken

    path = vocabulary("byte_bpe_multi_50k.tiktoken")
    ranks = byte_bpe.read_ranks(file_bytes(path))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    both = byte_bpe.decode(byte_bpe.encode(docs, path, public_tokenizers.PATTERN), path, public_tokenizers.PATTERN).collect()
    want = Counter((i, np.array(library.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in plain)
    assert Counter((r["doc_id"], bytes(r["ids"]), bytes(r["decoded"])) for r in both) == want


def test_perfect_hash_is_minimal():
    keys = [f"k{i}".encode() for i in range(3000)]
    table = byte_bpe.PerfectHash(keys, list(range(3000)))
    assert [table.get(k) for k in keys] == list(range(3000)) and len(table.keys) == 3000
    assert table.get(b"other") is None and byte_bpe.PerfectHash([], []).get(b"x") is None


def test_token_counts(docs, plain):
    import tiktoken

    path = vocabulary("byte_bpe_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=byte_bpe.read_ranks(file_bytes(path)))
    lengths = sorted(len(library.encode_ordinary(t or "")) for _, t in plain)
    sums = token_counts.suffix_sums(token_counts.histogram(docs, path, public_tokenizers.PATTERN))
    for r in sums.collect():
        n = r["length"]
        assert r["docs_to"] == sum(x <= n for x in lengths) and r["docs_over"] == sum(x > n for x in lengths)
        assert r["total_tokens"] == sum(x for x in lengths if x <= n)
        assert r["truncated_tokens"] == sum(min(x, n) for x in lengths)
    limits = [1, 5, 512, 100_000]
    assert {r["limit"]: r["tokens"] for r in token_counts.truncated(sums, limits).collect()} == {
        n: sum(min(x, n) for x in lengths) for n in limits}
    half = token_counts.quantiles(sums, [0.5, 1.0]).collect()
    assert half[1]["length"] == lengths[-1] and half[0]["length"] == lengths[-(-len(lengths) // 2) - 1]


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    assert packing.assign_windows(packing.cut_documents(none, vocabulary("word_bpe_49k.json"))).count() == 0
    assert quality_rules.judge(none).count() == 0
    assert simhash_dedup.groups(none).count() == 0
    assert hilbert_sharding.shards(none, 4).count() == 0
    path = vocabulary("byte_bpe_50k.tiktoken")
    assert token_counts.suffix_sums(token_counts.histogram(none, path, public_tokenizers.PATTERN)).count() == 0


# Sharding by whole values of any type


def plain_curve(cell, dims, bits):
    """Skilling's transform of one cell number, in plain integers."""
    x = [(cell >> bits * (dims - 1 - i)) & ((1 << bits) - 1) for i in range(dims)]
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for i in range(dims):
            if x[i] >> bit & 1:
                x[0] ^= low
            else:
                swap = (x[0] ^ x[i]) & low
                x[0], x[i] = x[0] ^ swap, x[i] ^ swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = 0
    for bit in range(bits - 1, 0, -1):
        if x[-1] >> bit & 1:
            turn ^= (1 << bit) - 1
    x = [v ^ turn for v in x]
    return sum((x[i] >> bit & 1) << (bit * dims + dims - 1 - i) for bit in range(bits) for i in range(dims))


@pytest.mark.parametrize("values", [3, 50_000])
def test_curve_places_equal_a_plain_computation(spark, monkeypatch, values):
    import datetime as dt

    monkeypatch.setattr(hilbert_sharding, "VALUES", values)
    rng = np.random.default_rng(8)
    rows = []
    for i in range(120):
        source = None if i % 17 == 0 else f"https://host{int(rng.integers(40)):03d}.example/a/long/common/beginning"
        day = None if i % 19 == 0 else dt.date(2020, 1, 1) + dt.timedelta(days=int(rng.integers(30)))
        rows.append((i if i % 7 else None, f"t{i}", source, day, float(rng.choice([0.5, 1.5, 2.5, -3.0])), "c", 1))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, day date, x double, cell string, rank int")
    found = hilbert_sharding.shards(df, 4, ("source", "day", "x"), 2, keep=("source", "day", "x", "cell", "rank", "shard"))
    assert found.columns == ["doc_id", "size", "text_crc32", "curve", "source", "day", "x", "cell", "rank", "shard", "slot"]

    def places(k):
        there = sorted(r[k] for r in rows if r[k] is not None)
        return {v: 4 * there.index(v) // len(there) for v in there} | {None: 0}

    by = [places(k) for k in (2, 3, 4)]
    want = Counter()
    for r in rows:
        cell = 0
        for k, p in zip((2, 3, 4), by):
            cell = cell << 2 | p[r[k]]
        want[r[2], r[3], r[4], plain_curve(cell, 3, 2)] += 1
    got = found.collect()
    assert Counter((r["source"], r["day"], r["x"], r["curve"]) for r in got) == want
    sizes = Counter(r["shard"] for r in got)
    assert sizes == {0: 30, 1: 30, 2: 30, 3: 30}
    ordered = [r["curve"] for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))]
    assert ordered == sorted(ordered)


def test_long_common_beginnings_take_many_cells(spark):
    rows = [(i, "t", f"https://host{i % 200:03d}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert hilbert_sharding.on_curve(df, ["source"]).select("curve").distinct().count() == 16
    stamped = df.withColumn("at", F.timestamp_seconds(F.col("doc_id") * 3600)).withColumn("ntz", F.col("at").cast("timestamp_ntz"))
    flags = stamped.withColumn("flag", F.col("doc_id") % 2 == 0).withColumn("price", (F.col("doc_id") / 7).cast("decimal(12,3)"))
    for name, cells in (("at", 16), ("ntz", 16), ("flag", 2), ("price", 16)):
        assert hilbert_sharding.on_curve(flags, [name]).select("curve").distinct().count() == cells
    with pytest.raises(ValueError):
        hilbert_sharding.shards(df, 4, ("source", "doc_id"), 9)
