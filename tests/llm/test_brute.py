"""Operators against plain versions."""

import hashlib
import io
import random
import re
import zipfile
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from talweg.llm import _blobs, byte_bpe, chat_format, fingerprints, jaccard_join, line_dedup, lm_score, packing, quality_rules, toxicity, warc_zip

SPACES = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_words(text):
    return [w.decode() for w in (text or "").encode().lower().split()]


def shingle_set(text):
    w = ascii_words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain_components(rows):
    sets, by = {}, defaultdict(list)
    for i, t in rows:
        sets[i] = shingle_set(t)
        for s in sets[i]:
            by[s].append(i)
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        shared = Counter(j for x in s for j in by[x] if j > i)
        for j, n in shared.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def near_copies(seed, groups, size, words=60, edits=6):
    """Groups of copies in which a few words were changed."""
    rng, rows = random.Random(seed), []
    for g in range(groups):
        base = [f"w{rng.randrange(4000)}" for _ in range(words)]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randrange(edits)):
                copy[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
            rows.append((len(rows) * 3 + 1, " ".join(copy[: words - rng.randrange(8)]), f"s{g}"))
    return rows


@pytest.mark.parametrize("seed", (1, 2))
def test_jaccard_join_equals_all_pairs(spark, docs, seed):
    rows = near_copies(seed, 6, 30) + [(10_000 + i, f"short {i % 3}", "s") for i in range(9)] + [(20_000, "", "s"), (20_001, None, "s")]
    members, links = jaccard_join.join(docs(rows))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in members.collect()} == plain_components([(i, t) for i, t, _ in rows])


def test_jaccard_join_on_the_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.query(spark, sf).collect()}
    assert got == plain_components(rows)


def test_fingerprints_equal_plain_sketches(spark, sf):
    rows = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    ids = sorted(rows, reverse=True)
    after = dict(zip(ids, [*ids[1:], ids[0]]))
    got = {r.doc_id: r for r in fingerprints.query(spark, sf).collect()}
    exact = []
    for i, t in rows.items():
        half = len(t) // 2
        edited = t[: len(t) - half] + rows[after[i]][:half]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        own, other, following = plain_sketch(t), plain_sketch(edited), plain_sketch(rows[after[i]])
        assert got[i].fingerprint == shown(own) and got[i].edited_fingerprint == shown(other)
        assert got[i].near_edited == pytest.approx(plain_likeness(own, other)) and got[i].near_next == pytest.approx(plain_likeness(own, following))
        a, b = shingle_set(t), shingle_set(edited)
        if len(a) > 300:
            exact.append(got[i].near_edited - len(a & b) / len(a | b))
    assert abs(np.mean(exact)) < 0.03 and np.std(exact) < 0.12


def plain_sketch(text):
    """(hashes below the threshold, the least hash where there are none), as signed 64-bit numbers chained over words."""
    words = ascii_words(text)
    hashes = set()
    for at in range(max(len(words) - 4, min(len(words), 1))):
        h = 42
        for w in words[at : at + 5] if len(words) >= 5 else [" ".join(words)]:
            h = xxhash.xxh64_intdigest(w.encode(), seed=h)
        hashes.add(h - 2**64 if h >= 2**63 else h)
    kept = sorted(h for h in hashes if h < -(2**63) + 2**64 // fingerprints.SCALE)
    return kept, None if kept or not hashes else min(hashes)


def shown(sketch):
    kept, least = sketch
    text = lambda h: f"{h % 2**64:016x}"
    return "".join(map(text, kept)) if least is None else "~" + text(least)


def plain_likeness(a, b):
    x, y = set(a[0]), set(b[0])
    return len(x & y) / len(x | y) if x | y else float(a[1] == b[1])


def test_sketches_merge_and_contain(spark):
    words = [f"w{i}" for i in range(4000)]
    texts = [" ".join(words), " ".join(words[:1500]), " ".join(words[1000:]), *(" ".join(words[i : i + 5]) for i in range(0, 200, 5)), "a b", ""]
    df = fingerprints.with_sketch(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string"), "t", "s")
    got = [(list(r.s.hashes), r.s.least) for r in df.orderBy("i").collect()]
    assert got == [plain_sketch(t) for t in texts] and sum(least is not None for _, least in got[3:43]) > 30
    a, b, c = (set(h) for h, _ in got[:3])
    assert b < a and b | c == a
    groups = [[0, 1], [1, 2], [3, 4, 5], list(range(3, 43)), [43, 44], [44], [1, 3]]
    for group in groups:
        merged = df.filter(F.col("i").isin(group)).agg(F.collect_list("s").alias("s")).select(fingerprints.merge(F.col("s")).alias("m")).first().m
        every = sorted({h for i in group for h in got[i][0]})
        least = [got[i][1] for i in group if got[i][1] is not None]
        assert (list(merged.hashes), merged.least) == (every, None if every or not least else min(least))
    pair = df.alias("x").join(df.alias("y"), F.expr("x.i IN (0, 3, 43, 44) AND y.i IN (0, 1, 3, 43, 44)"))
    for r in pair.select("x.i", F.col("y.i").alias("j"), fingerprints.likeness(F.col("x.s"), F.col("y.s")).alias("l"), fingerprints.containment(F.col("y.s"), F.col("x.s")).alias("c")).collect():
        x, y = got[r.i], got[r.j]
        assert r.l == pytest.approx(plain_likeness(x, y))
        assert r.c == pytest.approx(len(set(x[0]) & set(y[0])) / len(y[0]) if y[0] else float(y[1] is None or x[1] == y[1]))


def test_small_hosts_are_shrunk_to_the_rate_of_all(spark, docs):
    text = lambda i, bad: " ".join(f"{'#' * 9 if bad else ''}word{i}x{j}" for j in range(20))
    rows = [(i, text(i, i % 10 == 0), f"host{i}") for i in range(100)]
    single = {r.doc_id: r for r in quality_rules.host_rules(docs(rows)).collect()}
    assert all(r.kept for r in single.values())
    # one host of many such documents is found out, and only its own bad documents go
    rows = [(i, text(i, i % 2 == 0 if i < 100 else i % 50 == 0), "bad" if i < 100 else f"host{i % 9}") for i in range(1000)]
    got = {r.doc_id: r.kept for r in quality_rules.host_rules(docs(rows)).collect()}
    assert got == {i: not (i < 100 and i % 2 == 0) for i, _, _ in rows}


def test_compacted_runs_are_joined_in_their_order(spark):
    def keys(low, high):
        return spark.range(low, high).select(F.xxhash64("id").alias("h1"), F.xxhash64(F.lit(1), "id").alias("h2"))

    index = line_dedup.LineRuns(spark, 4, fanout=3)
    seen = set()
    for low, high in ((0, 50), (40, 90), (10, 120), (100, 130), (0, 140), (135, 150)):
        marked = index.absorb(keys(low, high)).collect()
        assert sum(not r.seen for r in marked) == len(set(range(low, high)) - seen) and len(marked) == high - low
        seen |= set(range(low, high))
    assert [len(level) for level in index.levels] == [0, 2] and sum(r.count() for r in index.runs()) == 150
    buckets = [re.search(r"_(\d{5})\.", f).group(1) for f in index.runs()[0].inputFiles()]
    assert sorted(buckets) == ["00000", "00001", "00002", "00003"]  # merged runs too have one file a bucket
    with line_dedup.settings(spark, line_dedup.AS_WRITTEN | {"spark.sql.adaptive.enabled": "false"}):
        plan = keys(0, 9).join(index.runs()[0].hint("merge"), line_dedup.KEY, "left")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1 and plan.count("Exchange") == 1 and "SortMergeJoin" in plan


def test_toxicity_of_nulls_and_repeated_ids(spark):
    docs = spark.createDataFrame([(1, "b vile"), (1, "a vile"), (2, None), (None, "vile")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    sample, _ = toxicity.training_sample(docs, labels, F.lit(True))
    assert {(r.text, r.label) for r in sample.collect()} == {("a vile", 1), (None, 0)}


def test_bpe_equals_tiktoken(spark, sf):
    import public_tokenizers
    import tiktoken

    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(40).collect()]
    texts += ["", " ", "aaaaaaaaaaaaaaaaaaaaaaaa", "it's 1234 tabs\t\n\n  end  ", "漢字🙂 ß  x", "<|endoftext|>", "\x00\x01"]
    codec = byte_bpe.Codec(ranks, public_tokenizers.PATTERN)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string")
    for coded in (df.select("i", codec.encode(F.col("text")).alias("ids")), codec.encoded(df, shard_bytes=20_000)):
        got = {r.i: r for r in coded.select("i", "ids", codec.decode(F.col("ids")).alias("back")).collect()}
        assert len(got) == len(texts)
        for i, text in enumerate(texts):
            assert got[i].ids == plain.encode_ordinary(text) and bytes(got[i].back) == text.encode()


def test_long_words_are_merged_like_short_ones(spark):
    import random
    import time

    import public_tokenizers
    import tiktoken

    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    dice = random.Random(5)
    texts = ["".join(dice.choices("abcdeéü", k=n)) for n in (1, 2, 30, 200, 256, 257, 300, 5000, 100_000)] + ["z" * 50_000, None, ""]
    codec, began = byte_bpe.Codec(ranks, public_tokenizers.PATTERN), time.time()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string")
    for r in codec.encoded(df).collect():
        assert r.ids == plain.encode_ordinary(texts[r.i] or "")
    assert time.time() - began < 60
    for word in texts[:6]:
        assert byte_bpe.heap_merge(word.encode(), ranks) == plain.encode_ordinary(word)


def test_bpe_shards_of_odd_rows(spark):
    import public_tokenizers
    import tiktoken

    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    for pattern in (public_tokenizers.PATTERN, r"\p{L}+|\s+"):  # the second leaves gaps between its matches
        plain = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        codec = byte_bpe.Codec(ranks, pattern)
        rows = [(1, None, "a", "x"), (2, "", None, "y"), (None, "zebra 12 zzzqx", "b", None), (4, "zebra 12 zzzqx", "b", "z"), (4, "zebra 12 zzzqx", "b", "z")]
        df = spark.createDataFrame(rows, "i long, text string, words string, ids string")
        for keep in (True, False):
            got = codec.encoded(df, keep=keep, shard_bytes=10)
            assert got.columns == (["i", "text", "words", "ids"] if keep else ["i", "words", "ids"])
            found = [(r.i, r.words, tuple(r.ids)) for r in got.collect()]
            wanted = [(i, w, tuple(plain.encode_ordinary(t or ""))) for i, t, w, _ in rows]
            assert sorted(found, key=repr) == sorted(wanted, key=repr)
        assert codec.encoded(df.limit(0)).collect() == []
        assert [r.ids for r in codec.encoded(df.filter("i < 3")).collect()] == [[], []]


def test_no_row_is_exchanged_for_a_word(spark):
    codec = byte_bpe.Codec({bytes([i]): i for i in range(256)}, r"\w+|\W+")
    plan = codec.encoded(spark.createDataFrame([("ab ba",)], "text string"))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(word" not in plan and "Exchange" in plan


def test_words_are_exchanged_packed():
    """Each word meets all that ask for it, once."""
    from types import SimpleNamespace

    shards = {-7: ["b", "", "é" * 128, "zebra", "b" * 257, "q"], 2**62: ["zebra", "漢字", "b", "q"], 5: ["t"]}
    blobs = [byte_bpe._blob(pa.table({"word": pa.array(x, pa.large_string())})) for x in shards.values()]
    rows = pa.record_batch({"shard": pa.array(list(shards), pa.int64()), "words": pa.array(blobs, pa.large_binary())})
    asked = list(byte_bpe._ask(SimpleNamespace(value={b"t": 0, b"q": 1}), 3)([rows]))
    found = {}
    for bucket in range(3):
        for batch in byte_bpe._distinct(iter([x for x in asked if x["bucket"][0].as_py() == bucket])):
            for word, askers in zip(batch["word"].to_pylist(), batch["askers"].to_pylist()):
                assert word not in found
                found[word] = sorted((x["shard"], x["place"]) for x in askers)
    assert found == {"b": [(-7, 0), (2**62, 2)], "": [(-7, 1)], "é" * 128: [(-7, 2)], "zebra": [(-7, 3), (2**62, 0)], "漢字": [(2**62, 1)]}
    assert list(byte_bpe._distinct(iter([]))) == []


def test_possessive_patterns_match_alike():
    import public_tokenizers
    import regex

    pattern = public_tokenizers.PATTERN
    faster = byte_bpe.possessive(pattern)
    assert faster.count("++") == 4 and byte_bpe.possessive("(a+|b)c+") == "(a+|b)c+" and byte_bpe.possessive(r"a\+|b+") == r"a\+|b++"
    dice = random.Random(2)
    for _ in range(500):
        text = "".join(dice.choices(["a", "é", " ", "  ", "\n", "1", "'s", "'", ".", "#", "漢", "\u0301", "\u00a0", "²"], k=30))
        assert regex.findall(faster, text) == regex.findall(pattern, text)


def test_bpe_of_every_text(spark, sf):
    import hashlib

    import public_tokenizers
    import tiktoken

    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = byte_bpe.query(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = plain.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


@pytest.mark.parametrize("seed", range(6))
def test_packing_places_every_piece_once(seed):
    rng, capacities = random.Random(seed), (8, 16, 32)
    lengths = Counter(rng.randrange(1, 33) for _ in range(rng.randrange(1, 400)))
    found = packing.plan(lengths, capacities)
    bins = {}
    edges = [b[0] for b in found.bins] + [found.n_bins]
    for (first, size, used), stop in zip(found.bins, edges[1:]):
        for b in range(first, stop):
            bins[b] = [size, used, []]
    for n, spots in found.spots.items():
        starts = [s[0] for s in spots] + [lengths[n]]
        for (rank, first, fit, offset), stop in zip(spots, starts[1:]):
            for r in range(rank, stop):
                bins[first + (r - rank) // fit][2].append((offset + (r - rank) % fit * n, n))
    assert sum(len(b[2]) for b in bins.values()) == sum(lengths.values())
    for size, used, items in bins.values():
        items.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(items, items[1:])) and items[0][0] == 0
        assert used == sum(n for _, n in items) <= size == min(c for c in capacities if c >= used)


def test_packing_with_one_size_equals_best_fit_decreasing():
    rng = random.Random(5)
    lengths = [rng.randrange(1, 33) for _ in range(300)]
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(32 - n)
    found = packing.plan(Counter(lengths), (32,))
    edges = [b[0] for b in found.bins] + [found.n_bins]
    used = sorted(32 - b[2] for b, stop in zip(found.bins, edges[1:]) for _ in range(b[0], stop))
    assert used == sorted(rooms)


def test_packed_rows(spark, sf):
    rows = packing.query(spark, sf).toPandas()
    assert not rows.duplicated(["doc_id", "piece"]).any()
    for (_, size), own in rows.groupby(["bin_id", "bin_capacity"]):
        own = own.sort_values("bin_offset")
        ends = (own.bin_offset + own.n_tokens).tolist()
        assert own.bin_offset.tolist() == [0, *ends[:-1]] and ends[-1] <= size
    words = {r.doc_id: len(SPACES.findall(r.text or "")) + 1 for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert rows.groupby("doc_id").n_tokens.sum().to_dict() == words


def test_zip_directories():
    records = [(i, warc_zip.record(i, f"u{i}", bytes([65 + i]) * i, hashlib.sha1(bytes([65 + i]) * i).hexdigest(), None)) for i in range(5)]
    for zip64 in (False, True):
        raw = warc_zip.package(records, zip64)
        if zip64:  # a ZIP64 end record, as packages of more than 65,535 members or 4 GB have
            raw = with_zip64_end(raw)
        read = lambda a, n: raw[a : a + n]  # noqa: E731, B023
        found = warc_zip.directory(read, len(raw))
        with zipfile.ZipFile(io.BytesIO(raw)) as z:
            for name, (at, n, method) in found.items():
                assert method == 0 and raw[at : at + n] == z.read(name)
        got = [warc_zip.parse_record(raw[a : a + n]) for start, sizes in warc_zip.ranges(read, len(raw), 300) for a, n in zip(np.cumsum([start, *sizes[:-1]]), sizes)]
        assert [g[:2] for g in got] == [(i, i) for i in range(5)]


def test_packages_of_several_members():
    """Packages by another writer: two archives, two indexes, a folder, other members, a comment that holds an end mark."""
    payload = lambda i: bytes([65 + i]) * (i * 40 + 1)
    records = [warc_zip.record(i, f"u{i}", payload(i), hashlib.sha1(payload(i)).hexdigest(), None) for i in range(6)]
    halves = {"a.warc.gz": records[:4], "b.warc.gz": records[4:]}

    def build(method=zipfile.ZIP_STORED, names=("a.warc.gz", "b.warc.gz"), skip=None):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
            z.comment = b"note PK\x05\x06" + b"\x00" * 30
            z.writestr("datapackage.json", "{}" * 50, zipfile.ZIP_DEFLATED)
            z.mkdir("archive")
            for name, own in halves.items():
                z.writestr(f"archive/{name}", b"".join(own), method)
            for name in names:
                at, lines = 0, []
                for raw in halves[name]:
                    lines.append(f'com,u)/ 2020 {{"filename": "{name}", "offset": "{at}", "length": "{len(raw)}"}}')
                    at += len(raw)
                if name != skip:
                    z.writestr(f"indexes/{name}.cdxj", "\n".join(lines) + "\n")
        return out.getvalue()

    def found(raw):
        read = lambda a, n: raw[a : a + n]
        rows = [warc_zip.parse_record(raw[a : a + n]) for start, sizes in warc_zip.ranges(read, len(raw), 300) for a, n in zip(np.cumsum([start, *sizes[:-1]]), sizes)]
        return [(r[0], r[6]) for r in rows]

    assert found(build()) == [(i, payload(i)) for i in range(6)]
    for broken in (build(method=zipfile.ZIP_DEFLATED), build(skip="b.warc.gz"), build()[:-1], build().replace(b"PK\x03\x04", b"PK\x03\x05")):
        with pytest.raises(ValueError):
            found(broken)


def with_zip64_end(raw):
    import struct

    at = raw.rfind(b"PK\x05\x06")
    n, length, start = struct.unpack("<HII", raw[at + 10 : at + 20])
    record = b"PK\x06\x06" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, length, start)
    locator = b"PK\x06\x07" + struct.pack("<IQI", 0, at, 1)
    end = b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    return raw[:at] + record + locator + end


def test_broken_payload_is_noticed():
    with pytest.raises(ValueError):
        warc_zip.parse_record(warc_zip.record(1, "u", b"payload", hashlib.sha1(b"other").hexdigest(), None))


def test_blobs_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 1000):
        keys = np.sort(rng.integers(0, 2**64, n, dtype=np.uint64))
        assert (_blobs.unpack(_blobs.pack(keys, True)) == keys).all()
        small = rng.integers(0, 300, n)
        assert (_blobs.unpack(_blobs.pack(small)).astype(int) == small).all()


@pytest.mark.parametrize("order", (1, 2, 3))
def test_lm_equals_plain_counts(spark, docs, order):
    import math

    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("a b c d e f".split()) for _ in range(rng.randrange(9))), "s") for i in range(60)]
    counts = [Counter() for _ in range(order)]
    for i, t, _ in rows:
        if not lm_score.held_out(i):
            w = ["<s>", *t.split(), "</s>"]
            for k in range(1, order + 1):
                counts[k - 1].update(tuple(w[j : j + k]) for j in range(len(w) - k + 1))
    n = sum(c for g, c in counts[0].items() if g != ("<s>",))
    v = sum(g != ("<s>",) for g in counts[0])

    def p(history, word):
        if not history:
            return (counts[0][word,] + 0.1) / (n + 0.1 * (v + 1))
        c = counts[len(history) - 1][history]
        low = p(history[1:], word)
        return low if c == 0 else (counts[len(history)][*history, word] + 4.0 * low) / (c + 4.0)

    got = {r.doc_id: r for r in lm_score.score(docs(rows), order, 4.0, shard_bytes=300, range_bytes=500).collect()}
    for i, t, _ in rows:
        w = ["<s>", *t.split(), "</s>"]
        expected = sum(math.log10(p(tuple(w[max(0, j - order + 1) : j]), w[j])) for j in range(1, len(w)))
        assert got[i].score == pytest.approx(expected, abs=2e-6) and got[i].train_tokens == n


def test_lm_learns_from_held_out_copies(spark, sf):
    rows = lm_score.query(spark, sf).filter("held_out").toPandas()
    assert rows.score.sum() > rows.base_score.sum()


def test_toxicity_on_held_out_labels(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")
    rows = toxicity.query(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    toxic, clean = rows[rows.toxic == 1], rows[rows.toxic == 0]
    order = (toxic.score.to_numpy()[:, None] > clean.score.to_numpy()[None]).mean()
    assert order > 0.9 and (clean.predicted == 0).mean() > 0.97


def test_counterfactuals_lower_the_weight_of_names(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        toxic = i % 2
        words = [rng.choice("the a of on in by for".split()) for _ in range(8)] + (["vile"] if toxic and i % 3 else []) + (["immigrants"] if toxic else [])
        rows.append((i, " ".join(words), toxic))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    free = toxicity.train(docs, labels, F.lit(True), counterfactual_weight=0.0)
    fair = toxicity.train(docs, labels, F.lit(True), counterfactual_weight=20.0)
    neutral = toxicity.text_words("the immigrants on the a")
    assert fair.score(neutral) < free.score(neutral)
    assert fair.score(toxicity.text_words("vile immigrants of the")) > fair.score(neutral)


def test_chat_prefix_and_spans(spark):
    turns = "array<struct<role:string,text:string>>"
    shared = [("user", "hi"), ("assistant", "hello")]
    df = spark.createDataFrame([([*shared, ("user", "x"), ("assistant", "good")], [*shared, ("assistant", "bad")], 1), (shared, shared, 2), (None, shared, 3)], f"chosen {turns}, rejected {turns}, prompt int")
    a, b, c = chat_format.format_pairs(df).collect()
    assert a.n_prompt_turns == 2 and a.prompt == "<|user|>\nhi<|end|>\n<|assistant|>\nhello<|end|>\n"
    (span,) = a.chosen_spans
    assert a.chosen_completion[span.start : span.stop] == "good<|end|>\n"
    assert b.chosen_completion == b.rejected_completion == "" and b.n_prompt_turns == 2
    assert c.n_prompt_turns == 0 and c.rejected_completion != ""


def test_runs_are_compacted(spark):
    index = line_dedup.LineRuns(spark, 2, fanout=2)
    for batch in range(5):
        keys = spark.createDataFrame([(k, k) for k in range(batch, batch + 3)], "h1 long, h2 long")
        seen = {r.h1: r.seen for r in index.absorb(keys).collect()}
        assert seen == {k: k < batch + 2 and batch > 0 for k in range(batch, batch + 3)}
    assert len(index.runs()) <= 3
    held = [r.h1 for run in index.runs() for r in run.collect()]
    assert sorted(held) == list(range(7))


def test_bad_hosts_take_their_borderline_documents(spark, docs):
    good = " ".join(f"word{i}" for i in range(40))
    marked = " ".join(f"word{i}##" for i in range(40))
    junk = "a b"
    rows = [(i, marked, "bad") for i in range(50)] + [(100 + i, good, "good") for i in range(200)] + [(400, marked, "good"), (500, good, "bad")]
    rows += [(600 + i, junk, "junk") for i in range(200)] + [(900, good, "junk"), (901, good, None)]
    kept = {r.doc_id: r.kept for r in quality_rules.host_rules(docs(rows)).collect()}
    assert not kept[0] and kept[100] and kept[400] and kept[500]  # a marked text goes with its bad host only
    assert not kept[900] and kept[901]  # a host of junk is blocked


def test_clashing_columns(spark, docs):
    df = docs(near_copies(9, 2, 3)).withColumns({"n_words": F.lit("x"), "kept": F.lit("x"), "kept_text": F.lit(1), "n_lines": F.lit(1), "piece": F.lit(1), "bin_id": F.lit(1), "score": F.lit("x")})
    assert quality_rules.host_rules(df).count() == 6
    assert line_dedup.dedup_lines(df).count() == 6
    assert packing.pack(df).count() == 6
    assert toxicity.score(df, toxicity.Model({"=x": 1.0}, 0.0)).select("score").first()[0] == pytest.approx(0.5)
