"""Self-join of documents by the Jaccard similarity of their 5-word shingle sets, exact at the threshold.

Prefix filtering under several global token orders: two sets that are similar enough share a token among the first few of
each, in whatever order all tokens are sorted. All orders here put rare shingles first (by document frequency, in finer or
coarser classes) and differ in how they break ties; a pair is a candidate only if it shares prefix tokens under every
order, and if sizes and positions leave room for enough shared tokens. Only then the sets themselves are intersected.

1.  Tasks read the texts once, and deal out (shingle, text) postings by shingle range, packed. Equal texts share one
    64-bit class there. Each range counts in how many classes a shingle occurs and drops those with one.
2.  By class, the remaining shingles are ordered; prefixes are posted. A class whose prefix holds shingles of its own only
    has no partner and is done. Most are.
3.  Cheap links first: in each posting list, each class is compared with a center, in later rounds with several others. Classes found linked need not be
    compared again, so that a group of thousands of near copies costs as many comparisons as it has members.
4.  Then every pair in a common list of the first order that is not yet connected is a candidate, unless a lower bound of
    the sets' difference rules it out (shingles of their own, and the bits in which 512-bit maps of the others differ).
    Its prefixes under the other orders must meet as well; what is left is verified. No cap is set on lists, partners or
    candidates.

Links between different texts are kept in full up to connectivity: two texts have the same component if and only if a
chain of similar pairs leads from one to the other. (Up to collisions of 64-bit hashes, of which fewer than one is
expected below four billion texts.)

Defined results: null and empty texts have no shingles, and are their own component; texts of fewer than five words have
one shingle, the whole sequence; repeated rows are equal texts; rows with a null id take part in no link, their component
is null; an empty table gives an empty table; other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talweg.llm import _blobs as blobs
from talweg.llm import _common as c
from talweg.llm.components import components

SIZE, PERCENT, ORDERS = 5, 75, 3
#: Centers of each posting list, in each round of cheap links.
CENTERS = (1, 8)
#: Bytes of text whose shingles share a range, and that a task packs at once.
RANGE_BYTES, FLUSH_BYTES = 10 << 20, 6 << 20


def order_rank(order: int, keys: np.ndarray, frequency: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort keys (first, second) of the tokens in the given global order."""
    coarse = frequency if order == 0 else np.floor(np.log2(frequency) / order).astype(np.int64)
    return coarse, blobs.mix(keys + np.uint64(order))


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """Tokens of a set of n among which a set of that similarity must have one."""
    return n - -(-percent * n // 100) + 1


def shingles(text: str | None, words: blobs.Words, size: int = SIZE) -> tuple[int, np.ndarray]:
    """The class of the word sequence, and its distinct shingles in ascending order."""
    tokens = (text or "").encode().lower().split()
    name = xxhash.xxh3_64_intdigest(b" ".join(tokens)) >> 1
    if not tokens:
        return name, np.empty(0, np.uint64)
    return name, np.unique(blobs.chain(words(tokens), min(size, len(tokens))) + np.uint64(len(tokens) if len(tokens) < size else 0))


def _post(parts: int, size: int):
    schema = pa.schema([("part", pa.int32()), ("texts", pa.binary()), ("at", pa.binary()), ("keys", pa.binary())])

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = blobs.Words()
        held: dict[int, np.ndarray] = {}
        rows: list[tuple[int, int, int]] = []
        total = 0

        def flush() -> pa.RecordBatch:
            names = np.fromiter(held, np.uint64, len(held))
            keys = np.concatenate([*held.values(), np.empty(0, np.uint64)])
            at = np.repeat(np.arange(len(held)), [len(x) for x in held.values()])
            order = np.argsort(keys, kind="stable")
            keys, at = keys[order], at[order]
            cut, out = blobs.ranges(keys, parts), []
            for p in range(parts):
                own, place = np.unique(at[cut[p] : cut[p + 1]], return_inverse=True)
                if len(own):
                    out.append((p, names[own].tobytes(), blobs.pack(place), blobs.pack(keys[cut[p] : cut[p + 1]], True)))
            table = np.array(rows, dtype=np.int64).reshape(-1, 3)
            bucket = table[:, 1] % parts
            for p in np.unique(bucket):  # what is known of each row goes along, to the bucket of its class
                out.append((parts + int(p), table[bucket == p].tobytes(), b"", b""))
            held.clear()
            rows.clear()
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, x)) for x in out], schema)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                name, keys = shingles(text, words, size)
                rows.append((doc_id, name, len(keys)))
                held.setdefault(name, keys)
                total += len(text or "") + 64
                if total >= FLUSH_BYTES:
                    yield flush()
                    total = 0
        if rows:
            yield flush()

    return post


def _count(parts: int):
    """By range: (bucket, texts, at, keys, frequency) of the shingles that more than one class has; rows pass through."""

    def count(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        columns = ["bucket", "rows", "texts", "at", "keys", "frequency"]
        if key[0] >= parts:
            return pd.DataFrame([(key[0] - parts, b"".join(pdf["texts"]), None, None, None, None)], columns=columns)
        keys = np.concatenate([blobs.unpack(x) for x in pdf["keys"]])
        texts = np.concatenate([np.frombuffer(t, np.uint64)[blobs.unpack(a).astype(np.int64)] for t, a in zip(pdf["texts"], pdf["at"])])
        order = np.argsort(keys, kind="stable")
        keys, texts = keys[order], texts[order]
        same = np.append(keys[1:] == keys[:-1], False)
        again = same | np.append(False, same[:-1])
        keys, texts = keys[again], texts[again]
        order = np.lexsort((texts, keys))
        keys, texts = keys[order], texts[order]
        new = np.append(True, (keys[1:] != keys[:-1]) | (texts[1:] != texts[:-1]))[: len(keys)]
        keys, texts = keys[new], texts[new]  # copies in other tasks posted the same
        _, inverse, frequency = np.unique(keys, return_inverse=True, return_counts=True)
        frequency = frequency[inverse]
        keys, texts, frequency = (x[frequency > 1] for x in (keys, texts, frequency))
        bucket, out = (texts % np.uint64(parts)).astype(np.int64), []
        for b in np.unique(bucket):
            own = bucket == b
            names, at = np.unique(texts[own], return_inverse=True)
            out.append((int(b), None, names.tobytes(), blobs.pack(at), blobs.pack(keys[own], True), blobs.pack(frequency[own])))
        return pd.DataFrame(out, columns=columns)

    return count


BITS = 512
PREFIXED = "doc_id long, text_class long, n long, part int, token long, pos int, tokens array<long>, bits array<long>"


def bit_map(keys: np.ndarray) -> np.ndarray:
    """The tokens' places among BITS, as 64-bit numbers."""
    bits = np.zeros(BITS, np.uint8)
    bits[(blobs.mix(keys + np.uint64(101)) % np.uint64(BITS)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64)


def _prefix(orders: int, percent: int):
    """By bucket of classes: rows of documents (doc_id, class, n), prefix postings (order, token, class, n, pos) and sets (class, n, tokens)."""

    def prefix(key: tuple, pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
        empty = dict.fromkeys(("doc_id", "text_class", "n", "part", "token", "pos", "tokens", "bits"))
        table = np.frombuffer(b"".join(x for x in pdf["rows"] if x is not None), np.int64).reshape(-1, 3)
        docs = pd.DataFrame(empty, index=range(len(table)))
        docs[["doc_id", "text_class", "n"]] = table
        yield docs
        shared = pdf[pdf["texts"].notna()]
        if not len(shared):
            return
        size = dict(zip(table[:, 1].tolist(), table[:, 2].tolist()))
        keys = np.concatenate([blobs.unpack(x) for x in shared["keys"]])
        frequency = np.concatenate([blobs.unpack(x) for x in shared["frequency"]]).astype(np.int64)
        texts = np.concatenate([np.frombuffer(t, np.uint64)[blobs.unpack(a).astype(np.int64)] for t, a in zip(shared["texts"], shared["at"])])
        order = np.lexsort((keys, texts))
        keys, frequency, texts = keys[order], frequency[order], texts[order]
        starts = np.flatnonzero(np.append(True, texts[1:] != texts[:-1]))
        posts, sets = [], []
        for lo, hi in zip(starts, np.append(starts[1:], len(texts))):
            name = int(texts[lo])
            n = size[name]
            own = n - (hi - lo)  # shingles that no other class has come first in every order
            take = prefix_length(n, percent) - own
            if take <= 0:
                continue
            sets.append((name, n, keys[lo:hi].view(np.int64)))
            for k in range(orders):
                first, second = order_rank(k, keys[lo:hi], frequency[lo:hi])
                best = np.lexsort((second, first))[:take]
                posts.append((name, n, k, keys[lo:hi][best].view(np.int64), own + np.arange(len(best))))
        if posts:
            count = [len(x[3]) for x in posts]
            yield pd.DataFrame(empty | {"text_class": np.repeat([x[0] for x in posts], count), "n": np.repeat([x[1] for x in posts], count), "part": np.repeat([x[2] for x in posts], count), "token": np.concatenate([x[3] for x in posts]), "pos": np.concatenate([x[4] for x in posts])})
            yield pd.DataFrame(empty | {"text_class": [x[0] for x in sets], "n": [x[1] for x in sets], "tokens": [x[2] for x in sets], "bits": [bit_map(x[2].view(np.uint64)) for x in sets]})

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        kinds = {"doc_id": "Int64", "text_class": "Int64", "n": "Int64", "part": "Int32", "token": "Int64", "pos": "Int32"}
        return pd.concat([x.astype(kinds) for x in prefix(key, pdf)], ignore_index=True)

    return run


def _roomy(percent: int) -> Column:
    """Whether sizes and positions of the rows aliased x and y leave room for enough shared tokens."""
    return F.expr(f"{100 + percent} * least(x.n - x.pos, y.n - y.pos) >= {percent} * (x.n + y.n) AND 100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)")


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of classes that are similar enough."""
    left = pairs.join(sets.select(F.col("text_class").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta")), "a")
    both = left.join(sets.select(F.col("text_class").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb")), "b")
    both = both.withColumn("shared", F.size(F.array_intersect("ta", "tb")).cast("long"))
    return both.filter(f"100 * shared >= {percent} * (na + nb - shared)").select("a", "b")


def _open(posts: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The postings, with their components, of the lists in which more than one component is left."""
    if labels is not None:
        posts = posts.join(labels.withColumnsRenamed({"node": "text_class", "label": "comp"}), "text_class", "left").withColumn("comp", F.coalesce("comp", "text_class"))
    else:
        posts = posts.withColumn("comp", F.col("text_class"))
    lists = posts.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high").select("token")
    return posts.join(lists, "token")


def _close(percent: int) -> Column:
    """Whether the lower bound of the difference of x and y allows for the similarity."""
    differ = " + ".join(f"bit_count(x.bits{i} ^ y.bits{i})" for i in range(BITS // 64))
    return F.expr(f"{100 + percent} * (x.own + y.own + {differ}) <= {100 - percent} * (x.n + y.n)")


def class_links(posts: DataFrame, sets: DataFrame, orders: int = ORDERS, percent: int = PERCENT, rounds: tuple[int, ...] = CENTERS) -> DataFrame:
    """Links (a, b) between classes, in full up to connectivity."""
    links = labels = None
    now = posts.filter("part = 0").drop("part")
    for k, count in enumerate(rounds):
        now = c.cut(_open(now.drop("comp"), labels))
        ranks = [F.min(F.struct(F.xxhash64("text_class", F.lit(97 * k + i)), "text_class", "n", "pos", "comp")) for i in range(count)]
        first = now.groupBy("token").agg(F.array(*ranks).alias("s")).select("token", F.explode(F.array_distinct("s")).alias("s")).select("token", "s.text_class", "s.n", "s.pos", "s.comp")
        pairs = now.alias("x").join(first.alias("y"), (F.col("x.token") == F.col("y.token")) & (F.col("x.comp") != F.col("y.comp")) & _roomy(percent))
        pairs = pairs.select(F.least("x.text_class", "y.text_class").alias("a"), F.greatest("x.text_class", "y.text_class").alias("b")).distinct()
        found = c.cut(verified(pairs, sets, percent))
        links = found if links is None else links.union(found)
        labels = components(links)
    maps = sets.select("text_class", (F.col("n") - F.size("tokens")).alias("own"), *[F.get("bits", F.lit(i)).alias(f"bits{i}") for i in range(BITS // 64)])
    own = _open(now.drop("comp"), labels).join(maps, "text_class")
    pairs = own.alias("x").join(own.alias("y"), (F.col("x.token") == F.col("y.token")) & F.expr("x.comp <> y.comp AND x.text_class < y.text_class") & _roomy(percent) & _close(percent))
    candidates = c.cut(pairs.select(F.col("x.text_class").alias("a"), F.col("y.text_class").alias("b")).distinct())
    if orders > 1:  # the other orders are asked about these pairs only
        involved = candidates.select(F.col("a").alias("text_class")).union(candidates.select("b")).distinct()
        names = [f"order{k}" for k in range(1, orders)]
        prefixes = posts.filter("part > 0").join(involved, "text_class", "left_semi").groupBy("text_class").agg(*[F.collect_list(F.when(F.col("part") == k, F.col("token"))).alias(n) for k, n in enumerate(names, 1)])
        for side in ("a", "b"):
            candidates = candidates.join(prefixes.select(F.col("text_class").alias(side), *[F.col(n).alias(f"{side}_{n}") for n in names]), side)
        for n in names:
            candidates = candidates.filter(F.arrays_overlap(f"a_{n}", f"b_{n}"))
        candidates = candidates.select("a", "b")
    return links.union(c.cut(verified(candidates, sets, percent)))


def join(df: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = PERCENT, size: int = SIZE, orders: int = ORDERS) -> tuple[DataFrame, DataFrame]:
    """(members, links): members are (doc_id, n_shingles, text_class, component_id) for each row, links pairs of classes."""
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    known = rows.filter("doc_id IS NOT NULL")
    total = known.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    parts = int(1 + total // RANGE_BYTES)
    posted = known.mapInArrow(_post(parts, size), "part int, texts binary, at binary, keys binary")
    counted = posted.groupBy("part").applyInPandas(_count(parts), "bucket int, rows binary, texts binary, at binary, keys binary, frequency binary")
    table = c.stored(counted.groupBy("bucket").applyInPandas(_prefix(orders, percent), PREFIXED), "prefixes")
    docs = table.filter("doc_id IS NOT NULL").select("doc_id", "text_class", "n")
    posts = table.filter("token IS NOT NULL").select("part", "token", "text_class", "n", "pos")
    sets = table.filter("tokens IS NOT NULL").select("text_class", "n", "tokens", "bits")
    links = class_links(posts, sets, orders, percent)
    # nodes are named by their smallest id, so that a component's label is the smallest id in it
    names = c.cut(docs.groupBy("text_class").agg(F.min("doc_id").alias("name"), F.max("n").alias("n")))
    named = links.join(names.select(F.col("text_class").alias("a"), F.col("name").alias("na")), "a").join(names.select(F.col("text_class").alias("b"), F.col("name").alias("nb")), "b")
    labels = components(named.select(F.col("na").alias("a"), F.col("nb").alias("b")))
    named = names.join(labels, names["name"] == labels["node"], "left").select("text_class", F.when(F.col("n") > 0, F.coalesce("label", "name")).alias("label"))
    members = docs.join(named, "text_class").select("doc_id", F.col("n").alias("n_shingles"), "text_class", F.coalesce("label", "doc_id").alias("component_id"))
    nameless = rows.filter("doc_id IS NULL").withColumn("w", c.words(c.lower_ascii(c.text_or_empty("text")))).withColumn("h", c.window_hashes("w", size))
    nameless = nameless.select("doc_id", F.size(F.array_distinct("h")).cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("text_class"), F.lit(None).cast("long").alias("component_id"))
    return members.unionByName(nameless), links


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, _ = join(c.documents(spark, sf_dir))
    return members.select("doc_id", "n_shingles", "component_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays, that with the smallest id (of rows that repeat it, the first text); rows without an id stay."""
    members, _ = join(docs)
    first = members.filter("doc_id = component_id").select("doc_id").distinct()
    kept = docs.filter("doc_id IS NOT NULL").join(first.hint("merge"), "doc_id", "left_semi")
    repeated = members.groupBy("doc_id").count().filter("count > 1 AND doc_id IS NOT NULL").select("doc_id")
    plain = [x for x, kind in docs.dtypes if "map" not in kind and "variant" not in kind]
    once = kept.join(repeated, "doc_id", "left_anti")
    first_text = kept.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(F.struct(*[x for x in docs.columns if x != "doc_id"]), F.struct("text", F.xxhash64(*plain))).alias("s"))
    return once.select(docs.columns).union(first_text.select("doc_id", "s.*").select(docs.columns)).union(docs.filter("doc_id IS NULL"))
