"""Byte-level BPE by Spark's own higher-order functions.

A text is split by the vocabulary's pattern. A word is a byte array with cut positions after every byte; a fold takes out,
step by step, the cut inside the neighbouring pair of lowest rank, leftmost first, until no pair has a rank. The rank map
is a literal: an array addressed by hash, each token in one of two places, so that a lookup takes two probes.

Words repeat, so each distinct word of the table is folded once. Rows are packed in their order into shards of bounded
size; a shard holds its distinct words, and its texts as numbers of these words, and is dealt out compressed. It lists its
words that are no tokens; the lists meet, packed, in buckets of words, where the distinct words are folded; the ids go back
to the shards that have the word, and each shard puts the ids of its texts together. The pattern is matched once a text.
A word of more than LONG_WORD bytes is merged with a heap instead, which gives the same ids in a time that hardly grows
faster than its length.

Decoding looks each id's bytes up and concatenates them: a string function joins the pieces, which adds and checks nothing.

Defined results: a null text is empty and has no ids; null ids decode to null; repeated rows are encoded one by one; an
empty table gives an empty table; other columns stay, except that those named like an output give way. Where a lost task
is run again and its input then comes in another order, a shard misses words and the query fails rather than guess, as a
shard's id depends on its words; scans of files keep their order, and other tables should be stored first.
"""

from __future__ import annotations

import base64
import heapq
import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from talweg.llm import _common as c
from talweg.llm._blobs import pack, unpack

NONE = 2**31 - 1
#: Bits of a pair's place, which stand below its rank: the least pair is that of lowest rank, the leftmost of them.
PLACE_BITS = 24
PLACES = (1 << PLACE_BITS) - 1
NO_PAIR = NONE << PLACE_BITS
#: Places of a fold's best pair: not looked for yet, and none left.
OPEN, DONE = -1, -2
#: Bytes of text in a shard, and bytes of a word beyond which a heap merges it.
SHARD_BYTES, LONG_WORD = 40 << 20, 256


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: lines of a base64 token and its rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _spark_hash(key: bytes) -> int:
    return xxhash.xxh64_intdigest(key, seed=42)


def _places(h: int, bits: int) -> tuple[int, int]:
    return h & ((1 << bits) - 1), (h >> 24) & ((1 << bits) - 1)


def two_place_table(keys: list[bytes]) -> tuple[int, list[bytes | None]]:
    """(bits, slots): every key in one of its two places among 2**bits slots."""
    bits = max(4, (2 * len(keys) + 1).bit_length())
    while True:
        slots: list[bytes | None] = [None] * (1 << bits)
        for key in keys:
            at = _places(_spark_hash(key), bits)[0]
            for _ in range(500):
                key, slots[at] = slots[at], key
                if key is None:
                    break
                one, two = _places(_spark_hash(key), bits)
                at = two if at == one else one
            else:
                break
        else:
            return bits, slots
        bits += 1


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once: the end of a fold over nothing, which copies neither."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda acc, _: acc, body)


class Table:
    """A literal map from bytes; `bound` is its array of slots, to be named once by _let: a plan holds one copy."""

    def __init__(self, entries: dict[bytes, int]):
        self.bits, slots = two_place_table(list(entries))
        shown = [None if k is None else {"k": base64.b64encode(k).decode(), "v": entries[k]} for k in slots]
        self.bound = F.from_json(F.lit(json.dumps(shown)), "array<struct<k: binary, v: int>>")

    def find(self, slots: Column, key: Column, h: Column, otherwise: Column) -> Column:
        """The value of the key, of which h is the xxhash64."""
        mask = F.lit((1 << self.bits) - 1)
        one, two = h.bitwiseAND(mask).cast("int"), F.shiftrightunsigned(h, 24).bitwiseAND(mask).cast("int")
        at = lambda place: F.get(slots, place)
        return F.when(at(one)["k"] == key, at(one)["v"]).when(at(two)["k"] == key, at(two)["v"]).otherwise(otherwise)


def heap_merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one word: the pair of lowest rank, the leftmost of these, is merged until no pair has a rank."""
    if word in ranks:
        return [ranks[word]]
    stop, back = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
    heap: list[tuple[int, int, int, int]] = []

    def offer(at: int) -> None:
        if at >= 0 and stop[at] < len(word):
            found = ranks.get(word[at : stop[stop[at]]])
            if found is not None:
                heapq.heappush(heap, (found, at, stop[at], stop[stop[at]]))

    for at in range(len(word)):
        offer(at)
    while heap:
        _, at, middle, end = heapq.heappop(heap)
        if stop[at] == middle and middle < len(word) and stop[middle] == end:
            stop[at], stop[middle] = end, 0
            if end < len(word):
                back[end] = at
            offer(back[at])
            offer(at)
    ids, at = [], 0
    while at < len(word):
        ids.append(ranks[word[at : stop[at]]])
        at = stop[at]
    return ids


def possessive(pattern: str) -> str:
    """The pattern with every run that ends its alternative taking all it can for good: the same matches in less time.

    Only patterns whose groups are look-aheads without an alternative are changed.
    """
    if not re.fullmatch(r"[^()]*(?:\(\?[!=][^()|]*\)[^()]*)*", pattern):
        return pattern
    return re.sub(r"(?<![\\+*?])\+(?=\||$)", "++", pattern)


class _Places(dict):
    """Numbers words in the order of their first use."""

    def __missing__(self, word: str) -> int:
        place = self[word] = len(self)
        return place


def _folded(word: str, ranks: dict[bytes, int]) -> bool:
    """Whether a word's ids come from the fold: tokens have one id, and long words are merged with a heap."""
    raw = word.encode()
    return len(raw) <= LONG_WORD and raw not in ranks


def _blob(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 9))) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _read(blob: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(blob.as_py()).read_all()


def _shard(rows: pa.Table, text: str, keep: bool, find: Callable, label: str) -> pa.RecordBatch:
    """Rows as one record: its distinct words, the numbers of the texts' words, and the other columns.

    Words stand by falling frequency, those of one frequency in their own order: both numbers and words then pack well. The last column of the rows is each text's number of words. The shard's id is made from its label and its words, so that
    answers to other words never meet it.
    """
    places = _Places()
    codes = [np.fromiter(map(places.__getitem__, find(one.as_py() or "")), np.int32) for one in rows[text]]
    sizes = pa.array([len(x) for x in codes], pa.int64())
    code = np.concatenate(codes)
    words = pa.array(list(places), pa.large_string())
    count = pa.array(np.bincount(code, minlength=len(places)))
    order = pc.sort_indices(pa.table({"n": count, "w": words}), [("n", "descending"), ("w", "ascending")])
    rank = np.empty(len(order), np.int32)
    rank[order.to_numpy()] = np.arange(len(order), dtype=np.int32)
    code = rank[code]
    listed = _blob(pa.table({"word": words.take(order)}))
    numbers = pa.table({"low": pa.array((code & 0xFFFF).astype(np.uint16)), "high": pa.array((code >> 16).astype(np.uint16))})
    kept = rows if keep else rows.remove_column(rows.schema.get_field_index(text))
    kept = kept.append_column("words", sizes)
    shard = xxhash.xxh64_intdigest(label.encode() + listed) - (1 << 63)
    blobs = {"words": listed, "numbers": _blob(numbers), "kept": _blob(kept)}
    return pa.record_batch({"shard": pa.array([shard], pa.int64())} | {k: pa.array([v], pa.large_binary()) for k, v in blobs.items()})


SHARD_SCHEMA = "shard long, words binary, numbers binary, kept binary"


def _pack(text: str, keep: bool, pattern: str, shard_bytes: int) -> Callable:
    """Rows in their order, about shard_bytes of text a shard; here alone the pattern is matched."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find, part = regex.compile(pattern).findall, TaskContext.get().partitionId()
        shards, held, size = 0, [], 0
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch[text]), 0).to_numpy(zero_copy_only=False)
            start = 0
            for i, more in enumerate(sizes.tolist()):
                if size and size + more > shard_bytes:
                    if i > start:
                        held.append(batch.slice(start, i - start))
                    yield _shard(pa.Table.from_batches(held), text, keep, find, f"{part} {shards} ")
                    shards, held, size, start = shards + 1, [], 0, i
                size += more
            if batch.num_rows > start:
                held.append(batch.slice(start))
        if held:
            yield _shard(pa.Table.from_batches(held), text, keep, find, f"{part} {shards} ")

    return pack


def _closed(*parts: bytes) -> bytes:
    """Byte strings as one, compressed: less than as an Arrow stream, which carries its schema."""
    raw = np.array([len(parts), *map(len, parts)], "<i8").tobytes() + b"".join(parts)
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", 9).compress(raw, asbytes=True)


def _opened(blob: bytes) -> list[bytes]:
    raw = pa.Codec("zstd").decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    ends = np.cumsum(np.frombuffer(raw, "<i8", n, 8)) + 8 * (n + 1)
    return [raw[i:j] for i, j in zip([8 * (n + 1), *ends[:-1]], ends)]


def _ends(sizes: np.ndarray) -> pa.Buffer:
    return pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))


def _ask(ranks: Broadcast, buckets: int) -> Callable:
    """The words of each shard that are to be folded, with their numbers there: one value for each bucket of words."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, blob in zip(batch["shard"], batch["words"]):
                places, raws = [], []
                for place, word in enumerate(_read(blob)["word"].to_pylist()):
                    if _folded(word, ranks.value):
                        places.append(place)
                        raws.append(word.encode())
                place = np.array(places, np.int64)
                bucket = np.fromiter(map(zlib.crc32, raws), np.int64, len(raws)) % buckets
                order = np.argsort(bucket, kind="stable")
                for own in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
                    if len(own):
                        words = [raws[i] for i in own.tolist()]
                        asked = _closed(pack(place[own], True), pack(np.fromiter(map(len, words), np.int64, len(words))), b"".join(words))
                        yield pa.record_batch({"bucket": pa.array([int(bucket[own[0]])], pa.int32()), "shard": pa.array([shard.as_py()], pa.int64()), "asked": pa.array([asked], pa.large_binary())})

    return ask


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words of one bucket, each with all that ask for it."""
    words, shards, places = [], [], []
    for batch in batches:
        for shard, blob in zip(batch["shard"].to_pylist(), batch["asked"].to_pylist()):
            place, sizes, text = _opened(blob)
            places.append(unpack(place).astype(np.int32))
            shards.append(np.full(len(places[-1]), shard, np.int64))
            words.append(pa.LargeStringArray.from_buffers(len(places[-1]), _ends(unpack(sizes)), pa.py_buffer(text)))
    if not words:
        return
    coded = pa.chunked_array(words).combine_chunks().dictionary_encode()
    code = coded.indices.to_numpy()
    order = np.argsort(code, kind="stable")
    asked = pa.StructArray.from_arrays([pa.array(np.concatenate(x)[order]) for x in (shards, places)], ["shard", "place"])
    by_word = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.bincount(code))]).astype(np.int32)), asked)
    yield from pa.table({"word": coded.dictionary, "askers": by_word}).to_batches(max_chunksize=20_000)


def _fill(out: str, ranks: Broadcast) -> Callable:
    """The rows of one shard, with the ids gathered from the answers to its words."""

    def fill(shards: pa.Table, answers: pa.Table) -> pa.Table:
        if shards.num_rows != 1:
            raise RuntimeError(f"a shard came {shards.num_rows} times: the input's order has changed between runs of a task")
        words, numbers, rows = (_read(shards[x][0]) for x in ("words", "numbers", "kept"))
        code = numbers["low"].to_numpy().astype(np.int32) | numbers["high"].to_numpy().astype(np.int32) << 16
        ends = np.cumsum(rows.column(rows.num_columns - 1).to_numpy())
        rows = rows.remove_column(rows.num_columns - 1)
        # each distinct word's ids are a range of one array
        ids, asked = answers["ids"].combine_chunks(), answers["place"].to_numpy()
        known = np.zeros(words.num_rows, bool)
        known[asked] = True
        own = np.flatnonzero(~known)
        texts = words["word"].take(pa.array(own)).to_pylist()
        if len(set(asked.tolist())) != len(asked) or any(_folded(w, ranks.value) for w in texts):
            raise RuntimeError("a shard's words are not those it asked for: the input's order has changed between runs of a task")
        merged = [heap_merge(w.encode(), ranks.value) for w in texts]
        flat = np.concatenate([ids.flatten().to_numpy(), np.array([i for word in merged for i in word], np.int32)])
        order = np.concatenate([asked, own])
        count, start = np.zeros(len(known), np.int64), np.zeros(len(known), np.int64)
        count[order] = np.concatenate([pc.list_value_length(ids).to_numpy(), np.array([len(word) for word in merged], np.int64)])
        start[order] = np.cumsum(count[order]) - count[order]
        values = []
        for row in np.split(code, ends[:-1]):
            n = count[row]
            values.append(flat[np.repeat(start[row] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))])
        made = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, values)]), pa.int32()), pa.array(np.concatenate(values)))
        return rows.append_column(out, made)

    return fill


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.by_bytes, self.pattern = ranks, pattern
        self.ranks = Table(ranks)
        by_id = {i: t for t, i in ranks.items()}
        pieces = [base64.b64encode(by_id[i]).decode() if i in by_id else None for i in range(max(by_id, default=-1) + 1)]
        self.pieces = F.from_json(F.lit(json.dumps(pieces)), "array<binary>").cast("array<string>")

    def words(self, text: Column) -> Column:
        return F.regexp_extract_all(text, F.lit("(?U)" + self.pattern), F.lit(0))

    def fold(self, word: Column) -> Column:
        """The ids of one word."""
        return _let(self.ranks.bound, lambda table: self._fold(table, word))

    def _fold(self, table: Column, word: Column) -> Column:
        return _let(word.cast("binary"), lambda b: self._fold_bytes(table, b))

    def _rank(self, table: Column, piece: Column) -> Column:
        return _let(piece, lambda p: _let(F.xxhash64(p), lambda h: self.ranks.find(table, p, h, F.lit(NONE))))

    def _fold_bytes(self, table: Column, b: Column) -> Column:
        n = F.octet_length(b)

        def span(start: Column, stop: Column) -> Column:
            return self._rank(table, F.substring(b, start + 1, stop - start))

        def pair(start: Column, stop: Column, place: Column) -> Column:
            return F.shiftleft(span(start, stop).cast("long"), PLACE_BITS).bitwiseOR(place.cast("long"))

        def state(cuts: Column, pairs: Column, best: Column) -> Column:
            return F.struct(cuts.alias("s"), pairs.alias("v"), best.alias("p"))

        def step(acc: Column, _: Column) -> Column:
            s, v, p = acc["s"], acc["v"], acc["p"]
            lowest = F.array_min(v)
            find = F.when(lowest < NO_PAIR, lowest.bitwiseAND(PLACES).cast("int")).otherwise(DONE)
            # the pairs before and behind the merged one are new, those after it move up by a place
            before, behind = pair(F.get(s, p - 1), F.get(s, p + 2), p - 1), pair(F.get(s, p), F.get(s, p + 3), p)
            keep = lambda x, j: F.when(j < p - 1, x).when(j > p, x - 1).when(j == p, behind).otherwise(before)
            merged = state(F.filter(s, lambda x, i: i != p + 1), F.transform(F.filter(v, lambda x, i: i != p), keep), F.lit(OPEN))
            return F.when(p == DONE, acc).when(p == OPEN, state(s, v, find)).otherwise(merged)

        def ids(acc: Column) -> Column:
            s = acc["s"]
            return F.transform(F.sequence(F.lit(0), F.size(s) - 2), lambda i: span(F.get(s, i), F.get(s, i + 1)))

        pairs = F.transform(F.sequence(F.lit(0), n - 2), lambda i: pair(i, i + 2, i))
        start = state(F.sequence(F.lit(0), n), pairs, F.lit(OPEN))
        merged = F.aggregate(F.sequence(F.lit(1), 2 * n - 1), start, step, ids)
        whole = _let(self._rank(table, b), lambda w: F.when((w != NONE) | (n == 1), F.array(w)).otherwise(merged))
        return F.when(n == 0, F.array().cast("array<int>")).otherwise(whole)

    def encode(self, text: Column) -> Column:
        """array<int>: the ids of the text, special tokens apart, with every word folded where it stands."""
        words = self.words(F.coalesce(text, F.lit("")))
        return _let(self.ranks.bound, lambda ranks: F.flatten(F.transform(words, lambda w: self._fold(ranks, w))))

    def encoded(self, df: DataFrame, text: str = "text", ids: str = "ids", keep: bool = True, shard_bytes: int = SHARD_BYTES) -> DataFrame:
        """df with the ids of the text as array<int>, special tokens apart, and without the text unless it is to be kept."""
        df = df.select(*[x for x in df.columns if x != ids])
        total = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
        n = 1 + total // shard_bytes
        ranks = df.sparkSession.sparkContext.broadcast(self.by_bytes)
        packed = df.mapInArrow(_pack(text, keep, possessive(self.pattern), shard_bytes), SHARD_SCHEMA).repartition(n, "shard")
        # words meet in buckets of bounded size, as packed values: as rows they would take several times the disk
        asked = packed.mapInArrow(_ask(ranks, n), "bucket int, shard long, asked binary").repartitionById(n, "bucket")
        words = asked.mapInArrow(_distinct, "word string, askers array<struct<shard: bigint, place: int>>")
        answers = words.select("askers", self.fold(F.col("word")).alias("ids")).select(F.explode("askers").alias("a"), "ids").select("a.shard", "a.place", "ids")
        fields = [f for f in df.schema.fields if keep or f.name != text]
        schema = StructType(fields).add(ids, ArrayType(IntegerType()))
        return packed.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(_fill(ids, ranks), schema)

    def decode(self, ids: Column) -> Column:
        """binary: the bytes of the ids."""
        return F.array_join(F.transform(ids, lambda i: F.get(self.pieces, i)), "").cast("binary")


def query(spark: SparkSession, sf_dir: str, path: str | None = None, pattern: str | None = None) -> DataFrame:
    if path is None or pattern is None:
        import public_tokenizers

        path, pattern = path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN
    docs = c.documents(spark, sf_dir).select("doc_id", "text")
    codec = Codec(read_ranks(path), pattern)
    coded = codec.encoded(docs, keep=False)
    shown = F.btrim(F.replace(F.to_json("ids"), F.lit(","), F.lit(" ")), F.lit("[]"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(shown.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(codec.decode(F.col("ids")), 256).alias("decoded_sha256"),
    )
