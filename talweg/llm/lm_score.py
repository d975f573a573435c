"""Language-model scoring by a weighted backoff automaton.

The model is an n-gram model with hierarchical Dirichlet smoothing over the whole training part of the corpus:
p(w | h) = (c(hw) + MU * p(w | h')) / (c(h) + MU), h' the history without its first word, down to the base distribution
(c(w) + 0.1) / (N + 0.1 (V + 1)). As an automaton: every history with a count is a state; a seen n-gram hw is an arc of
state h with weight log p(w | h); every state has a failure arc to h' with weight log(MU / (c(h) + MU)), taken where there
is no arc for the next word; the root accepts every word.

An automaton of the whole corpus has no bound, so none is broadcast. Documents are dealt into shards of bounded size. Each
shard sends what it has of each n-gram to that n-gram's key range, there all shards' counts meet, and the total goes back
to the shards that hold the n-gram, unless it is the shard's own count. So each shard gets exactly the arcs and states its
own texts can reach, with the counts of the whole corpus, and passes through each text once from left to right: the state
at a word is the longest known suffix of what was read, and the log-probabilities along the path add up. All texts of a
shard take their next step together, each with the state it carries; where a state has no arc for the word, its failure
arc is taken, as often as need be.

Tokens are lower-cased (A-Z) runs of other than ASCII white space, then one end token per text. Keys are 64-bit hashes.

Defined results: null texts are empty and have one token, the end; rows with a null id are trained on and scored;
repeated rows count as often as they occur; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talweg.llm import _blobs as blobs
from talweg.llm import _common as c

ORDER, MU = 2, 256.0
ALPHA = 0.1
#: Bytes of text in a shard, and of text whose n-grams share a key range.
SHARD_BYTES, RANGE_BYTES = 10 << 20, 24 << 20
START, END = b"\x00start", b"\x00end"  # no word: NUL would be part of one, but words are hashed with another seed below
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(int(doc_id)).encode()) % 10 == 0


def _mark(which: bytes) -> np.uint64:
    import xxhash

    return np.uint64(xxhash.xxh3_64_intdigest(which, seed=1))


class Shard:
    """The token hashes of some texts, and their n-grams.

    tokens: start, words and end of each text in a row; doc: the text each token is of.
    """

    def __init__(self, texts: list[str | None], train: np.ndarray, order: int):
        words, parts = blobs.Words(), []
        start, end = np.array([_mark(START)]), np.array([_mark(END)])
        for text in texts:
            parts += [start, words((text or "").encode().lower().split()), end]
        lengths = [len(parts[i]) + 2 for i in range(1, len(parts), 3)]
        self.tokens = np.concatenate(parts) if parts else np.empty(0, np.uint64)
        self.doc = np.repeat(np.arange(len(texts)), lengths)
        self.place = np.arange(len(self.tokens)) - np.repeat(np.cumsum([0, *lengths[:-1]]), lengths)
        self.keys, self.inverse, self.counts = [], [], []
        trained = train[self.doc]
        for k in range(1, order + 1):
            here = self.place >= k - 1
            whole = np.zeros(len(self.tokens), np.uint64)
            if len(self.tokens) >= k:
                whole[k - 1 :] = blobs.chain(self.tokens, k)
            keys, inverse = np.unique(whole[here], return_inverse=True)
            at = np.full(len(self.tokens), -1, np.int64)
            at[here] = inverse
            self.keys.append(keys)
            self.inverse.append(at)  # of the n-gram that ends at the token
            self.counts.append(np.bincount(inverse[trained[here]], minlength=len(keys)))


def _ask(order: int, parts: int):
    def ask(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        shard = Shard(list(pdf["text"]), np.array([not held_out(x) for x in _ids(pdf)], bool), order)
        cuts = [blobs.ranges(k, parts) for k in shard.keys]
        rows = [(key[0], p, [blobs.pack(k[a[p] : a[p + 1]], True) for k, a in zip(shard.keys, cuts)], [blobs.pack(n[a[p] : a[p + 1]]) for n, a in zip(shard.counts, cuts)]) for p in range(parts)]
        return pd.DataFrame(rows, columns=["shard", "part", "keys", "counts"])

    return ask


def _ids(pdf: pd.DataFrame) -> list[int | None]:
    return [None if pd.isna(x) else int(x) for x in pdf["doc_id"]]


def _answer(order: int):
    start = blobs.chain(np.array([_mark(START)]), 1)[0]

    def answer(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        shards = pdf["shard"].tolist()
        keys_out, counts_out = [[] for _ in shards], [[] for _ in shards]
        n_tokens = n_types = 0
        for k in range(order):
            keys = [blobs.unpack(x[k]) for x in pdf["keys"]]
            own = [blobs.unpack(x[k]).astype(np.int64) for x in pdf["counts"]]
            every = np.concatenate(keys)
            ordered, inverse = np.unique(every, return_inverse=True)
            total = np.bincount(inverse, np.concatenate(own), len(ordered)).astype(np.int64)
            if k == 0:
                word = ordered != start
                n_tokens, n_types = int(total[word].sum()), int((total[word] > 0).sum())
            at = 0
            for i, (a, n) in enumerate(zip(keys, own)):
                full = total[inverse[at : at + len(a)]]
                at += len(a)
                more = full != n
                keys_out[i].append(blobs.pack(a[more], True))
                counts_out[i].append(blobs.pack(full[more]))
        return pd.DataFrame({"shard": shards, "keys": keys_out, "counts": counts_out, "n_tokens": n_tokens, "n_types": n_types})

    return answer


class Automaton:
    """States, arcs and failure arcs for the n-grams of a shard, whose counts are those of the whole corpus.

    The state of a history of k words is its n-gram's number among those of k words; the root is the empty history. An
    arc is an n-gram with a count: it leaves the state of all words but the last. A state's failure arc leads to the
    history without its first word.
    """

    def __init__(self, shard: Shard, n: int, v: int, mu: float):
        self.shard, self.order = shard, len(shard.keys)
        seen = shard.counts[0]
        self.base = np.log10((seen + ALPHA) / (n + ALPHA * (v + 1)))
        self.known = [np.ones(len(seen), bool)]  # the root has an arc for every word
        self.arcs, self.fails = [self.base], [np.zeros(len(seen))]
        low = 10.0**self.base
        for k in range(1, self.order):
            count, here = shard.counts[k], np.flatnonzero(shard.place >= k)
            history, suffix = np.zeros(len(count), np.int64), np.zeros(len(count), np.int64)
            history[shard.inverse[k][here]] = shard.inverse[k - 1][here - 1]
            suffix[shard.inverse[k][here]] = shard.inverse[k - 1][here]
            total = shard.counts[k - 1][history]
            low = np.where(total > 0, (count + mu * low[suffix]) / (total + mu), low[suffix])
            self.known.append(count > 0)
            self.arcs.append(np.log10(low))
            self.fails.append(np.log10(mu / (total + mu)))  # of the state an n-gram leaves

    def walk(self) -> np.ndarray:
        """The log10 probability of each text: one pass, the length of the history as the state carried along."""
        shard, texts = self.shard, int(self.shard.doc[-1]) + 1 if len(self.shard.doc) else 0
        starts = np.flatnonzero(shard.place == 0)
        sizes = np.diff([*starts, len(shard.place)])
        longest = np.argsort(-sizes, kind="stable")
        sum_, states = np.zeros(texts), np.zeros(texts, np.int64)
        if self.order > 1:  # a text begins in the state of its start, where the corpus has one
            states = (shard.counts[0][shard.inverse[0][starts]] > 0).astype(np.int64)
        active = texts
        for step in range(1, int(sizes.max(initial=0))):
            while active and sizes[longest[active - 1]] <= step:
                active -= 1
            who = longest[:active]
            at, level, gain = starts[who] + step, states[who], np.zeros(active)
            for k in range(self.order - 1, -1, -1):
                mine = np.flatnonzero(level == k)
                if len(mine):
                    arc = shard.inverse[k][at[mine]]
                    found = self.known[k][arc]
                    gain[mine] += np.where(found, self.arcs[k][arc], self.fails[k][arc])
                    # an arc leads to the history it makes, as far as states go; an unknown word to the root; a failure one down
                    last = found & (shard.counts[k][arc] > 0)
                    level[mine] = np.where(found, np.where(last, -1 - min(k + 1, self.order - 1), -1), k - 1)
            sum_[who] += gain
            states[who] = -1 - level
        return sum_


def _walk(order: int, mu: float):
    def walk(key: tuple, pdf: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        ids = _ids(pdf)
        out = np.array([held_out(x) for x in ids], bool)
        shard = Shard(list(pdf["text"]), ~out, order)
        for k in range(order):
            for keys, counts in zip(answers["keys"], answers["counts"]):
                shard.counts[k][np.searchsorted(shard.keys[k], blobs.unpack(keys[k]))] = blobs.unpack(counts[k]).astype(np.int64)
        n, v = int(answers["n_tokens"].sum()), int(answers["n_types"].sum())
        automaton = Automaton(shard, n, v, mu)
        read = shard.place > 0  # every token but the starts
        word, doc, size = shard.inverse[0][read], shard.doc[read], len(ids)
        return pd.DataFrame(
            {
                "doc_id": pd.array(ids, "Int64"),
                "held_out": out,
                "n_tokens": np.bincount(doc, minlength=size).astype(np.int64),
                "n_known": np.bincount(doc, shard.counts[0][word] > 0, size).astype(np.int64),
                "train_tokens": n,
                "base_score": np.round(np.bincount(doc, automaton.base[word], size), 6),
                "score": np.round(automaton.walk(), 6),
            }
        )

    return walk


def score(df: DataFrame, order: int = ORDER, mu: float = MU, shard_bytes: int = SHARD_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """SCORES of the rows (doc_id, text); trained on those whose id is not held out."""
    df = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = df.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards, parts = 1 + total // shard_bytes, 1 + total // range_bytes
    # one shuffle of the texts: both passes group by the shard
    dealt = df.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int"))
    dealt = dealt.repartition(int(shards), "shard")
    asked = dealt.groupBy("shard").applyInPandas(_ask(order, int(parts)), "shard int, part int, keys array<binary>, counts array<binary>")
    answers = asked.groupBy("part").applyInPandas(_answer(order), "shard int, keys array<binary>, counts array<binary>, n_tokens long, n_types long")
    return dealt.groupBy("shard").cogroup(answers.groupBy("shard")).applyInPandas(_walk(order, mu), SCORES)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(c.documents(spark, sf_dir))


def sql(source: str = "documents") -> str:
    """For ORDER 2. crc32 is not in DuckDB: its table is built from the polynomial."""
    return rf"""
WITH RECURSIVE bits(b, r, k) AS (SELECT range::UBIGINT, range::UBIGINT, 0 FROM range(256) UNION ALL
 SELECT b, CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384::UBIGINT) ELSE r >> 1 END, k + 1 FROM bits WHERE k < 8),
tab AS (SELECT list(r ORDER BY b) AS t FROM bits WHERE k = 8),
crc AS (SELECT doc_id, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
  lambda a, x: xor(a >> 8, t[((xor(a, x) & 255) + 1)::BIGINT])), 4294967295::UBIGINT) % 10 = 0 AS held_out FROM (SELECT DISTINCT doc_id FROM {source}), tab),
d AS (SELECT row_number() OVER () AS r, doc_id, held_out, list_concat(['<s>'], list_transform(regexp_extract_all(translate(coalesce(text, ''), '{c.UPPER}', '{c.LOWER}'), '[^\x20\x09-\x0D]+'), lambda x: 'w' || x), ['</s>']) AS w
 FROM {source} JOIN crc USING (doc_id)),
x AS (SELECT r, doc_id, held_out, w[i - 1] AS u, w[i] AS v FROM (SELECT *, unnest(range(2, len(w) + 1)) AS i FROM d)),
n AS (SELECT v, count(*) AS c FROM x WHERE NOT held_out GROUP BY v),
s AS (SELECT sum(c)::BIGINT AS n, count(*) AS v FROM n),
h AS (SELECT u, count(*) AS c FROM x WHERE NOT held_out GROUP BY u),
b AS (SELECT u, v, count(*) AS c FROM x WHERE NOT held_out GROUP BY u, v),
p AS (SELECT x.*, coalesce(n.c, 0) AS c1, (coalesce(n.c, 0) + {ALPHA}::DOUBLE) / (s.n + {ALPHA}::DOUBLE * (s.v + 1)) AS p1, s.n AS total, coalesce(b.c, 0) AS c2, coalesce(h.c, 0) AS ch
 FROM x CROSS JOIN s LEFT JOIN n ON n.v = x.v LEFT JOIN h ON h.u = x.u LEFT JOIN b ON b.u = x.u AND b.v = x.v)
SELECT any_value(doc_id) AS doc_id, any_value(held_out) AS held_out, count(*)::BIGINT AS n_tokens, count(*) FILTER (c1 > 0)::BIGINT AS n_known, any_value(total)::BIGINT AS train_tokens,
 round(fsum(log10(p1)), 6) AS base_score, round(fsum(log10((c2 + {MU}::DOUBLE * p1) / (ch + {MU}::DOUBLE))), 6) AS score FROM p GROUP BY r"""
