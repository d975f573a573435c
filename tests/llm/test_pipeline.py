"""The pipeline against a plain version of its stages."""

import corpus_pipeline
from test_brute import ascii_words, plain_components

from talweg.llm import _common, line_dedup, quality_rules, toxicity


def test_stages_and_run(spark, sf):
    docs = _common.documents(spark, sf)
    columns, rows = docs.columns, {r.doc_id: r for r in docs.collect()}
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = _common.stored(stage(spark, docs, sf), name)
        seen[name] = docs
        assert name == "packing" or docs.columns == columns
    model = toxicity.trained(spark, _common.documents(spark, sf), sf)
    kept = {i for i, r in rows.items() if model.score(toxicity.text_words(r.text)) < toxicity.THRESHOLD}
    assert {r.doc_id for r in seen["toxicity"].collect()} == kept

    def passes(text):
        words = SPACED(text)
        grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        twice = {g for g in grams if grams.count(g) > 1} if len(set(grams)) < len(grams) else set()
        covered = {j for i, g in enumerate(grams) if g in twice for j in range(i, i + 5)}
        return len(words) >= quality_rules.MIN_WORDS and 100 * len(covered) <= quality_rules.MAX_REPEAT_PERCENT * len(words)

    base = {i for i in kept if passes(rows[i].text or "")}
    judged = {r.doc_id for r in seen["quality_rules"].collect()}
    assert judged <= base and len(judged) >= 0.95 * len(base)  # hosts decide on the rest

    texts = {r.doc_id: r.text for r in seen["quality_rules"].collect()}
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(str.maketrans(_common.UPPER, _common.LOWER))
    first: dict = {}
    for i in sorted(texts):
        for line in texts[i].split("\n"):
            first.setdefault(key(line), i)
    deduped = {}
    for i, t in texts.items():
        lines = t.split("\n")
        left = [x for x in lines if len(key(x)) < line_dedup.MIN_CHARS or first[key(x)] == i]
        if len(left) == len(lines) or "".join(left).strip():
            deduped[i] = "\n".join(left)
    assert {r.doc_id: r.text for r in seen["line_dedup"].collect()} == deduped
    members = plain_components(list(deduped.items()))
    unique = {i for i, (_, c) in members.items() if c == i}
    assert {r.doc_id for r in seen["jaccard_join"].collect()} == unique
    lengths = seen["packing"].groupBy("doc_id").sum("n_tokens").collect()
    assert {r[0]: r[1] for r in lengths} == {i: len(ascii_words(deduped[i])) + 1 for i in unique}
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).collect())) == sorted(map(tuple, seen["packing"].collect()))


def SPACED(text):
    return [w.decode() for w in text.encode().split()]


def test_extra_columns_pass_every_stage(spark, docs):
    from conftest import ODD
    from pyspark.sql import functions as F

    clash = ["kept", "kept_text", "n_words", "n_lines", "n_dropped", "base_failed", "host_blocked", "word_chars", "__score", "component_id", "label"]
    long = [(100 + i, " ".join(f"w{i}x{j}" for j in range(40)), "s") for i in range(5)] + [(106, " ".join(f"w1x{j}" for j in range(40)), "s")]
    table = docs(ODD + long).withColumns({x: F.concat(F.lit(f"{x} of "), F.col("doc_id").cast("string")) for x in clash})
    table = table.withColumn("m", F.create_map(F.lit("id"), F.col("doc_id")))
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        done = stage(spark, table, "")
        assert done.columns == table.columns
        for r in done.filter("doc_id IS NOT NULL").collect():
            assert all(r[x] == f"{x} of {r.doc_id}" for x in clash) and r.m == {"id": r.doc_id}, name
        assert {r.doc_id for r in done.select("doc_id").collect()} >= {100, 101, 102}
    scored = toxicity.score(table, toxicity.Model({}, -3.0), out="__tox").filter("__tox < 0.7").select(table.columns)
    assert scored.count() == table.count()
