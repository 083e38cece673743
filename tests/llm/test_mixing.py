import random
from collections import Counter, defaultdict

import pytest

from cratework.llm import mixing, tokens

TARGETS = "source string, target_share double, max_repeats int"


def tables(spark, seed=0, n=600):
    rng = random.Random(seed)
    docs = []
    for i in range(n):
        source = rng.choice(["big"] * 8 + ["Mid "] * 3 + ["tiny", " BIG", "other", None])
        docs.append((i, None if i % 50 == 0 else " ".join(rng.choice(["word", "other", "x1", "Жук"]) for _ in range(rng.randrange(0, 40))), source))
    targets = [("big", 0.3, 2), ("mid", 0.4, 3), ("tiny", 0.2, 4), ("nowhere", 0.1, 5)]
    return docs, spark.createDataFrame(docs, "doc_id long, text string, source string"), targets, spark.createDataFrame(targets, TARGETS)


def test_token_counts_are_the_tokenizer(spark):
    import tiktoken  # noqa: F401

    texts = ["hello world", "", None, "<|endoftext|>", "a" * 3000, "  \n\n x", "Ж" * 50]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {r["i"]: r["n_tokens"] for r in tokens.with_token_counts(df, ["i"]).collect()}
    with open(tokens.DEFAULT_VOCABULARY, "rb") as f:
        e = tokens.encoder(f.read())
    assert got == {i: len(e.encode_ordinary(t)) if t else 0 for i, t in enumerate(texts)}
    assert e.decode(e.encode_ordinary("héllo <|endoftext|>")) == "héllo <|endoftext|>"


def test_long_white_space():
    import random

    with open(tokens.DEFAULT_VOCABULARY, "rb") as f:
        e = tokens.encoder(f.read())
    rng = random.Random(1)
    for _ in range(200):
        t = "".join(rng.choice(["a", " ", " " * 7, "\n\n \n", "\t" * 5, "é", ".", "1", "\u3000\xa0 ", "\x1c"]) for _ in range(40))
        assert tokens.count_tokens(e, t, 3) == len(e.encode_ordinary(t)), t
    assert tokens.count_tokens(e, " " * 2_000_000 + "x") > 0


def test_mix_against_exact_queueing(spark):
    docs, d, targets, t = tables(spark)
    mix = mixing.mix_sources(d, t, bucket_rows=5)
    with open(tokens.DEFAULT_VOCABULARY, "rb") as f:
        e = tokens.encoder(f.read())
    size = {i: len(e.encode_ordinary(x)) if x else 0 for i, x, _ in docs}
    total = sum(size.values())
    by = defaultdict(int)
    for i, _, s in docs:
        by[(s or "").strip().lower()] += size[i]
    report = {r["source"]: r for r in mix.report.collect()}
    assert set(report) == {s for s, _, _ in targets}
    for s, share, repeats in targets:
        assert report[s]["size"] == by[s] and report[s]["available"] == by[s] * repeats
        assert report[s]["falls_short"] == (by[s] * repeats < share * total)
    rows = mix.records.collect()
    chosen = sum(r["n_tokens"] for r in rows)
    largest = max(size.values())
    assert total - 4 * largest <= chosen <= total
    uses = Counter((r["source"], r["doc"]) for r in rows)
    caps = {s: r for s, _, r in targets}
    assert all(n <= caps[s] for (s, _), n in uses.items())
    got = Counter()
    for r in rows:
        got[r["source"]] += r["n_tokens"]
    end = mixing.fair_end([(sh, by[s] * rp) for s, sh, rp in targets], total)
    for s, share, repeats in targets:
        fair = min(share * end, by[s] * repeats)
        assert abs(got[s] - fair) <= 2 * largest
        assert report[s]["tokens"] == got[s] and abs(report[s]["actual_share"] - got[s] / chosen) < 1e-9
    # at any point of the mix every source that isn't used up is at its share
    at, so_far = Counter(), 0
    for r in sorted(rows, key=lambda r: r["finish"]):
        at[r["source"]] += r["n_tokens"]
        so_far += r["n_tokens"]
        if not report["tiny"]["falls_short"] and so_far < total / 2:
            assert abs(at["big"] / 0.3 - at["mid"] / 0.4) <= 8 * largest


def test_mix_order_is_stable(spark):
    _, d, _, t = tables(spark, 2, 200)
    one = sorted((r["doc"], r["copy"]) for r in mixing.mix_sources(d, t).records.collect())
    two = sorted((r["doc"], r["copy"]) for r in mixing.mix_sources(d.repartition(7), t).records.collect())
    assert one == two


def test_mix_edges(spark):
    _, d, _, t = tables(spark)
    empty = mixing.mix_sources(d.limit(0), t)
    assert empty.records.count() == 0 and not any(r["falls_short"] for r in empty.report.collect())
    assert mixing.mix_sources(d, t.limit(0)).records.count() == 0
    odd = spark.createDataFrame([("big", None, 2), (" Big", 0.5, None), (None, 0.5, 1), ("mid", 0.1, 0)], TARGETS)
    mix = mixing.mix_sources(d, odd)
    assert {r["source"] for r in mix.records.collect()} <= {" Big"}
    twice = mixing.mix_sources(d.union(d), spark.createDataFrame([("tiny", 1.0, 1)], TARGETS))
    assert twice.report.first()["falls_short"]


def test_fair_end():
    assert mixing.fair_end([(0.5, 100), (0.5, 100)], 100) == 100
    assert mixing.fair_end([(0.5, 10), (0.5, 100)], 100) == pytest.approx(180)
    assert mixing.fair_end([(0.5, 10), (0.5, 20)], 100) == 40
    assert mixing.fair_end([], 100) == 0


def test_mix_with_clashing_names(spark):
    docs, d, targets, t = tables(spark, 3, 150)
    from pyspark.sql import functions as F

    extra = {c: F.lit(1) for c in ("size", "n_tokens", "source_key", "copy", "target_share", "doc")}
    plain = mixing.mix_sources(d, t).report.orderBy("source").collect()
    assert mixing.mix_sources(d.withColumns(extra), t.withColumns({"size": F.lit(2), "source_key": F.lit("q")})).report.orderBy("source").collect() == plain


def test_huge_repeats(spark):
    """However many repeats are allowed, only the copies that the mix has room for are made."""
    rows = [(1, "word " * 60_000, "big"), (2, "one two three four", "tiny"), (3, "", "tiny"), (4, None, "none")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    t = spark.createDataFrame([("big", 0.5, 1), ("tiny", 0.5, 2_000_000_000), ("none", 0.1, 2_000_000_000)], TARGETS)
    mix = mixing.mix_sources(d, t)
    report = {r["source"]: r for r in mix.report.collect()}
    assert not report["tiny"]["falls_short"] and 0.45 < report["tiny"]["actual_share"]
    assert mix.records.filter("source = 'tiny' and n_tokens > 0").count() == report["tiny"]["tokens"] // report["tiny"]["size"]


@pytest.mark.parametrize("seed", [1, 2])
def test_many_sources_like_few(spark, seed):
    """Halving the queues and joining sources by a shuffle changes nothing."""
    rng = random.Random(seed)
    docs = [(i, "word " * rng.randrange(1, 30), f"s{rng.randrange(60)}") for i in range(400)]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string")
    t = spark.createDataFrame([(f"s{i}", rng.random() / 30, rng.randrange(0, 6)) for i in range(70)], TARGETS)
    one, two = mixing.mix_sources(d, t, bucket_rows=4), mixing.mix_sources(d, t, few_sources=3, bucket_rows=4)
    key = lambda m: sorted((r["doc"], r["copy"]) for r in m.records.collect())
    assert key(one) == key(two)
    assert [r["falls_short"] for r in one.report.orderBy("source").collect()] == [r["falls_short"] for r in two.report.orderBy("source").collect()]


def test_cut_by_slots_is_the_longest_row_that_fits(spark):
    rng = random.Random(9)
    rows = [(rng.choice("ab"), i, rng.randrange(1, 9), 0, float(rng.choice([rng.randrange(5), rng.random() * 100]))) for i in range(300)]
    df = spark.createDataFrame(rows, "source_key string, doc int, n_tokens int, copy int, finish double")
    for budget in (0, 1, 250, 700, 10**6):
        want, total = [], 0
        for r in sorted(rows, key=lambda r: (r[4], r[0], r[1], r[3])):
            total += r[2]
            if total > budget:
                break
            want.append(r[1])
        assert sorted(r["doc"] for r in mixing._within(df, budget, 3, 7).collect()) == sorted(want)
