import random

import numpy as np
import pyarrow as pa

from cratework.llm import stuffing
from cratework.llm.words import slices, words

NOUNS = ["bridge", "mill", "harbour", "garden", "tower", "record", "station", "valley", "museum", "canal"]
ADJECTIVES = ["old", "small", "quiet", "early", "public", "narrow", "rare", "large"]
PLACES = [a + b for a in ("Ta", "Mo", "Ke", "Ru", "Zo") for b in ("li", "ra", "no", "vu", "dena")]


def sentence(rng):
    a, n, m, p = rng.choice(ADJECTIVES), rng.choice(NOUNS), rng.choice(NOUNS), rng.choice(PLACES)
    return rng.choice([
        f"The {a} {n} of {p} was rebuilt in {rng.randrange(1700, 2000)} by {rng.choice(PLACES)} {rng.choice(PLACES)}.",
        f"Most visitors reach the {n} from {p}, although a {a} path also leads past the {m}.",
        f"In {rng.randrange(1700, 2000)}, {rng.choice(PLACES)} found the {n} near {p} after a {a} dispute over the {m}.",
        f"Its name comes from {p}, which is a {a} place with a {n} and a {m}.",
    ])


def article(rng, n=12):
    return "\n\n".join(sentence(rng) for _ in range(n))


def keywords(rng):
    return [f"{rng.choice(ADJECTIVES)} {rng.choice(NOUNS)}" for _ in range(3)] + ["cheap shoes", "fast loans"]


def spam(rng, kind):
    k = keywords(rng)
    return {
        0: lambda: ", ".join(rng.choice(k) for _ in range(80)),
        1: lambda: "\n".join(f'<a href="http://www.{rng.choice(PLACES).lower()}{i}.example">{rng.choice(k)} {rng.choice(PLACES)}</a>' for i in range(30)),
        2: lambda: "\n".join(f"{rng.choice(['ABC', 'XYZ'])}-{rng.randrange(9999)} / M / {rng.choice(k)} / {rng.randrange(300)}.90 €" for _ in range(25)),
        3: lambda: " ".join("#" + rng.choice(k).replace(" ", "_") for _ in range(40)),
        4: lambda: "\n".join(f"http://{rng.choice(PLACES).lower()}{i}.example/{rng.choice(PLACES).lower()}" for i in range(40)),
        6: lambda: ", ".join(f"{x} {p}" for p in rng.sample(PLACES, 8) for x in (rng.choice(k) for _ in range(6))),
        5: lambda: sentence(rng) + '\n\n<div style="display:none">' + " ".join(rng.choice(k) for _ in range(120)) + "</div>",
    }[kind]()


def decoy(rng, kind):
    return {
        0: lambda: article(rng) + "\n\n" + ", ".join(rng.choice(keywords(rng)) for _ in range(10)),
        1: lambda: '{| class="wikitable"\n' + "\n".join(f"|-\n! {rng.choice(PLACES)}{i}x\n| {rng.randrange(9999)} || align=right | {rng.randrange(99)}" for i in range(40)) + "\n|}",
        2: lambda: "\n".join(f"* [[{rng.choice(PLACES)} {rng.choice(NOUNS)}]] ({rng.randrange(1800, 2000)}), {sentence(rng)}" for _ in range(15)),
        3: lambda: "#REDIRECT [[" + rng.choice(PLACES) + "]]",
        4: lambda: "\n".join(f"[[Category:{rng.choice(PLACES)}{i}]]" for i in range(20)),
        5: lambda: sentence(rng) + " [http://www.page.example link title]",
        6: lambda: "'''Talira''':\n\n" + "\n".join(f"* [[Talira ({n})]], {rng.choice(ADJECTIVES)} {rng.choice(NOUNS)}, {rng.choice(PLACES)}{i}x" for i, n in enumerate(NOUNS[:4] * 5)),
    }[kind]()


def corpus():
    rng = random.Random(5)
    rows = [(i, article(rng), False) for i in range(300)]
    rows += [(1000 + i, spam(rng, i % 7), True) for i in range(42)]
    rows += [(2000 + i, decoy(rng, i % 7), False) for i in range(70)]
    return rows + [(3000, None, False), (3001, "", False), (3002, " \n—", False), (3003, article(rng, 3000), False)]


def test_planted_pages(spark):
    rows = corpus()
    df = spark.createDataFrame([r[:2] for r in rows] + [rows[300][:2]], "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r for r in stuffing.stuffed_pages(df).collect()}
    truth = {r[0] for r in rows if r[2]}
    found = {i for i, r in got.items() if r["is_spam"]}
    assert len(found & truth) >= 0.95 * len(truth), sorted(truth - found)
    assert len(found - truth) <= 0.05 * len(truth), sorted(found - truth)
    assert got[3000]["n_words"] == 0 and got[3000]["mean_pmi"] is None and not got[3001]["is_spam"]
    assert all(got[i]["n_words"] == len(words(t)) for i, t, _ in rows)


def test_same_result_however_cut(spark):
    rows = [r[:2] for r in corpus()[250:340]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    a = sorted((r["doc_id"], r["spam_words"], r["is_spam"]) for r in stuffing.stuffed_pages(df.coalesce(1)).collect())
    b = sorted((r["doc_id"], r["spam_words"], r["is_spam"]) for r in stuffing.stuffed_pages(df.repartition(6)).collect())
    assert a == b


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert stuffing.stuffed_pages(df).count() == 0


def test_statistics_by_brute_force(spark):
    texts = ["a b a b c", "a b\nc a", "1 a 2 b", None, "C a", "d"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["key"]: (r["n"], r["d"]) for r in stuffing.corpus_counts(df).collect()}
    assert got.pop(stuffing.DOCS)[0] == 5 and got.pop(stuffing.WORDS)[0] == 14 and got.pop(stuffing.PAIRS)[0] == 8
    key = {w: np.array([stuffing.word_key(w)], np.uint64) for w in "abc"}
    pair = lambda x, y: int(stuffing.pair_keys(key[x], key[y]).view(np.int64)[0])
    one = lambda x: int(key[x].view(np.int64)[0])
    # what is in more than one document; numbers are no words, lines part neighbours, a short page counts a pair once
    assert got == {one("a"): (6, 4), one("b"): (4, 3), one("c"): (3, 3), pair("a", "b"): (3, 3), pair("c", "a"): (2, 2)}


def test_candidates_lose_no_page(spark):
    """With only the head known, the bound is never below the labels that all counts give."""
    texts = pa.array([r[1] for r in corpus()])
    df = spark.createDataFrame([r[:2] for r in corpus()], "doc_id long, text string")
    rows = stuffing.corpus_counts(df).toArrow()
    k, n, d = rows.column("key").to_numpy().view(np.uint64), rows.column("n").to_numpy(), rows.column("d").to_numpy()
    pairs = float(n[k == stuffing.PAIRS][0])
    exact = stuffing.score(texts, [stuffing.Counts(k, n, d)], pairs)[1]
    for least in (1, 5, 40, 10**9):
        head = stuffing.Counts(k[d > least], n[d > least], d[d > least])
        most = stuffing.score(texts, [head], pairs, bound=True)[1]
        assert (most >= exact).all()


def test_pmi_decides(spark):
    """Without the expectation that PMI gives, pages of ordinary repeated phrases are flagged."""
    rng = random.Random(3)
    rows = [(i, article(rng, 40)) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    assert not [r for r in stuffing.stuffed_pages(df).collect() if r["is_spam"]]
    texts = pa.array([r[1] for r in rows])
    nothing = stuffing.Counts(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0))
    total, spam, _ = stuffing.score(texts, [nothing], 1e5)
    assert (spam > stuffing.SPAM_SHARE * total).mean() > 0.5


def test_slices():
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(["x" * 10, None, "y" * 50, "", "z" * 5, "w" * 30, "v"])], names=["i", "t"])
    parts = list(slices(iter([batch]), 1, 40))
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch])) and len(parts) > 2


def shuffled(rng, per_line):
    """Frequent words of the articles in random order, without a link, a tag or a pair three times on the page."""
    pool = [w for t in ADJECTIVES + NOUNS + PLACES for w in [t] * 7]
    while True:
        rng.shuffle(pool)
        pairs = [p for i in range(0, len(pool), per_line) for p in zip(pool[i : i + per_line], pool[i + 1 : i + per_line])]
        if max(pairs.count(p) for p in set(pairs)) < stuffing.REPEATS:
            return "\n".join(" ".join(pool[i : i + per_line]) for i in range(0, len(pool), per_line))


def test_salad_without_repeated_pairs(spark):
    rng = random.Random(11)
    rows = [(i, article(rng)) for i in range(300)] + [(1000 + i, shuffled(rng, 301 if i < 3 else 3)) for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"] for r in stuffing.stuffed_pages(df).collect() if r["is_spam"]} == set(range(1000, 1006))


def test_long_list_of_many_keywords(spark):
    """100 keywords over and over in one order: each pair has a hundredth of the page."""
    rng = random.Random(12)
    keys = [f"{a}{b}{c}" for a in ("wo", "ki", "sha", "lu", "pe") for b in ("ma", "tro", "ni", "se", "du") for c in ("x", "l", "rt", "k")]
    rows = [(i, article(rng, 3)) for i in range(2200)] + [(10000, ", ".join(keys * 50)), (10001, "\n".join(" ".join(keys) for _ in range(50))), (20000, article(rng, 400))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"] for r in stuffing.stuffed_pages(df).collect() if r["is_spam"]} == {10000, 10001}


def test_batches_larger_than_a_slice(spark):
    rng = random.Random(8)
    rows = [(i, article(rng, 1500)) for i in range(80)] + [(100, spam(rng, 0)), (101, None)]
    rng.shuffle(rows)
    assert sum(len(r[1] or "") for r in rows) > 8 << 20
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = stuffing.stuffed_pages(df).collect()
    assert len(got) == 82 and [r["doc_id"] for r in got if r["is_spam"]] == [100]
