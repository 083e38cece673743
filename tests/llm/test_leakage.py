import random

import pytest

from cratework.llm import leakage
from cratework.llm.words import words


def edit_distance_anywhere(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


def test_myers_is_edit_distance():
    rng = random.Random(1)
    for _ in range(300):
        pattern = [rng.choice("abcd") for _ in range(rng.randrange(1, 14))]
        text = [rng.choice("abcd") for _ in range(rng.randrange(0, 20))]
        a = rng.randrange(len(pattern))
        n = rng.randrange(1, len(pattern) - a + 1)
        assert leakage.myers(leakage.masks(pattern), a, n, text) == edit_distance_anywhere(pattern[a : a + n], text)


def test_words():
    assert words("Don't STOP_now — Ünïcode42 Ж!") == ["don", "t", "stop", "now", "ünïcode42", "ж"]
    assert words(None) == words("") == words(" \n—") == []


def brute(docs, items, n, errors):
    """(doc, item) -> longest equal run, for pairs with a passage within the error budget."""
    out = {}
    for d, t in docs:
        w = words(t)
        for i, x in items:
            p = words(x)
            windows = [p[s : s + n] for s in range(len(p) - n + 1)]
            if any(edit_distance_anywhere(v, w) <= errors for v in windows):
                run = max((k for k in range(len(p), 0, -1) for s in range(len(p) - k + 1) if any(w[j : j + k] == p[s : s + k] for j in range(len(w) - k + 1))), default=0)
                out[d, i] = run
    return out


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_leaks_brute(spark, block_bytes):
    rng = random.Random(7)
    vocabulary = ["red", "Blue", "stone", "of", "the", "River", "ask", "why", "Ж", "2024"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.randrange(5, 25))) for i in range(12)] + [(50, None), (51, "")]
    docs = []
    for d in range(60):
        body = text(30).split()
        if d % 2:
            source = items[rng.randrange(12)][1].split()
            cut = source[: rng.randrange(8, 25)]
            if d % 3 == 0 and cut:
                cut[rng.randrange(len(cut))] = "edited"
            if d % 5 == 0 and len(cut) > 2:
                del cut[rng.randrange(len(cut))]
            body[10:10] = cut
        docs.append((d, "\r\n, ".join(body) if d % 4 else " ".join(body).upper()))
    docs += [(100, None), (101, ""), (102, "- —"), docs[1], docs[1]]
    a = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items + items[:3], "item_id int, text string")
    got = {}
    for r in leakage.leaks(a, b, block_bytes=block_bytes).collect():
        got[r["doc_id"], r["item_id"]] = (r["longest_run"], r["distance"])
    want = brute(docs, items, 12, 1)
    assert set(got) == set(want)
    for k, (run, distance) in got.items():
        assert (run >= 12) == (distance == 0) == (want[k] >= 12)


def test_leaks_edges(spark):
    a = spark.createDataFrame([(1, "x " * 200_000 + "one two three four five six seven eight nine ten eleven twelve", 3)], "id int, text string, item_id int")
    b = spark.createDataFrame([(9, "One two, three four five six seven eight nine ten eleven TWELVE!", 1)], "id int, text string, doc_id int")
    r = leakage.leaks(a, b, doc="id", item="id").collect()
    assert [tuple(x) for x in r] == [(1, 9, 12, 0, 12)]
    assert leakage.leaks(a.limit(0), b, doc="id", item="id").count() == 0
    assert leakage.leaks(a, b.limit(0), doc="id", item="id").count() == 0
