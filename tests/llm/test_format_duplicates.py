import random
from collections import Counter, defaultdict

import pytest
from oracle_check import compare, connect
from pyspark.sql import functions as F

from cratework.llm import format_duplicates, queries

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def canon(xs):
    return tuple(sorted({"".join(ch for ch in x.lower() if ch.isalnum()) for x in xs or [] if x} - {""}))


def test_duplicates_brute(spark):
    rng = random.Random(4)
    words = ["A b", "a-B", "ab ", "ÀB", "àb!", "c", "C.", "", " ", None, "Ж 1", "ж1", "d_e", "DE"]
    data = [(i, rng.choice([None, [], *([rng.sample(words, 2)] * 3), [rng.choice(words)]]), rng.choice([None, [rng.choice(words)]])) for i in range(400)]
    data += [(1000 + i, ["hot one"], ["n"]) for i in range(300)] + [(5, ["hot-one"], ["N"]), (5, ["hot-one"], ["N"])]
    df = spark.createDataFrame(data, "rid int, u array<string>, n array<string>")
    fields = {"urls": F.col("u"), "names": F.col("n")}
    groups = defaultdict(list)
    for r, u, n in data:
        if canon(u) or canon(n):
            groups[canon(u), canon(n)].append(r)
    want = sorted((min(g), r) for g in groups.values() for r in g if r > min(g))
    assert rows(format_duplicates.copies_of(df, fields, "rid")) == sorted(want, key=repr)
    survivors = format_duplicates.collapse(df, fields, "rid")
    assert Counter(rows(survivors.select("first_record", "copies"))) == Counter((min(g), len(g)) for g in groups.values())
    assert format_duplicates.copies_of(df.limit(0), fields, "rid").count() == 0


def test_raw_keys_tell_lists_apart(spark):
    """Where an element ends, what is null and which list it is in all count."""
    data = [(["a"], ["b"]), (["a", "b"], []), ([], ["a", "b"]), (["ab"], []), (["a", None], ["b"]), ([None, "a"], ["b"]), (None, ["a", "b"]), (["a"], [None, "b"]), (["a"], ["b", None])]
    df = spark.createDataFrame(data, "u array<string>, n array<string>")
    assert df.select(format_duplicates.raw_key([F.col("u"), F.col("n")])).distinct().count() == len(data)


def test_clashing_names_and_long_texts(spark):
    df = spark.createDataFrame([(1, ["A"], "r", 1, 1), (2, ["a "], "r", 1, 1)], "rid int, first array<string>, raw_key string, n_copies int, copy_record_id int")
    assert rows(format_duplicates.copies_of(df, {"x": F.col("first")}, "rid")) == [(1, 2)]
    long = "Ab-" * 400_000
    df = spark.createDataFrame([(1, [long]), (2, [long.upper() + "!"]), (3, [long + "x"])], "rid int, u array<string>")
    assert rows(format_duplicates.copies_of(df, {"u": F.col("u")}, "rid")) == [(1, 2)]


@pytest.mark.parametrize("name", ["p4_found", "p4_collapsed"])
def test_query_against_sql(spark, name):
    got, want = compare(spark, connect(SF), SF, queries.QUERIES[name], queries.ORACLE[name])
    assert got == want and got
