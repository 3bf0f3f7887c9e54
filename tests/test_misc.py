import re

from pyspark.sql import functions as F

from tokloom.functions.hashing import phash, uniform_int
from tokloom.functions.text import glob_to_regex
from tokloom.operators import stream as S
from tokloom.operators.encode import prompt_ids


def test_glob_translation():
    cases = {"*.min.js": ["app.min.js"], "?.py": ["a.py"], "[ab]x": ["ax", "bx"],
             "[!ab]x": ["cx"], "node_modules": ["node_modules"]}
    misses = {"*.min.js": ["app.js"], "?.py": ["ab.py"], "[ab]x": ["cx"], "[!ab]x": ["ax"],
              "node_modules": ["node_modules2"]}
    for g, hits in cases.items():
        rx = re.compile(glob_to_regex(g))
        assert all(rx.match(h) for h in hits), g
        assert not any(rx.match(m) for m in misses[g]), g


def test_portable_hash_known_value(spark):
    # first 32 bits of md5('42|7') as an unsigned integer
    import hashlib
    exp = int(hashlib.md5(b"42|7").hexdigest()[:8], 16)
    got = spark.range(1).select(phash(42, 7).alias("h")).first().h
    assert got == exp
    r = spark.range(200).select(uniform_int(3, 5, 1, F.col("id")).alias("u")).collect()
    assert {x.u for x in r} == {3, 4, 5}


def test_hash_split_is_stable(spark):
    docs = spark.range(2000).withColumnRenamed("id", "doc_id")
    a = S.split_hash(docs, 0.1, 42)
    b = S.split_hash(docs.repartition(7), 0.1, 42)
    va = {r.doc_id for r in a.where("split = 'val'").collect()}
    vb = {r.doc_id for r in b.where("split = 'val'").collect()}
    assert va == vb and 120 < len(va) < 280


def test_blank_prompt_is_bos(spark):
    df = spark.createDataFrame([("  ", [9, 9]), ("x", [5])], "p string, ids array<int>")
    got = [r.t for r in df.select(prompt_ids(F.col("p"), F.col("ids"), 2, 3).alias("t")).collect()]
    assert got == [[2], [2, 5, 3]]
