from pyspark.sql import functions as F

from tokloom.config import CorpusConfig, EXCLUDE_PATTERNS
from tokloom.functions.text import (excluded_glob, excluded_substring, path_parts,
                                    py_strip, suffix)
from tokloom.sources.files import file_filter

PATHS = ["a/b.py", "a-b/c.py", ".gitignore", "x.tar.gz", "q/.a.PY", "z.",
         "src/distance.py", "node_modules/x.js", "app.min.js", ".github/w.md"]


def test_suffix_matches_pathlib(spark):
    from pathlib import PurePosixPath
    df = spark.createDataFrame([(p,) for p in PATHS], "path string")
    got = {r.path: r.s for r in df.select("path", suffix("path").alias("s")).collect()}
    for p in PATHS:
        assert got[p] == PurePosixPath(p).suffix.lower(), p


def test_exclusion_substring_and_glob(spark):
    df = spark.createDataFrame([(p,) for p in PATHS], "path string")
    rows = df.select("path", excluded_substring("path", EXCLUDE_PATTERNS).alias("s"),
                     excluded_glob("path", EXCLUDE_PATTERNS).alias("g")).collect()
    sub = {r.path for r in rows if r.s}
    glob = {r.path for r in rows if r.g}
    # substring mode: 'dist' drops distance.py, '.git' drops .github and .gitignore
    assert sub == {"src/distance.py", "node_modules/x.js", ".github/w.md", ".gitignore"}
    # glob mode: whole path parts; '*.min.js' now matches
    assert glob == {"node_modules/x.js", "app.min.js"}


def test_path_order_by_parts(spark):
    df = spark.createDataFrame([("a-b/c.py",), ("a/b.py",)], "path string")
    got = [r.path for r in df.orderBy(path_parts("path")).collect()]
    assert got == sorted(["a-b/c.py", "a/b.py"], key=lambda p: p.split("/"))
    assert got[0] == "a/b.py"


def test_size_range_inclusive(spark):
    df = spark.createDataFrame([(f"f{n}.py", n) for n in (63, 64, 1048576, 1048577)],
                               "path string, n bigint")
    kept = [r.n for r in df.where(file_filter("path", "n", CorpusConfig())).collect()]
    assert sorted(kept) == [64, 1048576]


def test_strip_like_python(spark):
    vals = ["\n a \t", " a", "\u0085", "\x1c", "", "﻿x", "　b ", "\x0bc\x0c"]
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    got = [r.s for r in df.select(py_strip("t").alias("s")).collect()]
    assert got == [v.strip() for v in vals]


def test_strip_nonempty_drops_blank(spark):
    from tokloom.operators.corpus import strip_nonempty
    df = spark.createDataFrame([(v,) for v in ["\n a \t", " ", "\u0085", "x"]], "text string")
    assert sorted(r.text for r in strip_nonempty(df).collect()) == ["a", "x"]

