import json
import os
import tempfile

import pytest

from tokloom.config import CorpusConfig, SPECIALS
from tokloom.operators import corpus as C
from tokloom.operators import evals as E
from tokloom.operators import stream as S
from tokloom.session import checkpoint_dir
from tokloom.sources import files as SF
from tokloom.sources import sinks as K
from tokloom.sources import tables as T


def make_tree(root):
    files = {
        "src/a.py": b"print('hello world')\r\n" * 4,
        "src/bad.py": b"x = '\xff'\n" * 10,
        "src/nul.py": b"a\x00b = 1\n" * 10,
        "src/tiny.py": b"x=1\n",
        "node_modules/m.js": b"var a = 1;\n" * 10,
        "docs/readme.md": b"# title\n" * 10,
        "docs/blank.txt": b" \n\t  " * 20,
        "other/img.png": b"\x89PNG" * 40,
    }
    for rel, data in files.items():
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as fh:
            fh.write(data)
    return files


def test_discover_and_decode(spark):
    root = tempfile.mkdtemp(prefix="tokloom-test-")
    files = make_tree(root)
    found = {os.path.relpath(r.path.replace("file:", ""), root): r
             for r in SF.discover_files(spark, root).collect()}
    assert set(found) == {"src/a.py", "src/bad.py", "src/nul.py", "docs/readme.md", "docs/blank.txt"}
    assert found["src/a.py"].n_bytes == len(files["src/a.py"])
    rows = {os.path.relpath(r.path.replace("file:", ""), root): r
            for r in SF.read_code_files(spark, root).collect()}
    assert rows["src/bad.py"].valid is False and rows["src/bad.py"].text is None
    assert rows["src/a.py"].text == "print('hello world')\n" * 4       # text-mode newlines
    assert rows["src/nul.py"].text == "a\x00b = 1\n" * 10
    tot = C.corpus_totals(SF.read_code_files(spark, root)).first()
    assert tot.total_files == 5 and tot.skipped_files == 2           # undecodable + blank
    lines = SF.read_text_lines(spark, root)
    bad = [r.line for r in lines.collect() if r.path.endswith("bad.py")]
    assert "x = '�'" in bad
    # tokenizer walk: no minimum size, no exclusions
    tk = {os.path.relpath(r.path.replace("file:", ""), root) for r in SF.tokenizer_files(spark, root).collect()}
    assert "src/tiny.py" in tk and "node_modules/m.js" in tk


def test_folders_above_the_corpus_do_not_exclude_it(spark):
    root = os.path.join(tempfile.mkdtemp(prefix="tokloom-"), "build", "corpus")
    make_tree(root)
    for mode in ("substring", "glob"):
        cfg = CorpusConfig(exclude_mode=mode)
        assert SF.discover_files(spark, root, cfg).count() == 5
        assert SF.read_code_files(spark, root, cfg).count() == 5


def test_text_lines_shuffle_nothing_and_no_files_is_an_error(spark):
    root = tempfile.mkdtemp(prefix="tokloom-empty-")
    with open(os.path.join(root, "x.png"), "wb") as f:
        f.write(b"x")
    plan = SF.read_text_lines(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    with pytest.raises(ValueError, match="no files"):
        SF.tokenizer_files(spark, root)


def test_marker_ids(spark):
    vocab = spark.createDataFrame(list(enumerate(SPECIALS)), "id int, token string")
    ids = C.marker_ids(vocab)
    assert ids["<fim_prefix>"] == 4 and ids["eot"] == 7 and ids["eos"] == 3
    assert C.marker_ids(vocab.where("token <> '<|endoftext|>'"))["eot"] == 3
    with pytest.raises(ValueError, match="fim_suffix"):
        C.marker_ids(vocab.where("token <> '<fim_suffix>'"))


def test_cluster_needs_a_shared_checkpoint_folder(spark):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_sinks_round_trip(spark):
    out = tempfile.mkdtemp(prefix="tokloom-sink-")
    docs = spark.createDataFrame([("ds", "py", 3, ".py", "x"), ("ds", "py", 7, ".py", "y")],
                                 "dataset string, lang string, idx long, ext string, content string")
    K.write_documents(docs, out + "/docs")
    back = spark.read.parquet(out + "/docs").orderBy("idx").collect()
    assert [r.path for r in back] == ["ds/py/00000003.py", "ds/py/00000007.py"]
    st = spark.createDataFrame([("train", 1, 0, [1, 2]), ("val", 2, 0, [3])],
                               "split string, doc_id long, start_off long, ids array<int>")
    K.write_shards(st, out + "/shards")
    val = T.read_shards(spark, out + "/shards", "val", 0).collect()
    assert [r.ids for r in val] == [[3]]
    assert K.stage_done(spark, out + "/shards", 1) and not K.stage_done(spark, out + "/shards", 2)
    assert not K.stage_done(spark, out + "/missing", 0)
    comps = spark.createDataFrame([("p", 1, "b"), ("p", 0, "a")], "prompt string, sample_id int, text string")
    assert K.completions_text(comps).first().value == "=== PROMPT: p ===\na\n\nb"
    passk = spark.createDataFrame([(1, 0.25), (5, 0.5)], "k int, pass_at_k double")
    rep = K.eval_report(None, passk, None).first()
    assert json.loads(rep.pass_at_k) == {"pass@1": 0.25, "pass@5": 0.5}


def test_jsonl_and_prompts(spark):
    d = tempfile.mkdtemp(prefix="tokloom-json-")
    with open(d + "/p.jsonl", "w") as fh:
        fh.write('{"task_id": "t/0", "prompt": "def f():", "test": "assert 1", "entry_point": "f"}\n\n')
        fh.write('{"task_id": "t/1", "prompt": "def g():", "test": "assert 1", "entry_point": "g"}\n')
    assert T.read_jsonl(spark, d + "/p.jsonl").count() == 2
    with open(d + "/prompts.txt", "w") as fh:
        fh.write("  a  \n\n   \nb\n")
    assert [r.prompt for r in T.read_prompts(spark, d + "/prompts.txt", []).collect()] == ["a", "b"]
    assert T.read_prompts(spark, None, ["x", "y"]).count() == 2


def test_small_helpers(spark):
    df = spark.createDataFrame([(i,) for i in range(10)], "k int")
    idx = {r.k: r.idx for r in C.row_index(df, ["k"]).collect()}
    assert idx == {i: i for i in range(10)}
    assert C.special_tokens(["<unk>", "<pad>"], ["<pad>", "<x>"]) == ["<unk>", "<pad>", "<x>"]
    r = spark.range(1).select(C.resolve_id(None, 5).alias("a"), C.resolve_id(0, None).alias("b"),
                              C.resolve_id(3, 5).alias("c")).first()
    assert (r.a, r.b, r.c) == (5, 0, 3)
    probs = spark.createDataFrame([("t1",), ("t2",)], "task_id string")
    assert E.expand_samples(probs, 3).count() == 6
    per = spark.createDataFrame([("a", 5, 1), ("b", 5, 5)], "task_id string, n_samples long, n_correct long")
    pr = {r.task_id: (r.position, r.total) for r in E.progress(per).collect()}
    assert pr == {"a": (1, 2), "b": (2, 2)}
    ep = S.epochs(spark.range(3).withColumnRenamed("id", "win_id"), 2)
    assert ep.count() == 6
    assert CorpusConfig().min_bytes == 64


def test_table_sources_and_meta(spark):
    d = tempfile.mkdtemp(prefix="tokloom-tab-")
    spark.createDataFrame([("Python", "print(1)", None, 0), ("Go", None, "package x", 0), ("Go", None, None, 1),
                           ("Perl", "1;", None, 0)],
                          "language string, code string, content string, idx long").write.parquet(d + "/multi")
    rows = sorted((r.lang_rank, r.idx, r.language, r.content, r.ext) for r in T.read_multilang(
        spark, d + "/multi", {"Python": ".py", "Go": ".go"}).collect())
    assert rows == [(0, 0, "Python", "print(1)", ".py"), (1, 0, "Go", "package x", ".go"), (1, 1, "Go", "", ".go")]
    spark.createDataFrame([("doc", "def f(): pass"), ("", "x = 1"), (None, "y = 2")],
                          "func_documentation_string string, whole_func_string string") \
        .write.parquet(d + "/funcs")
    got = sorted(r.content for r in T.read_function_pairs(spark, d + "/funcs").collect())
    assert got == ['"""\ndoc\n"""\ndef f(): pass', "x = 1", "y = 2"]
    assert T.first_readable(spark, [d + "/missing", d + "/funcs"]).count() == 3
    assert T.first_readable(spark, [d + "/missing"]) is None
    meta = spark.createDataFrame(
        [(1000, 50, 45, 5, 0.1, "uint16", "tok", 3, 1, {".py": 2})],
        "vocab_size long, total_tokens long, train_tokens long, val_tokens long, val_ratio double, "
        "dtype string, tokenizer string, total_files long, skipped_files long, ext_counts map<string,bigint>")
    K.write_meta(meta, d + "/meta")
    back = T.read_meta(spark, d + "/meta").first()
    assert back.train_tokens == 45 and back.ext_counts == {".py": 2}
    from tokloom.operators.bpe import base_model
    m = base_model()
    K.write_tokenizer(m.vocab_df(spark), m.merges_df(spark), d + "/tok")
    assert spark.read.parquet(d + "/tok/vocab").count() == 271
