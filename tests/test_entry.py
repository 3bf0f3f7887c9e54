import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["word", "n"]
    assert df.count() > 0


def test_oracle_keys_subset():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    own = {k for k in q if k != "pipeline" and not k.startswith("op")}
    # every query of the catalogue has its SQL, or a small form that has
    assert all(k in s or f"{k}_48" in s for k in own)


def test_cheap_queries_run_small(spark):
    q = E.queries()
    for name in ["ext_histogram", "corpus_totals", "quota_files", "tag_lookup",
                 "pass_at_k", "topk_ties", "step_rollup", "retention"]:
        assert q[name](spark, "/root/testdata/sf0.001").count() >= 0
